"""Quality rules as a short-circuit cascade.

Every document gets the base counts. The rules of the cascade then run one after another, each only over the
documents that all earlier ones passed, and read the counts that are there instead of making them again. Their order comes from a sample:
each rule's seconds a document and its share of rejected documents are measured there, and the rule
with the highest rejection per second goes first. A document is kept if no rule rejects it, so the
order decides the cost and never the verdict, and a timing that differs between runs changes no row.

The rules are stated in whole numbers, so SQL gives the same verdicts (``queries.py``):

- ``few_words``: fewer than 50 words (base);
- ``repeats``: more than half of the words lie in three-word windows found twice or more (base);
- ``symbols``: more than one of ``# * $ % & | < >`` for every five words;
- ``repeated_lines``: more than half of the lines with words equal an earlier line;
- ``not_words``: fewer than four fifths of the words hold a letter (ASCII, or any character past ASCII);
- ``shouting``: more than three tenths of the words hold two ASCII capitals and no ASCII small letter;
- ``word_length``: the words' mean length is below two or above twenty characters.

Edge cases: null text has no words, so ``few_words`` rejects it; repeated rows get equal rows; an
empty table gives none; columns other than ``doc_id`` and the text are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cordon.llm.words import Texts, hash_spans, mix, slices

SAMPLE_DOCS = 2000
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
SMALL = np.zeros(256, dtype=bool)
SMALL[ord("a"):ord("z") + 1] = True
CAPITAL = np.zeros(256, dtype=bool)
CAPITAL[ord("A"):ord("Z") + 1] = True
LETTER = SMALL | CAPITAL
LETTER[128:] = True


def _running(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _per_text(t: Texts, values: np.ndarray | None = None) -> np.ndarray:
    """Words of each text, or the sum of a value over them."""
    if values is None:
        return np.bincount(t.text_of, minlength=t.n)
    return np.bincount(t.text_of, weights=values, minlength=t.n).astype(np.int64)


def _word_count(t: Texts) -> np.ndarray:
    return _per_text(t)


def _word_chars(t: Texts) -> np.ndarray:
    chars = _running((t.data & 0xC0) != 0x80)
    return _per_text(t, chars[t.ends] - chars[t.starts])


def _symbol_count(t: Texts) -> np.ndarray:
    found = _running(SYMBOLS[t.data])
    return found[t.offsets[1:]] - found[t.offsets[:-1]]


def _lines(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the lines that hold a word."""
    breaks = np.flatnonzero(t.data == 0x0A)
    starts = np.sort(np.concatenate([t.offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([t.offsets[1:], breaks]))
    with_word = np.searchsorted(t.starts, ends) > np.searchsorted(t.starts, starts)
    starts, ends = starts[with_word], ends[with_word]
    return starts, ends, np.searchsorted(t.offsets[1:], starts, side="right")


def _line_counts(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that equal an earlier one, of each text."""
    starts, ends, text_of = _lines(t)
    lines = np.bincount(text_of, minlength=t.n)
    key = mix(hash_spans(t.data, starts, ends) + mix(text_of.astype(np.uint64)))
    again = pd.Series(key).duplicated().to_numpy() if len(key) else np.zeros(0, bool)
    return lines, np.bincount(text_of[again], minlength=t.n)


def _repeat_words(t: Texts) -> np.ndarray:
    """Words that lie in a three-word window found twice or more in their text."""
    n = len(t.starts)
    if n < 3:
        return np.zeros(t.n, dtype=np.int64)
    h = t.hashes()
    key = mix(mix(mix(h[:-2]) + h[1:-1]) + h[2:])
    inside = np.flatnonzero(t.text_of[:-2] == t.text_of[2:])
    key = mix(key[inside] + mix(t.text_of[inside].astype(np.uint64)))
    codes, uniques = pd.factorize(key)
    at = inside[np.bincount(codes, minlength=len(uniques))[codes] > 1]
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[at + k] = True
    return _per_text(t, covered)


def _words_with(t: Texts, flags: np.ndarray, least: int = 1) -> np.ndarray:
    found = _running(flags[t.data])
    return found[t.ends] - found[t.starts] >= least


class Counts(dict):
    """Counts of the texts of a slice by name, each made when it is first read and kept. ``only`` hands the made
    ones on to some of the texts, whose bytes are copied together only if another count asks for them."""

    def __init__(self, t: Texts, rows: np.ndarray | None = None, made: dict[str, np.ndarray] | None = None):
        super().__init__(made or {})
        self._whole, self._rows = t, rows

    @property
    def texts(self) -> Texts:
        if self._rows is not None:
            self._whole, self._rows = only(self._whole, self._rows), None
        return self._whole

    def __missing__(self, name: str) -> np.ndarray:
        if name in ("lines", "dup_lines"):
            self["lines"], self["dup_lines"] = _line_counts(self.texts)
        else:
            self[name] = COUNTS[name](self.texts)
        return self[name]

    def only(self, left: np.ndarray) -> "Counts":
        rows = left if self._rows is None else self._rows[left]
        return Counts(self._whole, rows, {name: value[left] for name, value in self.items()})


def _letter_words(t: Texts) -> np.ndarray:
    return _per_text(t, _words_with(t, LETTER))


def _loud_words(t: Texts) -> np.ndarray:
    return _per_text(t, _words_with(t, CAPITAL, 2) & ~_words_with(t, SMALL))


COUNTS: dict[str, Callable[[Texts], np.ndarray]] = {
    "words": _word_count,
    "chars": _word_chars,
    "symbols": _symbol_count,
    "repeats": _repeat_words,
    "letter_words": _letter_words,
    "loud_words": _loud_words,
}


def _few_words(c: Counts) -> np.ndarray:
    return c["words"] < 50


def _repeats(c: Counts) -> np.ndarray:
    return 100 * c["repeats"] > 50 * c["words"]


def _symbols(c: Counts) -> np.ndarray:
    return 5 * c["symbols"] > c["words"]


def _repeated_lines(c: Counts) -> np.ndarray:
    return 2 * c["dup_lines"] > c["lines"]


def _not_words(c: Counts) -> np.ndarray:
    return 5 * c["letter_words"] < 4 * c["words"]


def _shouting(c: Counts) -> np.ndarray:
    return 10 * c["loud_words"] > 3 * c["words"]


def _word_length(c: Counts) -> np.ndarray:
    return (c["chars"] < 2 * c["words"]) | (c["chars"] > 20 * c["words"])


RULES: dict[str, Callable[[Counts], np.ndarray]] = {
    "few_words": _few_words,
    "repeats": _repeats,
    "symbols": _symbols,
    "repeated_lines": _repeated_lines,
    "not_words": _not_words,
    "shouting": _shouting,
    "word_length": _word_length,
}


def only(t: Texts, rows: np.ndarray) -> Texts:
    """The texts of some rows (ascending), with their bytes copied together."""
    lengths = t.offsets[rows + 1] - t.offsets[rows]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    chosen = np.zeros(t.n, dtype=bool)
    chosen[rows] = True
    data = t.data[np.repeat(chosen, np.diff(t.offsets))]
    words = chosen[t.text_of]
    new_row = np.cumsum(chosen) - 1
    shift = np.zeros(t.n, dtype=np.int64)
    shift[rows] = offsets[:-1] - t.offsets[rows]
    text_of = t.text_of[words]
    return Texts(t.first, data, offsets, t.starts[words] + shift[text_of], t.ends[words] + shift[text_of],
                 new_row[text_of])


def cascade(t: Texts, order: list[str], counts: Counts | None = None) -> np.ndarray:
    """Index in ``order`` of the rule that rejects each text, -1 if none does; counts made before are used."""
    verdict = np.full(t.n, -1, dtype=np.int32)
    alive = np.arange(t.n)
    now = Counts(t) if counts is None else counts
    for k, name in enumerate(order):
        if not len(alive):
            break
        rejected = RULES[name](now)
        verdict[alive[rejected]] = k
        if rejected.any():
            left = np.flatnonzero(~rejected)
            alive, now = alive[left], now.only(left)
    return verdict


def rule_order(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> list[str]:
    """Rules by falling rejection per second, both measured on about ``sample_docs`` documents that a
    hash of the id picks. The sample decides the order only."""
    total = docs.count()
    names = list(RULES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, seen = np.zeros(len(names)), np.zeros(len(names), np.int64), 0
        for batch in batches:
            for t in slices(batch.column(0)):
                seen += t.n
                for k, name in enumerate(names):
                    began = time.perf_counter()
                    rejected[k] += int(RULES[name](Counts(t)).sum())
                    seconds[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(seconds), pa.array(rejected), pa.array(np.full(len(names), seen))],
            names=["rule", "seconds", "rejected", "seen"])

    key = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(max(1, total // sample_docs)))
    found = (docs.filter(key == 0).select(F.col(text_col).cast("string").alias("text"))
             .mapInArrow(measure, "rule string, seconds double, rejected long, seen long")
             .groupBy("rule").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("r"), F.sum("seen").alias("n"))
             .collect())  # one row a rule
    gain = {r["rule"]: r["r"] / max(r["s"], 1e-9) for r in found}
    return sorted(names, key=lambda name: -gain.get(name, 0.0))


COUNTS_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                 "n_repeat_words long, base_failed boolean, kept boolean, failed_rule string")


def judge(docs: DataFrame, text_col: str = "text", order: list[str] | None = None) -> DataFrame:
    """Base counts and verdict of every document; ``failed_rule`` is the rule that rejected it first."""
    order = order or rule_order(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*order, None], pa.string())
        for batch in batches:
            for t in slices(batch.column(1)):
                c = Counts(t)
                columns = [pa.array(c[name].astype(np.int64)) for name in ("words", "chars", "symbols", "dup_lines", "repeats")]
                base_failed = _few_words(c) | _repeats(c)
                verdict = cascade(t, order, c)
                kept = (verdict < 0) & ~base_failed
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.first, t.n), *columns, pa.array(base_failed), pa.array(kept),
                     names.take(pa.array(np.where(verdict < 0, len(order), verdict)))],
                    names=[f.split()[0] for f in COUNTS_SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, COUNTS_SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    order = rule_order(docs, text_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.concatenate([cascade(t, order) < 0 for t in slices(batch.column(at))] or [np.zeros(0, bool)])
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
