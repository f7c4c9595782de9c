"""Token counts of sections by offset-mapped attribution.

A document is encoded once and as a whole. A byte-level vocabulary maps every token to the bytes it
stands for, so the running sum of their lengths gives each token's span in the document. Sections tile
the document as well; both lists are sorted, so the interval join of tokens with sections is one
merge. A token that crosses a boundary is allocated by an explicit rule:

- ``start``: to the section that holds its first byte (default);
- ``majority``: to the section that holds most of its bytes, the earlier one if equal.

Either way every token counts once, so a document's section counts add up to its token count.

Sections are lines with their line break (``line_sections``), or the fields of a record that is
rendered as one text (``count_fields``), such as role and content of a conversation's turn.

Edge cases: null text is empty; an empty text has one empty section without tokens; repeated rows give
repeated results; an empty table gives none; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

RULES = ("start", "majority")
# What the tokenizer's pattern counts as white space (fixed values). It recurses for every character of a
# run of these, so longer runs than LONG_RUN are cut off before.
LONG_RUN = 1024
_LONG_SPACE = re.compile(r"[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)
COUNT_SCHEMA = "doc_id long, section int, first_byte long, end_byte long, n_tokens long, n_crossing long"


class ByteTokens:
    """A byte-level vocabulary given as ranks, with the byte length of every token."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.ranks = ranks

    def tokens(self) -> list[bytes]:
        """The bytes of every id."""
        out = [b""] * len(self.lengths)
        for token, rank in self.ranks.items():
            out[rank] = token
        return out

    def encode(self, text: str) -> list[int]:
        """Token ids. The pattern takes a run of white space as one piece, but for its last character if
        more text follows, so a long run is encoded as that piece and the rest by itself."""
        out, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += self.encoding.encode_ordinary(text[at:run.start()])
            out += self.encoding._encode_single_piece(text[run.start():end])
            at = end
        return out + self.encoding.encode_ordinary(text[at:]) if at else self.encoding.encode_ordinary(text)

    def ends(self, text: str) -> np.ndarray:
        """Byte where each token of the text ends."""
        return np.cumsum(self.lengths[self.encode(text)])


_loaded: dict[tuple[str, str], ByteTokens] = {}


def byte_tokens(path: str, pattern: str) -> ByteTokens:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteTokens(path, pattern)
    return _loaded[path, pattern]


def line_sections(raw: bytes) -> np.ndarray:
    """Byte bounds of the lines, each with its line break; the first bound is 0, the last the length."""
    breaks = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 0x0A) + 1
    if len(breaks) and breaks[-1] == len(raw):
        breaks = breaks[:-1]
    return np.concatenate(([0], breaks, [len(raw)]))


def attribute(token_ends: np.ndarray, bounds: np.ndarray, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """Tokens allocated to each section, and how many of them cross one of its bounds."""
    n = len(bounds) - 1
    starts = np.concatenate(([0], token_ends[:-1])) if len(token_ends) else token_ends
    inner = bounds[1:-1]
    first = np.searchsorted(inner, starts, side="right")
    last = np.searchsorted(inner, token_ends - 1, side="right")
    owner = first.copy()
    crossing = np.flatnonzero(last > first)
    if rule == "majority":
        for t in crossing.tolist():
            parts = np.arange(first[t], last[t] + 1)
            share = np.minimum(bounds[parts + 1], token_ends[t]) - np.maximum(bounds[parts], starts[t])
            owner[t] = parts[int(np.argmax(share))]
    elif rule != "start":
        raise ValueError(f"rule must be one of {RULES}")
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def count_sections(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "start",
                   text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Token counts of the lines of every document, with each line's byte span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(ranks_path, pattern)
        for batch in batches:
            rows, parts = [], []
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                bounds = line_sections(text.encode())
                counts, crossing = attribute(tokens.ends(text), bounds, rule)
                rows.append(np.full(len(counts), i))
                parts.append((np.arange(len(counts), dtype=np.int32), bounds[:-1], bounds[1:], counts, crossing))
            if not rows:
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.concatenate(rows))),
                 *[pa.array(np.concatenate(p)) for p in zip(*parts)]],
                names=[f.split()[0] for f in COUNT_SCHEMA.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, COUNT_SCHEMA)


def count_fields(records: DataFrame, id_cols: list[str], fields: list[str], ranks_path: str, pattern: str,
                 separator: str = "\n", rule: str = "start") -> DataFrame:
    """Token counts of the fields of each record, rendered as one text: every field and the separator."""
    schema = ", ".join([*[f"`{c}` {records.schema[c].dataType.simpleString()}" for c in id_cols],
                        "field string, n_tokens long, n_crossing long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(ranks_path, pattern)
        k = len(id_cols)
        for batch in batches:
            counts, crossing = [], []
            for i in range(batch.num_rows):
                values = [(batch.column(k + j)[i].as_py() or "") + separator for j in range(len(fields))]
                bounds = np.concatenate(([0], np.cumsum([len(v.encode()) for v in values])))
                n, over = attribute(tokens.ends("".join(values)), bounds, rule)
                counts.append(n)
                crossing.append(over)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), len(fields)))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (counts, crossing)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(j).take(rows) for j in range(k)], pa.array(fields * batch.num_rows, pa.string()),
                 *[pa.array(x.astype(np.int64)) for x in flat]],
                names=[*id_cols, "field", "n_tokens", "n_crossing"])

    return records.select(*id_cols, *[F.col(c).cast("string") for c in fields]).mapInArrow(run, schema)
