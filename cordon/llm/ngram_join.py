"""Similarity join on word n-grams: MinHash banding and verification on full n-gram sets.

1. ``signatures``: every text's words give a 128-bit key of the word sequence and the hashes of its
   bands. Bands and rows follow from the target recall: of all shapes within ``MAX_HASHES`` hashes, the
   one with the most rows a band (the fewest chance candidates) whose recall at the threshold is met.
2. Copies (same word sequence) become one representative. Representatives that share a band hash are
   candidates; each bucket is kept as a star around its smallest key, never as pairs, so a bucket of m
   texts costs m rows.
3. The stars' connected components hold every candidate pair. A component is dealt into blocks of
   bounded n-gram count by key hash, and each pair of blocks is one group of rows: a component with a
   third of all texts is many groups. Within a group all pairs are verified on their full n-gram sets by
   blocked matrix products; only counts of links and a spanning forest leave the task, not pairs.
4. Verified links give the classes, again as connected components.

Every pair of different texts that shares a band is verified, and pairs of the same component that
share none are verified too, so measured recall is above the target. Work within one component grows
with the square of its size, as its links do.

An n-gram is five consecutive words (``[^\\x20\\x09-\\x0D]+``, case kept); a shorter text with words has
one n-gram, all its words. N-grams are compared by 64-bit hash. Edge cases: a text without words
(null, empty) has no n-grams, no links, and is a class of its own; repeated rows are copies; null ids
sort after all others as class ids; an empty table gives no rows; other columns only take part in the
choice among rows that share id and words (``keep_one``).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cordon.llm.components import components
from cordon.llm.shared import cut
from cordon.llm.words import Texts, mix, slices

N = 5
THRESHOLD = Fraction(4, 5)
TARGET_RECALL = 0.9995
MAX_HASHES = 256
BLOCK_NGRAMS = 1 << 17
LEAST_WEIGHT = 128  # of a text in a block, so that a block holds about a thousand texts at most
COLUMNS_AT_ONCE = 4096


def bands_and_rows(threshold: float = float(THRESHOLD), recall: float = TARGET_RECALL,
                   hashes: int = MAX_HASHES) -> tuple[int, int]:
    """The most rows a band whose recall at the threshold meets the target within so many hashes."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - threshold ** rows) ** bands >= recall:
            return bands, rows
    raise ValueError("no shape meets the target recall")


def _ngrams(t: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """N-gram hashes of all texts one after another, and where each text's begin."""
    at = t.word_offsets()
    words = np.diff(at)
    h = t.hashes()
    size = np.where(words == 0, 0, np.maximum(words - n + 1, 1))
    begin = np.concatenate(([0], np.cumsum(size)))
    first = np.repeat(at[:-1] - begin[:-1], size) + np.arange(begin[-1])
    out = np.zeros(len(first), dtype=np.uint64)
    short = np.repeat(words < n, size)
    last = np.repeat(at[1:], size)
    for k in range(n):
        with_word = first + k < last
        word = h[np.where(with_word, first + k, 0)] if len(h) else h
        out = np.where(with_word, mix(out + word + np.uint64(k + 1)), out)
    out[short] = mix(out[short] + np.uint64(0x5157))
    return out, begin


def _text_keys(t: Texts) -> list[bytes]:
    """128 bits of each text's word sequence."""
    at = t.word_offsets()
    h = t.hashes()
    place = np.arange(len(h), dtype=np.uint64) - np.repeat(at[:-1], np.diff(at)).astype(np.uint64)
    sums = []
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        v = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h ^ mix(place + np.uint64(seed))), dtype=np.uint64)))
        sums.append(mix(v[at[1:]] - v[at[:-1]] + np.diff(at).astype(np.uint64)))
    both = np.stack(sums, axis=1).astype(">u8").tobytes()
    return [both[16 * i:16 * i + 16] for i in range(t.n)]


def signatures(docs: DataFrame, n: int = N, bands: int | None = None, rows: int | None = None,
               text_col: str = "text") -> DataFrame:
    """``doc_id, tie, text_key, n_ngrams, bands`` per row; ``bands`` is empty for texts without words."""
    if bands is None or rows is None:
        bands, rows = bands_and_rows()
    rng = np.random.Generator(np.random.PCG64(4099))
    seeds = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    odds = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def sign(t: Texts) -> tuple[np.ndarray, list]:
        grams, begin = _ngrams(t, n)
        size = np.diff(begin)
        full = np.flatnonzero(size)
        out: list = [[] for _ in range(t.n)]
        if len(full):
            low = (grams >> np.uint64(32)).astype(np.uint32)
            hashes = np.zeros((len(full), bands), dtype=np.uint64)
            for b in range(bands):
                hashes[:, b] = np.uint64(b + 1)
                for k in range(b * rows, (b + 1) * rows):
                    least = np.minimum.reduceat((low ^ seeds[k]) * odds[k], begin[full])
                    hashes[:, b] = mix(hashes[:, b] + least)
            for i, row in zip(full.tolist(), hashes.view(np.int64)):
                out[i] = row
        return size, out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch.column(2)):
                size, band_hashes = sign(t)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.first, t.n), batch.column(1).slice(t.first, t.n),
                     pa.array(_text_keys(t), pa.binary()), pa.array(size.astype(np.int64)),
                     pa.array(band_hashes, pa.list_(pa.int64()))],
                    names=["doc_id", "tie", "text_key", "n_ngrams", "bands"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tie(docs).alias("tie"),
                        F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, tie long, text_key binary, n_ngrams long, bands array<long>"))


def _tie(docs: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Which pairs (left row, right row) reach the threshold; ``sets`` hold sorted distinct hashes."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    where = np.repeat(np.arange(len(sets)), size)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column)[column] > 1
    where, column = where[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    where, column = where[order], column[order]
    common = np.zeros((len(left), len(right)), dtype=np.float64)
    width = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, width, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, (lo, lo + COLUMNS_AT_ONCE))
        part = np.zeros((len(sets), min(COLUMNS_AT_ONCE, width - lo)), dtype=np.float32)
        part[where[a:b], column[a:b] - lo] = 1
        common += part[left] @ part[right].T
    p, q = threshold.numerator, threshold.denominator
    return (p + q) * common >= p * (size[left][:, None] + size[right][None, :])


def _forest(links: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component, for a symmetric link matrix."""
    label = np.arange(len(links))
    todo = np.ones(len(links), dtype=bool)
    for start in range(len(links)):
        if not todo[start]:
            continue
        front = np.zeros(len(links), dtype=bool)
        front[start] = True
        todo[start] = False
        while front.any():
            label[front] = start
            front = links[front].any(axis=0) & todo
            todo &= ~front
    return label


def _verify(threshold: Fraction):
    """For rows sorted by group: (text_key, hub, n_links) per text of each group; hub is null or the
    smallest key of its links' component within the group."""

    def group(i: int, j: int, keys: list[bytes], blocks: list[int], raw: list[bytes]):
        rows = sorted({k: r for r, k in enumerate(keys)}.items())  # a repeated row counts once
        keys = [k for k, _ in rows]
        sets = [np.frombuffer(raw[r], dtype=np.uint64) for _, r in rows]
        side = np.array([blocks[r] for _, r in rows])
        if len(keys) < 2:
            return
        left = np.flatnonzero(side == i)
        right = left if i == j else np.flatnonzero(side == j)
        if not len(left) or not len(right):
            return
        found = linked(sets, left, right, threshold)
        links = np.zeros((len(keys), len(keys)), dtype=bool)
        links[np.ix_(left, right)] = found
        links |= links.T
        np.fill_diagonal(links, False)
        label = _forest(links)
        degree = links.sum(axis=1)
        for r in np.flatnonzero(degree):
            yield keys[r], keys[label[r]], int(degree[r])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, blocks, raw, out = None, [], [], [], []

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.binary()),
                 pa.array([r[2] for r in out], pa.int64())], names=["text_key", "hub", "n_links"])

        for batch in batches:
            for c, i, j, key, block, ngrams in zip(*[batch.column(k).to_pylist() for k in range(6)]):
                if (c, i, j) != now:
                    if now is not None:
                        out.extend(group(now[1], now[2], keys, blocks, raw))
                    now, keys, blocks, raw = (c, i, j), [], [], []
                keys.append(key)
                blocks.append(block)
                raw.append(ngrams)
            if len(out) > 10_000:
                yield flush()
                out = []
        if now is not None:
            out.extend(group(now[1], now[2], keys, blocks, raw))
        yield flush()

    return run


def _ngram_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch.column(0)):
                grams, begin = _ngrams(t, n)
                keys, wanted = _text_keys(t), batch.column(1).slice(t.first, t.n).to_pylist()
                rows = [i for i in range(t.n) if keys[i] == wanted[i]]
                sets = [np.unique(grams[begin[i]:begin[i + 1]]).tobytes() for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(t.first, t.n).take(pa.array(rows, pa.int64())),
                     batch.column(3).slice(t.first, t.n).take(pa.array(rows, pa.int64())),
                     pa.array([keys[i] for i in rows], pa.binary()), pa.array(sets, pa.binary())],
                    names=["component", "blocks", "text_key", "ngrams"])

    return run


def _slim(spokes: DataFrame) -> DataFrame:
    """Edges ``a, b`` with the same components as all (text_key, hub) rows: one to its smallest hub for each
    text, and its other hubs' to that hub, each pair of hubs once. A text that many buckets or blocks hold
    so makes one edge, and the others are as few as the hubs that meet."""
    spokes = spokes.distinct()
    least = F.min("hub").over(Window.partitionBy("text_key"))
    both = spokes.withColumn("least", least)
    own = both.filter(F.col("hub") == F.col("least")).select(F.col("text_key").alias("a"), F.col("hub").alias("b"))
    met = both.filter(F.col("hub") != F.col("least")).select(F.col("hub").alias("a"), F.col("least").alias("b")).distinct()
    return own.unionByName(met)


def _join(docs: DataFrame, n: int, threshold: Fraction, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Signatures per row, and per text: ``text_key, rep, class, n_links, n_copies``; ``rep`` and
    ``class`` are (doc_id, tie) structs with null ids last."""
    bands, rows = bands_and_rows(float(threshold))
    signed = cut(signatures(docs, n, bands, rows, text_col), "signatures")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("tie"))
    texts = cut(signed.filter("n_ngrams > 0").groupBy("text_key")
                .agg(F.min(rank).alias("rep"), F.count(F.lit(1)).alias("n_copies"), F.first("n_ngrams").alias("n_ngrams"),
                     F.first("bands").alias("bands")), "texts")
    banded = texts.select("text_key", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("text_key").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = banded.join(hubs, "band").select(F.col("text_key").alias("a"), F.col("hub").alias("b"))
    near = components(_slim(stars.select(F.col("a").alias("text_key"), F.col("b").alias("hub")))).select(F.col("node").alias("text_key"), F.col("label").alias("component"))

    # whole n-gram sets of the texts that have candidates, dealt into blocks of their component
    weight = F.greatest("n_ngrams", F.lit(LEAST_WEIGHT))
    members = near.join(texts.select("text_key", "rep", "n_ngrams"), "text_key")
    sizes = members.groupBy(F.col("component").alias("c")).agg(
        F.ceil(F.sum(weight) / BLOCK_NGRAMS).cast("int").alias("blocks"))
    members = cut(members.join(sizes, F.col("component") == F.col("c"))
                  .select("text_key", "component", "blocks", F.col("rep.doc_id").alias("rep_id"),
                          F.col("rep.tie").alias("rep_tie")), "members")
    own = docs.select(F.col("doc_id").cast("long").alias("own_id"), _tie(docs).alias("own_tie"), F.col(text_col).cast("string").alias("text"))
    sets = (own.join(members.hint("shuffle_hash"), F.col("own_id").eqNullSafe(F.col("rep_id")) & (F.col("own_tie") == F.col("rep_tie")))
            .select("text", "text_key", "component", "blocks")
            .mapInArrow(_ngram_sets(n), "component binary, blocks int, text_key binary, ngrams binary"))
    block = F.pmod(F.xxhash64("text_key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = (sets.withColumn("block", block).withColumn("other", other)
               .select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                       "text_key", "block", "ngrams"))
    found = cut(grouped.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
                .mapInArrow(_verify(threshold), "text_key binary, hub binary, n_links long"), "links")
    degrees = found.groupBy("text_key").agg(F.sum("n_links").alias("n_links"))
    classes = components(_slim(found.select("text_key", "hub")))
    of_class = classes.join(texts.select(F.col("text_key").alias("node"), "rep"), "node")
    least = of_class.groupBy("label").agg(F.min("rep").alias("class"))
    named = of_class.join(least, "label").select(F.col("node").alias("text_key"), "class").join(degrees, "text_key")
    per_text = texts.select("text_key", "rep", "n_copies").join(named, "text_key", "left").select(
        "text_key", "rep", F.coalesce("class", "rep").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "n_copies")
    return signed, per_text


def similar_documents(docs: DataFrame, n: int = N, threshold: Fraction = THRESHOLD, text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``; ``class_id``, the smallest id of its class; ``n_links``, how many
    different texts are linked with its own; ``copy_of``, the smallest id with the same words;
    ``n_copies``, the rows with the same words."""
    signed, per_text = _join(docs, n, threshold, text_col)
    return (signed.select("doc_id", "text_key", "n_ngrams").join(per_text, "text_key", "left")
            .select("doc_id", F.when(F.col("n_ngrams") > 0, F.col("class.doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("n_ngrams") > 0, F.col("rep.doc_id")).otherwise(F.col("doc_id")).alias("copy_of"),
                    F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies")))


def keep_one(docs: DataFrame, n: int = N, threshold: Fraction = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents of which one of each class stays (the smallest id), with all their columns."""
    signed, per_text = _join(docs, n, threshold, text_col)
    heads = per_text.filter(F.col("rep") == F.col("class")).select("text_key", "rep")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("tie"))
    staying = (signed.join(heads, "text_key", "left").filter((F.col("n_ngrams") == 0) | (F.col("rep") == rank))
               .groupBy(F.col("doc_id").alias("s_id"), F.col("tie").alias("s_tie"))
               .agg(F.count(F.lit(1)).alias("n"), F.max("n_ngrams").alias("grams")))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = (docs.select(F.col("doc_id").cast("long").alias("r_id"), _tie(docs).alias("r_tie"), whole)
            .join(staying, F.col("r_id").eqNullSafe(F.col("s_id")) & (F.col("r_tie") == F.col("s_tie"))))
    once = (F.col("n") == 1) | (F.col("grams") == 0)
    # rows that are equal in every column have one staying copy
    kept = rows.filter(once).select("doc").unionByName(rows.filter(~once).select("doc").distinct())
    return kept.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
