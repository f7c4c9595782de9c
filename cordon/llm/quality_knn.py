"""Quality by nearest-neighbour voting over latent-semantic vectors.

Features of a whole text, from its words only: hashed word counts, hashed word shapes (which kinds of
characters, the closing mark and whether it is doubled, a length class), and shares of repeated words
and lines. Counts are damped by a logarithm and weighted by inverse document frequency over all rows of
the corpus, which one pass counts (``frequencies``; FEATURES sums).

``fit`` takes a bounded, stratified sample of labelled documents (``PER_CLASS`` of each label, those
with the smallest hash of their id; a documented bound), turns it into feature rows on the executors
and finds the latent space by a singular value decomposition of those few thousand rows. The model is
two small arrays: the projection (FEATURES x DIMENSIONS) and the labelled vectors
(at most 2 * PER_CLASS x DIMENSIONS), about 2 MB whatever the corpus holds, and goes to all tasks as
a broadcast variable.

``score`` computes the exact cosine of every document with every labelled vector, in blocks of
documents, takes the ``NEIGHBOURS`` nearest and weights their labels by similarity. As the sample is
stratified, a vote also counts by its label's share among all labelled documents.

Edge cases: an empty or null text has a zero vector, so no neighbour is nearer than another; its score
is the share of label 1. Without labelled documents every score is 0.5. Rows without a label or with
a null id are never learned from; repeated rows get equal scores; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cordon.llm.rules import CAPITAL, SMALL, _line_counts, _repeat_words, _running
from cordon.llm.words import Texts, mix, slices

WORD_BUCKETS = 512
SHAPE_BUCKETS = 256
SHARES = 3
FEATURES = WORD_BUCKETS + SHAPE_BUCKETS + SHARES
DIMENSIONS = 48
PER_CLASS = 2048
NEIGHBOURS = 25
DOCS_AT_ONCE = 512
THRESHOLD = 0.3
BLOCK_WEIGHTS = (0.4, 1.0, 1.0)
DIGIT = np.zeros(256, dtype=bool)
DIGIT[ord("0"):ord("9") + 1] = True


def features(t: Texts) -> np.ndarray:
    """Raw counts by bucket, then the shares; one row per text."""
    out = np.zeros((t.n, FEATURES), dtype=np.float32)
    if not len(t.starts):
        return out
    size = t.ends - t.starts

    def within(flags: np.ndarray) -> np.ndarray:
        found = _running(flags[t.data])
        return found[t.ends] - found[t.starts]

    small, capital, digit = within(SMALL), within(CAPITAL), within(DIGIT)
    wide = _running(t.data >= 128)
    wide = wide[t.ends] - wide[t.starts]
    last, before = t.data[t.ends - 1], t.data[np.maximum(t.ends - 2, t.starts)]
    mark = np.where(SMALL[last] | CAPITAL[last] | DIGIT[last] | (last >= 128), 0, last).astype(np.uint64)
    shape = (np.minimum(small, 1) | np.minimum(capital, 2) << 1 | np.minimum(digit, 2) << 3 | np.minimum(wide, 1) << 5
             | (last == before) << 6 | np.minimum(size // 4, 5) << 7).astype(np.uint64)
    shape = mix(shape | mark << np.uint64(16)) % np.uint64(SHAPE_BUCKETS)
    word = t.hashes() % np.uint64(WORD_BUCKETS)
    cell = t.text_of.astype(np.int64) * FEATURES
    counts = np.bincount(np.concatenate([cell + word.astype(np.int64), cell + WORD_BUCKETS + shape.astype(np.int64)]),
                         minlength=t.n * FEATURES)
    out[:] = counts.reshape(t.n, FEATURES)
    words = np.maximum(np.bincount(t.text_of, minlength=t.n), 1)
    lines, again = _line_counts(t)
    out[:, -3] = _repeat_words(t) / words
    out[:, -2] = again / np.maximum(lines, 1)
    out[:, -1] = 1 / np.sqrt(words)
    return out


def weighted(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped, weighted features; words and shapes have unit length each before their block's weight."""
    x = np.log1p(raw) * idf
    x[:, -SHARES:] = raw[:, -SHARES:] * BLOCK_WEIGHTS[2]
    for lo, hi, weight in ((0, WORD_BUCKETS, BLOCK_WEIGHTS[0]), (WORD_BUCKETS, WORD_BUCKETS + SHAPE_BUCKETS, BLOCK_WEIGHTS[1])):
        x[:, lo:hi] *= weight / np.maximum(np.linalg.norm(x[:, lo:hi], axis=1, keepdims=True), 1e-9)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    vote: np.ndarray  # weight of a vote for label 0 and for label 1
    prior: float

    def vectors_of(self, raw: np.ndarray) -> np.ndarray:
        return _unit(weighted(raw, self.idf) @ self.projection)

    def score(self, raw: np.ndarray) -> np.ndarray:
        out = np.full(len(raw), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        if k == 0:
            return out
        for lo in range(0, len(raw), DOCS_AT_ONCE):
            near = self.vectors_of(raw[lo:lo + DOCS_AT_ONCE]) @ self.vectors.T
            top = np.argpartition(near, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(near, top, axis=1), 0.0).astype(np.float64) ** 8
            label = self.labels[top]
            weight *= self.vote[label]
            total = weight.sum(axis=1)
            good = (weight * label).sum(axis=1)
            out[lo:lo + DOCS_AT_ONCE] = np.where(total > 0, good / np.where(total > 0, total, 1), self.prior)
        out[raw[:, :WORD_BUCKETS].sum(axis=1) == 0] = self.prior
        return np.clip(out, 0.0, 1.0)


def fit_rows(raw: np.ndarray, labels: np.ndarray, totals: tuple[int, int],
             corpus: tuple[np.ndarray, int] | None = None) -> Model:
    """Model from feature rows of the sample; ``totals`` are the labelled documents with label 0 and 1;
    ``corpus`` has the document frequencies and the number of documents (without it, the sample's)."""
    known = sum(totals)
    prior = totals[1] / known if known else 0.5
    if not len(labels):
        return Model(np.ones(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32),
                     labels, np.ones(2), prior)
    with_feature, n = ((raw > 0).sum(axis=0), len(raw)) if corpus is None else corpus
    idf = (np.log((1 + n) / (1 + with_feature)) + 0.1).astype(np.float32)
    x = weighted(raw, idf)
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    projection = np.ascontiguousarray(axes[:DIMENSIONS].T, dtype=np.float32)
    vote = np.array([totals[c] / max(1, (labels == c).sum()) for c in (0, 1)]) / known
    return Model(idf, projection, _unit(x @ projection), labels, vote, prior)


def _feature_rows(docs: DataFrame, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in slices(batch.column(1)):
                raw = [row.tobytes() for row in features(t)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.first, t.n), pa.array(raw, pa.binary()), batch.column(2).slice(t.first, t.n)],
                    names=["label", "raw", "l_id"])

    return docs.select("label", F.col(text_col).cast("string").alias("text"), "l_id") \
        .mapInArrow(run, "label int, raw binary, l_id long")


def frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many rows each feature is, and the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(FEATURES + 1, dtype=np.int64)
        for batch in batches:
            for t in slices(batch.column(0)):
                found[:-1] += (features(t) > 0).sum(axis=0)
                found[-1] += t.n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1)), pa.array(found)], names=["feature", "n"])

    rows = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "feature long, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")).collect())  # one row a feature
    out = np.zeros(FEATURES + 1, dtype=np.int64)
    for r in rows:
        out[r["feature"]] = r["n"]
    return out[:-1], int(out[-1])


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", per_class: int = PER_CLASS) -> Model:
    """Learn from ``labels`` (doc_id, quality), of which rows that hold back a document are left out by the
    caller. At most ``per_class`` documents of each label are learned from; document frequencies are of all."""
    known = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("label")) \
        .filter("l_id IS NOT NULL AND label IN (0, 1)").distinct()
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for c in (0, 1):
        part = known.filter(F.col("label") == c).orderBy(F.xxhash64("l_id"), "l_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col)
    sample = own.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))  # 2 * per_class rows
    rows = (_feature_rows(sample, text_col).groupBy("l_id", "label").agg(F.min("raw").alias("raw"))
            .orderBy("label", "l_id").collect())  # one row an id of the sample
    raw = np.array([np.frombuffer(r["raw"], dtype=np.float32) for r in rows]).reshape(len(rows), FEATURES)
    y = np.array([r["label"] for r in rows], dtype=np.int64)
    return fit_rows(raw, y, (totals.get(0, 0), totals.get(1, 0)), frequencies(docs, text_col) if len(rows) else None)


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for t in slices(batch.column(1)):
                p = own.score(features(t))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.first, t.n), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, score double, predicted int")
