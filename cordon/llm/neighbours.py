"""Approximate nearest neighbours over learned partitions of a neighbour graph.

Fit, on a sample of at most ``SAMPLE`` different vectors (the rows with the smallest hashes):

1. The exact neighbour graph of the sample, symmetric.
2. Balanced partitioning of that graph: bisection by its second eigenvector at the median, again and again
   into equal parts, then moves and swaps of nodes to the part that holds most of their neighbours, with
   every part held between bounds of its size.
3. A small classifier (one hidden layer) learns from a vector which parts its neighbours lie in.
4. The number of parts to probe is the smallest that finds ``TARGET`` of the true neighbours of sample
   vectors that the classifier has not seen. ``recall`` measures a search against brute force.

Index and search, over every row: equal vectors become one with their smallest ids (as many as an answer
can hold). Each vector goes to its most probable part, each query to its most probable parts. Parts are
dealt by hash into blocks of bounded size, queries likewise, and each pair of blocks is one group of rows, so
a part with a third of all vectors is many groups. In a group a matrix product finds all vectors that
rounding could put among the nearest, and these are measured again from the differences of the original
entries; the best of all groups are merged by a window that keeps that many rows before the shuffle.

Vectors that are null, zero, or have null or non-finite entries take no part, nor do vectors of another
length than the commonest one (of two as common, the longer) and rows without id. Rows that are equal in
id and vector are one row; a row's own is the row with its id and vector, so a copy under another id is a
candidate at distance 0. Ties go to the smaller id. With fewer candidates than asked for all those probed
are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cordon.llm.shared import cut
from cordon.llm.vectors import finite, matrix, usual_length

K = 10
SAMPLE = 16_384
PART_SAMPLE = 256  # of the sample's vectors in a part
GRAPH_NEIGHBOURS = 10
HIDDEN = 128
EPOCHS = 30
TARGET = 0.95
ROWS_BLOCK = 16_384
QUERY_BLOCK = 4_096
AT_ONCE = 256
SLACK = 1e-9  # of the squared lengths: above the rounding of a matrix product, below any real difference


# -- the model, fitted on the bounded sample -------------------------------------------------------

def nearest_in(x: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of x for each of its rows named, the row itself left out."""
    squares = (x * x).sum(axis=1)
    out = np.empty((len(queries), min(k, len(x) - 1)), dtype=np.int64)
    for at in range(0, len(queries), AT_ONCE):
        rows = queries[at:at + AT_ONCE]
        d = squares[None, :] - 2 * (x[rows] @ x.T)
        d[np.arange(len(rows)), rows] = np.inf
        near = np.argpartition(d, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
        order = np.argsort(np.take_along_axis(d, near, axis=1), axis=1, kind="stable")
        out[at:at + AT_ONCE] = np.take_along_axis(near, order, axis=1)
    return out


def graph_edges(neighbours: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both directions of every edge, once."""
    n = len(neighbours)
    a, b = np.repeat(np.arange(n), neighbours.shape[1]), neighbours.ravel()
    codes = np.unique(np.concatenate((a * n + b, b * n + a)))
    return codes // n, codes % n


def _bisector(a: np.ndarray, b: np.ndarray, n: int, rng) -> np.ndarray:
    """About the second eigenvector of the normalised graph, by power iteration."""
    degree = np.maximum(np.bincount(a, minlength=n), 1).astype(float)
    first = np.sqrt(degree) / np.linalg.norm(np.sqrt(degree))
    v = rng.standard_normal(n)
    for _ in range(60):
        v -= first * (first @ v)
        w = v / np.sqrt(degree)
        v = v + np.bincount(a, weights=w[b], minlength=n) / np.sqrt(degree)  # shifted, so that all are positive
        v /= np.linalg.norm(v) or 1.0
    return (v - first * (first @ v)) / np.sqrt(degree)


def balanced_parts(a: np.ndarray, b: np.ndarray, n: int, parts: int, slack: float = 0.1, rounds: int = 12) -> np.ndarray:
    """A part for each node: ``parts`` (a power of two) parts of about equal size with few edges between them."""
    rng = np.random.Generator(np.random.PCG64(7))
    part = np.zeros(n, dtype=np.int64)
    for level in range(parts.bit_length() - 1):
        finer = np.empty(n, dtype=np.int64)
        for p in range(1 << level):
            nodes = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            inside = (place[a] >= 0) & (place[b] >= 0)
            v = _bisector(place[a[inside]], place[b[inside]], len(nodes), rng)
            order = np.argsort(v, kind="stable")
            half = np.zeros(len(nodes), dtype=np.int64)
            half[order[len(nodes) // 2:]] = 1
            finer[nodes] = 2 * p + half
        part = finer
    least, most = int(n / parts * (1 - slack)), int(np.ceil(n / parts * (1 + slack)))
    for _ in range(rounds):
        wish = np.zeros((n, parts), dtype=np.int32)
        np.add.at(wish, (a, part[b]), 1)
        best = wish.argmax(axis=1)
        gain = wish[np.arange(n), best] - wish[np.arange(n), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for node in np.argsort(-gain, kind="stable"):
            if gain[node] <= 0:
                break
            here, there = part[node], best[node]
            if size[there] < most and size[here] > least and rng.random() < 0.7:  # neighbours do not all change places
                part[node] = there
                size[here] -= 1
                size[there] += 1
                moved += 1
        if moved <= n // 1000:
            break
    return part


@dataclass
class Router:
    """A classifier from a vector to the parts its neighbours lie in."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(x * self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def parts(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The most probable parts of each vector, the likeliest first."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :probes]


def train(x: np.ndarray, wanted: np.ndarray, epochs: int = EPOCHS) -> Router:
    """Least cross entropy to ``wanted`` (a row of shares for each vector), by Adam in small batches."""
    rng = np.random.Generator(np.random.PCG64(11))
    n, dims = x.shape
    scale = 1 / (np.sqrt((x * x).mean()) or 1.0)
    w = [rng.standard_normal((dims, HIDDEN)) * np.sqrt(2 / dims), np.zeros(HIDDEN),
         rng.standard_normal((HIDDEN, wanted.shape[1])) * np.sqrt(1 / HIDDEN), np.zeros(wanted.shape[1])]
    mean, square = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step = 0
    for epoch in range(epochs):
        rate = 0.004 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(n)
        for at in range(0, n, 256):
            rows = order[at:at + 256]
            xs = x[rows] * scale
            hidden = np.maximum(xs @ w[0] + w[1], 0)
            s = hidden @ w[2] + w[3]
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            back = (p - wanted[rows]) / len(rows)
            below = (back @ w[2].T) * (hidden > 0)
            step += 1
            for i, g in enumerate((xs.T @ below, below.sum(axis=0), hidden.T @ back, back.sum(axis=0))):
                mean[i] += 0.1 * (g - mean[i])
                square[i] += 0.001 * (g * g - square[i])
                w[i] = w[i] - rate * (mean[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    return Router(scale, *w)


def fit(x: np.ndarray, k: int = K, target: float = TARGET, part_sample: int = PART_SAMPLE) -> Router:
    """The router of a sample of different vectors."""
    n, dims = x.shape
    parts = 1 << max(0, (n // part_sample).bit_length() - 1)
    if parts == 1:
        return Router(1.0, np.zeros((dims, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    near = nearest_in(x, np.arange(n), GRAPH_NEIGHBOURS)
    part = balanced_parts(*graph_edges(near), n, parts)
    wanted = np.zeros((n, parts))
    wanted[np.arange(n), part] = 1
    np.add.at(wanted, (np.repeat(np.arange(n), near.shape[1]), part[near].ravel()), 1)
    wanted /= wanted.sum(axis=1, keepdims=True)
    # how many parts it takes is measured on vectors that this first classifier has not seen
    seen = np.arange(n) % 8 != 0
    asked = np.flatnonzero(~seen)
    trial = train(x[seen], wanted[seen])
    ranked = trial.parts(x[asked], parts)
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.arange(parts)[None, :].repeat(len(asked), axis=0), axis=1)
    home = trial.parts(x, 1)[:, 0]
    truth = nearest_in(x, asked, k)
    found = np.bincount(np.take_along_axis(place, home[truth], axis=1).ravel(), minlength=parts).cumsum() / truth.size
    router = train(x, wanted)
    router.probes = min(parts, int(np.searchsorted(found, target)) + 1)
    return router


# -- the index and the search ----------------------------------------------------------------------

def _sound(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter(F.col("vec_id").isNotNull() & finite(F.col("v")) & F.exists("v", lambda c: c != 0))
    dims = usual_length(rows, "v")
    return rows.filter(F.size("v") == dims), dims


def _model(different: DataFrame, dims: int, k: int, sample: int, target: float) -> Router | None:
    drawn = different.select(F.xxhash64("v").alias("h"), "v").orderBy("h").limit(sample).toArrow()
    if drawn.num_rows == 0:
        return None
    x = np.concatenate([matrix(c, dims) for c in drawn.column("v").chunks if len(c)])
    return fit(x, k, target)


def _routed(rows: DataFrame, router: Router, dims: int, probes: int) -> DataFrame:
    """Every row once for each of its parts, in a column ``part``; the vectors are in column ``v``."""
    schema = StructType([*rows.schema.fields, StructField("part", IntegerType())])
    names = [*rows.columns, "part"]
    at = names.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                parts = router.parts(matrix(batch.column(at), dims), probes)
                again = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), parts.shape[1])))
                yield pa.RecordBatch.from_arrays([*again.columns, pa.array(parts.ravel().astype(np.int32))],
                                                 names=names)

    return rows.mapInArrow(run, schema)


def block_nearest(rows: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the rows that may be among its k nearest, with their exact distances."""
    squares = (rows * rows).sum(axis=1)
    for at in range(0, len(queries), AT_ONCE):
        q = queries[at:at + AT_ONCE]
        own = (q * q).sum(axis=1)
        with np.errstate(all="ignore"):
            d = squares[None, :] - 2 * (q @ rows.T)
            d[np.isnan(d)] = -np.inf  # entries too large for a product are measured from the differences
            bound = np.partition(d, min(k, len(rows)) - 1, axis=1)[:, min(k, len(rows)) - 1]
            bound = bound + SLACK * (own + squares.max())
            for i in range(len(q)):
                near = np.flatnonzero(d[i] <= bound[i])
                yield at + i, near, np.sqrt(((rows[near] - q[i]) ** 2).sum(axis=1))


FOUND_SCHEMA = "q array<double>, vec_id long, score double"


def _search_blocks(dims: int, k: int):
    """For rows sorted by (part, i, j): the ``k`` nearest of each query within its group."""

    def group(rows: list, ids: list, queries: list) -> Iterator[pa.RecordBatch]:
        if not rows or not queries:
            return
        x, q = np.concatenate(rows), np.concatenate(queries)
        of, flat = np.repeat(np.arange(len(ids)), [len(i) for i in ids]), np.concatenate(ids)
        begin = np.searchsorted(of, np.arange(len(ids) + 1))
        asked, found, scores = [], [], []
        for i, near, d in block_nearest(x, q, k):
            width = begin[near + 1] - begin[near]
            own = np.concatenate([flat[begin[r]:begin[r + 1]] for r in near])
            d = np.repeat(d, width)
            best = np.lexsort((own, d))[:k]
            asked.append(np.full(len(best), i))
            found.append(own[best])
            scores.append(d[best])
        asked = np.concatenate(asked)
        for lo in range(0, len(asked), 8192):
            at = asked[lo:lo + 8192]
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * dims), pa.array(q[at].ravel()))
            yield pa.RecordBatch.from_arrays(
                [vectors, pa.array(np.concatenate(found)[lo:lo + 8192]), pa.array(np.concatenate(scores)[lo:lo + 8192])],
                names=["q", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, ids, queries = None, [], [], []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                key = tuple(keys[:, lo].tolist())
                if key != now:
                    yield from group(rows, ids, queries)
                    now, rows, ids, queries = key, [], [], []
                x = matrix(batch.column(3).slice(lo, hi - lo), dims)
                lists = batch.column(4).slice(lo, hi - lo)
                is_row = lists.is_valid().to_numpy(zero_copy_only=False)
                if is_row.any():
                    rows.append(x[is_row])
                    ids.extend(np.array(i, dtype=np.int64) for i in lists.filter(pa.array(is_row)).to_pylist())
                if not is_row.all():
                    queries.append(x[~is_row])
        yield from group(rows, ids, queries)

    return run


def _least(rows: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows of each key, cut to k a task before they are shuffled."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
            sample: int = SAMPLE, target: float = TARGET, probes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` (Euclidean distance) for the rows that meet ``is_query``, an expression
    over ``vec_id``, against all rows; ``probes`` overrides the number of parts to look into."""
    spark = vectors.sparkSession
    rows, dims = _sound(vectors, id_col, vector_col)
    rows = cut(rows, "vectors").distinct()
    held = _least(rows, ["v"], ["vec_id"], k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    different = cut(held, "different-vectors")
    router = _model(different, dims, k, sample, target)
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "v")
    homes = cut(_routed(different, router, dims, 1), "homes")
    asked = cut(_routed(queries.select("v").distinct(), router, dims, probes or router.probes), "routed-queries")
    blocks = F.broadcast(  # one row a part
        homes.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / ROWS_BLOCK).cast("int").alias("rb"))
        .join(asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("qb")), "part"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    deal = lambda n: F.pmod(F.xxhash64("v"), n).cast("int")
    left = homes.join(blocks, "part").select("part", deal(F.col("rb")).alias("i"), every(F.col("qb")).alias("j"), "v", "ids")
    right = asked.join(blocks, "part").select("part", every(F.col("rb")).alias("i"), deal(F.col("qb")).alias("j"), "v",
                                              F.lit(None).cast("array<long>").alias("ids"))
    found = (left.unionByName(right).repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")
             .mapInArrow(_search_blocks(dims, k + 1), FOUND_SCHEMA))
    best = cut(_least(found, ["q"], ["score", "vec_id"], k + 1).drop("rank"), "found")
    pairs = queries.join(best, F.col("v") == F.col("q")).filter((F.col("vec_id") != F.col("query_id")) | (F.col("score") > 0))
    return _least(pairs.select("query_id", "vec_id", "score", "v"), ["query_id", "v"], ["score", "vec_id"], k) \
        .select("query_id", "rank", "vec_id", "score")


def recall(vectors: DataFrame, found: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Share of the true neighbours among those found, by brute force on the driver: for tables that fit there."""
    rows, dims = _sound(vectors, id_col, vector_col)
    table = rows.toArrow()
    ids = table.column("vec_id").to_numpy()
    x = np.concatenate([matrix(c, dims) for c in table.column("v").chunks if len(c)])
    where = {int(v): i for i, v in enumerate(ids)}
    got: dict[int, list[int]] = {}
    for r in found.select("query_id", "vec_id").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = total = 0
    for query, answers in got.items():
        d = np.sqrt(((x - x[where[query]]) ** 2).sum(axis=1))
        d[where[query]] = np.inf
        truth = np.lexsort((ids, d))[:len(answers)]
        hits += len(set(ids[truth].tolist()) & set(answers))
        total += len(answers)
    return hits / max(total, 1)
