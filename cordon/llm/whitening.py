"""Embedding whitening from exact second moments, by bit-sliced scatter.

Every entry c becomes the whole number x = floor(``SCALE`` * c) + ``SHIFT``; all sums over x are exact.

1. One pass finds each dimension's least and largest x. Less the least one, an entry is a number of few
   bits, which changes no covariance.
2. One pass forms the scatter. In blocks of rows, bit k of dimension i is packed across the rows into
   64-bit words (a bit plane). The product sum of two dimensions is the sum over their planes of
   2 ** (k + l) * popcount(plane ik AND plane jl). A task adds its blocks' sums in limbs of 30 bits, and
   Spark adds the tasks' limbs as longs, one row per pair and limb, so nothing overflows.
3. n * sum(xi * xj) - sum(xi) * sum(xj) is the centred scatter times n, a whole number of any size;
   divided by n * n it is the covariance, rounded once. Its eigenvectors come from ``eigh``.
4. One pass measures how far the whitened rows' covariance is from the identity.

What reaches the driver are D * (D + 1) / 2 sums for D dimensions, whatever the number of rows.

Vectors that are null or have null or non-finite entries are dropped. Vectors of another length than the
commonest one (of two as common, the longer) are dropped too, as no covariance joins them. An entry whose
x does not fit a long is held at the largest or smallest long. Components whose eigenvalue is 0 to double
precision have no whitened value and are left out; each eigenvector's largest entry is positive. Null ids
are kept, repeated rows count each, ties of eigenvalues are in the order of ``eigh``, a deviation beyond a
long is null, an empty table gives no rows, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cordon.llm.shared import cut
from cordon.llm.vectors import finite, matrix, usual_length

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
BLOCK_ROWS = 1 << 13
LIMB_BITS = 30
OUT_ROWS = 2048
LONG_MAX = (1 << 63) - 1


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
                  shift: int = SHIFT) -> tuple[DataFrame, int]:
    """``vec_id, x`` of the vectors that take part, as a written table, and their length."""
    sound = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter(finite(F.col("v")))
    dims = usual_length(sound, "v")
    x = F.transform("v", lambda c: F.least(F.floor(c * scale), F.lit(LONG_MAX - shift)) + F.lit(shift).cast("long"))
    return cut(sound.filter(F.size("v") == dims).select("vec_id", x.alias("x")), "whole-vectors"), dims


def _by_task(rows: DataFrame, column: str, fold, schema: str) -> DataFrame:
    """One row per task: ``fold`` gets the task's Arrow columns one after another and returns a dict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = fold(batch.column(0) for batch in batches if batch.num_rows)
        if found is not None:
            yield pa.RecordBatch.from_pylist([found], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return rows.select(column).mapInArrow(run, schema)


def _offsets(x: np.ndarray, least: np.ndarray) -> np.ndarray:
    """x - least, which may need all 64 bits."""
    return x.view(np.uint64) - least.view(np.uint64)


def bit_planes(y: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Plane of every dimension and bit, dimension after dimension: row r is bit r % 64 of word r // 64."""
    pad = np.zeros((-len(y) % 64, y.shape[1]), dtype=np.uint64)
    y = np.ascontiguousarray(np.concatenate((y, pad)).T)
    planes = [np.packbits(((y[d] >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), bitorder="little")
              for d in range(len(widths)) for k in range(int(widths[d]))]
    return np.stack(planes).view(np.uint64) if planes else np.zeros((0, len(y) // 64), np.uint64)


def block_sums(y: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the dimensions, and of the products of every pair i <= j in row order, from the planes of a
    block of rows; as Python's whole numbers if 64 bits may not hold them."""
    planes = bit_planes(y, widths)
    begin = np.concatenate(([0], np.cumsum(widths)))
    kind = np.int64 if 2 * int(widths.max()) + len(y).bit_length() < 63 else object
    weight = np.array([1 << k for width in widths.tolist() for k in range(width)], dtype=object).astype(kind)
    sums = np.add.reduceat(np.bitwise_count(planes).sum(axis=1, dtype=np.int64) * weight, begin[:-1])
    products = []
    for i in range(len(widths)):
        lo, hi = begin[i], begin[i + 1]
        both = np.stack([np.bitwise_count(plane & planes[lo:]).sum(axis=1, dtype=np.int64) for plane in planes[lo:hi]])
        products.append(np.add.reduceat((both * weight[lo:hi, None]).sum(axis=0) * weight[lo:], begin[i:-1] - lo))
    return sums, np.concatenate(products)


def _limbs(values: np.ndarray, n_limbs: int) -> np.ndarray:
    mask = (1 << LIMB_BITS) - 1
    if values.dtype == np.int64:  # of which all further limbs are 0
        n_own = min(n_limbs, 3)
        return np.stack([*[(values >> (LIMB_BITS * k)) & mask for k in range(n_own)],
                         *[np.zeros_like(values)] * (n_limbs - n_own)])
    return np.stack([((values >> (LIMB_BITS * k)) & mask).astype(np.int64) for k in range(n_limbs)])


@dataclass
class Moments:
    n: int
    least: np.ndarray
    sums: list[int]  # of x - least
    products: list[int]  # of (xi - least i)(xj - least j), i <= j in row order

    def covariance(self) -> np.ndarray:
        dims = len(self.sums)
        out = np.zeros((dims, dims))
        at = iter(self.products)
        for i in range(dims):
            for j in range(i, dims):
                out[i, j] = out[j, i] = (self.n * next(at) - self.sums[i] * self.sums[j]) / (self.n * self.n)
        return out


def moments(rows: DataFrame, dims: int) -> Moments:
    """Exact count, sums and product sums of the whole-number vectors."""

    def bounds(columns):
        low = high = None
        n = 0
        for column in columns:
            x = matrix(column, dims)
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
            n += len(x)
        return None if low is None else {"n": n, "low": low.tolist(), "high": high.tolist()}

    per_task = _by_task(rows, "x", bounds, "n long, low array<long>, high array<long>")
    found = (per_task.select("n", F.posexplode(F.arrays_zip("low", "high")).alias("d", "b")).groupBy("d")
             .agg(F.sum("n").alias("n"), F.min("b.low").alias("low"), F.max("b.high").alias("high"))
             .orderBy("d").collect())  # one row a dimension
    if not found:
        return Moments(0, np.zeros(0, np.int64), [], [])
    least = np.array([r["low"] for r in found], dtype=np.int64)
    widths = np.array([max(1, (r["high"] - r["low"]).bit_length()) for r in found])
    n_limbs = -(-(2 * int(widths.max()) + BLOCK_ROWS.bit_length()) // LIMB_BITS)  # those of a block's sums

    def scatter(columns):
        total = np.zeros((n_limbs, dims + dims * (dims + 1) // 2), dtype=np.int64)
        for column in columns:
            x = matrix(column, dims)
            for at in range(0, len(x), BLOCK_ROWS):
                total += _limbs(np.concatenate(block_sums(_offsets(x[at:at + BLOCK_ROWS], least), widths)), n_limbs)
        return {"v": total.T.ravel().tolist()}

    total = (_by_task(rows, "x", scatter, "v array<long>").select(F.posexplode("v").alias("p", "v"))
             .groupBy("p").agg(F.sum("v").alias("v")).orderBy("p").collect())  # as many as pairs of dimensions
    flat = [int(r["v"]) for r in total]
    values = [sum(flat[i + limb] << (LIMB_BITS * limb) for limb in range(n_limbs)) for i in range(0, len(flat), n_limbs)]
    return Moments(int(found[0]["n"]), least, values[:dims], values[dims:])


@dataclass
class Whitening:
    moments: Moments
    axes: np.ndarray  # one column a component
    eigenvalues: np.ndarray
    explained: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.moments.n for s in self.moments.sums])
        return (_offsets(x, self.moments.least).astype(np.float64) - mean) @ (self.axes / np.sqrt(self.eigenvalues))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - S) ** 2, exact."""
        y, n, sums = _offsets(x, self.moments.least), self.moments.n, self.moments.sums
        if len(y) == 0:
            return []
        largest = n * int(y.max())
        if largest < 1 << 62 and len(sums) * max(largest, max(sums)) ** 2 < 1 << 62:
            a = y.astype(np.int64) * n - np.array(sums, dtype=np.int64)
            return (a * a).sum(axis=1).tolist()
        a = y.astype(object) * n - np.array(sums, dtype=object)
        return (a * a).sum(axis=1).tolist()


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    m = moments(rows, dims)
    if m.n == 0:
        return Whitening(m, np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    v = m.covariance()
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    full = int((values > max(values[0], 0) * dims * np.finfo(float).eps).sum())
    k = min(components, full)
    top = vectors[:, :k]
    sign = np.sign(top[np.abs(top).argmax(axis=0), np.arange(k)])
    return Whitening(m, top * sign, values[:k], values[:k] / np.trace(v))


def identity_error(rows: DataFrame, model: Whitening, dims: int) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity. The rows are centred by
    their exact mean before they are multiplied."""
    k = model.axes.shape[1]
    upper = np.triu_indices(k)

    def products(columns):
        total = np.zeros((k, k))
        for column in columns:
            z = model.whiten(matrix(column, dims))
            total += z.T @ z
        return {"v": total[upper].tolist()}

    total = (_by_task(rows, "x", products, "v array<double>").select(F.posexplode("v").alias("p", "v"))
             .groupBy("p").agg(F.sum("v").alias("v")).orderBy("p").collect())  # pairs of components
    covariance = np.array([r["v"] for r in total]) / model.moments.n
    return float(np.abs(covariance - (upper[0] == upper[1])).max())


WHITE_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per vector and component: ``vec_id, component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``."""
    rows, dims = whole_numbers(vectors, id_col, vector_col, scale, shift)
    model = fit(rows, dims, components)
    k = model.axes.shape[1] if model.moments.n else 0
    if k == 0:
        return vectors.sparkSession.createDataFrame([], WHITE_SCHEMA)
    error = identity_error(rows, model, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, OUT_ROWS):
                batch = whole.slice(at, OUT_ROWS)
                x, m = matrix(batch.column(1), dims), batch.num_rows
                owner = pa.array(np.repeat(np.arange(m), k))
                deviation = pa.array([d if d <= LONG_MAX else None for d in model.deviations(x)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, model.moments.n, dtype=np.int64)), deviation.take(owner),
                     pa.array(model.whiten(x).ravel()), pa.array(np.tile(model.explained, m)),
                     pa.array(np.full(m * k, error))],
                    names=[f.split()[0] for f in WHITE_SCHEMA.split(", ")])

    return rows.mapInArrow(run, WHITE_SCHEMA)
