"""Whitening against numpy on whole tables, and bit-sliced sums against plain whole-number arithmetic."""

import math
import random

import numpy as np
import pytest

from cordon.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def sound(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, dims, components=32):
    fit = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if sound(v) and len(v) == dims]
    x = np.array([v for _, v in fit], dtype=np.float64)
    n, s = len(fit), [sum(v[d] for _, v in fit) for d in range(dims)]
    centred = x - np.array(s) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > values[0] * dims * np.finfo(float).eps).sum()))
    deviation = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for _, v in fit]
    return [i for i, _ in fit], centred @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum(), deviation


def check(spark, rows, dims, df=None):
    got = whitening.whiten(df if df is not None else table(spark, [(i, v, 0) for i, v in rows])).collect()
    ids, z, explained, deviation = brute(rows, dims)
    k = z.shape[1]
    assert len(got) == len(ids) * k and {r.n for r in got} == {len(ids)}
    assert all(abs(r.identity_error) < 1e-6 for r in got) and len({r.identity_error for r in got}) == 1
    for c in range(k):
        mine = sorted((str(r.vec_id), r.whitened) for r in got if r.component == c + 1)
        want = sorted((str(i), v) for i, v in zip(ids, z[:, c]))
        other = sorted((str(i), -v) for i, v in zip(ids, z[:, c]))
        assert any(all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-6 for a, b in zip(mine, w)) for w in (want, other))
    assert np.allclose([next(r.explained for r in got if r.component == c + 1) for c in range(k)], explained, rtol=1e-9)
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted((str(i), d) for i, d in zip(ids, deviation))


def test_random_vectors_with_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + d) for d in range(6)]) for i in range(300)]
    rows += [(None, [0.5] * 6), (7, None), (8, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (9, [float("nan")] * 6), (10, [float("inf")] + [0.0] * 5),
             (11, [1.0, 2.0]), (12, []), rows[0], rows[0]]
    check(spark, rows, 6)
    clashing = table(spark, [(i, v, 0) for i, v in rows]).selectExpr("*", "1 AS n", "'x' AS x", "2 AS component", "3 AS v", "4 AS deviation")
    check(spark, rows, 6, clashing)


def test_more_dimensions_than_components_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 50)
    rng = random.Random(4)
    check(spark, [(i, [rng.gauss(0, 1 + d / 10) for d in range(40)]) for i in range(333)], 40)


def test_constant_and_dependent_dimensions_are_left_out(spark):
    rng = random.Random(5)
    rows = [(i, [a, 0.25, a, b]) for i in range(100) for a, b in [(rng.randint(-3, 3) / 4, rng.randint(-3, 3) / 4)]]
    got = whitening.whiten(table(spark, [(i, v, 0) for i, v in rows])).collect()
    assert {r.component for r in got} == {1, 2}
    assert whitening.whiten(table(spark, [(1, [0.5, 0.5], 0)] * 3)).count() == 0  # no variance at all


def test_empty_table(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None, 0), (2, [], 0)])).collect() == []


def test_entries_beyond_a_long_are_held(spark):
    rows = [(i, [float(i), s * 1e300, 2.0 ** 40 * i]) for i in range(8) for s in (1, -1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole, dims = whitening.whole_numbers(df)
    assert {r.x[1] for r in whole.collect()} == {(1 << 63) - 1, -(1 << 63) + 1_000_000}
    m = whitening.moments(whole, dims)
    x = [r.x for r in whole.collect()]
    low = [min(v[d] for v in x) for d in range(3)]
    assert m.sums == [sum(v[d] - low[d] for v in x) for d in range(3)]
    assert m.products == [sum((v[i] - low[i]) * (v[j] - low[j]) for v in x) for i in range(3) for j in range(i, 3)]
    assert {r.deviation for r in whitening.whiten(df).collect()} == {None}  # no long holds them


@pytest.mark.parametrize("bits", [1, 7, 20, 33, 60])
def test_block_sums_are_exact(bits):
    rng = np.random.Generator(np.random.PCG64(bits))
    y = rng.integers(0, 1 << bits, (777, 5), dtype=np.uint64)
    widths = np.array([bits, bits, bits, bits, bits])
    sums, products = whitening.block_sums(y, widths)
    whole = y.astype(object)
    assert [int(s) for s in sums] == whole.sum(axis=0).tolist()
    assert [int(p) for p in products] == [int((whole[:, i] * whole[:, j]).sum()) for i in range(5) for j in range(i, 5)]
    limbs = whitening._limbs(products, 6)
    assert [sum(int(limbs[k, i]) << (whitening.LIMB_BITS * k) for k in range(6)) for i in range(15)] == [int(p) for p in products]
