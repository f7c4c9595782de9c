"""Nearest neighbours: exact where all parts are probed, measured recall else, and every odd row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cordon.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute(rows, is_query, dims, k=10):
    seen = {(i, tuple(float(np.float32(c)) for c in v)) for i, v in rows
            if i is not None and v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    out = set()
    for i, q in seen:
        if is_query(i):
            near = sorted((math.dist(q, v), j) for j, v in seen if (j, v) != (i, q))[:k]
            out |= {(i, r + 1, j, round(d, 9)) for r, (d, j) in enumerate(near)}
    return out


def found(df, **kw):
    return {(r.query_id, r.rank, r.vec_id, round(r.score, 9))
            for r in neighbours.nearest(df, F.col("vec_id") % 10 == 0, **kw).collect()}


def clustered(rng, n, dims=8, centres=12):
    c = [[rng.gauss(0, 3) for _ in range(dims)] for _ in range(centres)]
    return [(i, [x + rng.gauss(0, 0.7) for x in rng.choice(c)]) for i in range(n)]


def test_odd_rows_ties_and_copies(spark):
    rng = random.Random(1)
    rows = clustered(rng, 120)
    rows += [(1000 + i, list(rows[0][1])) for i in range(60)]  # many copies, some of them queries
    rows += [(2000 + i, [float(i % 3), 1.0] + [0.0] * 6) for i in range(30)]  # ties
    rows += [(None, [1.0] * 8), (5, None), (6, [0.0] * 8), (7, [float("nan")] * 8), (8, [None] * 8), (9, [float("inf")] * 8),
             (10, [1.0, 2.0]), (20, []), rows[10], rows[10], (30, [9.0] * 8), (30, [9.5] * 8)]
    df = table(spark, rows)
    want = brute(rows, lambda i: i % 10 == 0, 8)
    assert found(df) == want
    assert found(df.selectExpr("*", "1 AS v", "2 AS part", "'x' AS i", "'y' AS j", "3 AS q", "4 AS ids", "5 AS rank", "6 AS score")) == want


def test_fewer_candidates_than_asked_for(spark):
    rows = [(10, [1.0, 0.0]), (11, [0.0, 1.0]), (12, [1.0, 1.0])]
    assert found(table(spark, rows)) == {(10, 1, 12, 1.0), (10, 2, 11, round(math.sqrt(2), 9))}
    assert found(table(spark, rows[:1])) == set() and found(table(spark, [])) == set()


@pytest.mark.parametrize("blocks", [(16384, 4096), (16, 4)])
def test_all_parts_probed_is_exact_in_any_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "PART_SAMPLE", 40)
    monkeypatch.setattr(neighbours, "ROWS_BLOCK", blocks[0])
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", blocks[1])
    monkeypatch.setattr(neighbours.fit, "__defaults__", (10, neighbours.TARGET, 40))
    rows = clustered(random.Random(2), 400)
    assert found(table(spark, rows), probes=64) == brute(rows, lambda i: i % 10 == 0, 8)


def test_recall_with_few_probes(spark, monkeypatch):
    monkeypatch.setattr(neighbours.fit, "__defaults__", (10, 0.97, 64))
    rows = clustered(random.Random(3), 3000, centres=40)
    df = table(spark, rows)
    chosen = []
    fit = neighbours.fit
    monkeypatch.setattr(neighbours, "fit", lambda *a: chosen.append(fit(*a)) or chosen[-1])
    got = neighbours.nearest(df, F.col("vec_id") % 10 == 0, sample=2048)
    assert neighbours.recall(df, got) >= 0.9
    assert len(chosen[0].b2) == 32 and chosen[0].probes <= 8  # a quarter of the parts at most


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.Generator(np.random.PCG64(1))
    x = rng.standard_normal((16, 6))[rng.integers(0, 16, 2000)] * 4 + rng.standard_normal((2000, 6)) * 0.5
    near = neighbours.nearest_in(x, np.arange(2000), 10)
    a, b = neighbours.graph_edges(near)
    part = neighbours.balanced_parts(a, b, 2000, 8)
    size = np.bincount(part, minlength=8)
    assert size.min() >= 0.85 * 250 and size.max() <= 1.15 * 250
    assert (part[a] != part[b]).mean() < 0.25  # of parts at random: 0.875
