"""The pruning filters select exactly the rows a plain predicate selects."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cordon.operators.periods import _runs, in_months, since_start


def test_runs_merge_contiguous_months():
    assert _runs([3, 1, 2, 12]) == [(1, 3), (12, 12)]
    assert _runs([5]) == [(5, 5)]
    assert _runs([1, 3, 5, 6, 7, 12, 11]) == [(1, 1), (3, 3), (5, 7), (11, 12)]


@pytest.fixture(scope="module")
def times(spark):
    rng = random.Random(3)
    base = datetime(1998, 1, 1)
    ts = [base + timedelta(seconds=rng.randrange(0, 4 * 365 * 86400)) for _ in range(3000)]
    # month boundaries exactly
    ts += [datetime(y, m, 1) for y in (1999, 2000, 2001) for m in range(1, 13)]
    ts += [datetime(y, m, 1) - timedelta(microseconds=1) for y in (1999, 2000, 2001) for m in range(1, 13)]
    df = spark.createDataFrame([(t,) for t in ts], "pickup_time timestamp_ntz")
    return ts, df


@pytest.mark.parametrize("with_partitions", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_in_months_matches_predicate(spark, times, with_partitions, seed):
    ts, df = times
    rng = random.Random(seed)
    months = {(rng.choice([1999, 2000, 2001]), rng.randint(1, 12)) for _ in range(rng.randint(1, 8))}
    if with_partitions:
        df = df.withColumns({"year": F.year("pickup_time"), "month": F.month("pickup_time")})
    got = sorted(r.pickup_time for r in in_months(df, months).select("pickup_time").collect())
    want = sorted(t for t in ts if (t.year, t.month) in months)
    assert got == want


@pytest.mark.parametrize("with_partitions", [False, True])
def test_since_start_matches_predicate(spark, times, with_partitions):
    ts, df = times
    start = datetime(2000, 6, 15, 12, 30)
    if with_partitions:
        df = df.withColumns({"year": F.year("pickup_time"), "month": F.month("pickup_time")})
    got = sorted(r.pickup_time for r in since_start(df, start).select("pickup_time").collect())
    assert got == sorted(t for t in ts if t >= start)
