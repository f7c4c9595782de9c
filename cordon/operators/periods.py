"""Month filters that prune.

A table written by this package is partitioned by ``year`` and ``month`` of the pickup; when those
columns are present the filter is on them (partition pruning: unlisted months are never opened).
Otherwise the filter is a range on ``pickup_time``, which Parquet row-group statistics can skip.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _ts(d: datetime) -> Column:
    return F.lit(d.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _runs(months: list[int]) -> list[tuple[int, int]]:
    """Contiguous runs of month numbers, e.g. [1, 2, 3, 12] -> [(1, 3), (12, 12)]."""
    runs: list[tuple[int, int]] = []
    for m in sorted(set(months)):
        if runs and runs[-1][1] == m - 1:
            runs[-1] = (runs[-1][0], m)
        else:
            runs.append((m, m))
    return runs


def in_months(df: DataFrame, months: Iterable[tuple[int, int]]) -> DataFrame:
    """Trips picked up in any of the given (year, month) pairs."""
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    if {"year", "month"} <= set(df.columns):
        parts = [(F.col("year") == y) & F.col("month").isin(*ms) for y, ms in by_year.items()]
        df = df.filter(reduce(lambda a, b: a | b, parts))
    ts = F.col("pickup_time")
    ranges = []
    for y, ms in by_year.items():
        for lo, hi in _runs(ms):
            end = datetime(y + (hi == 12), hi % 12 + 1, 1)
            ranges.append((ts >= _ts(datetime(y, lo, 1))) & (ts < _ts(end)))
    return df.filter(reduce(lambda a, b: a | b, ranges))


def since_start(df: DataFrame, start: datetime) -> DataFrame:
    """Trips at or after ``start``: a partition filter on (year, month) when the table has them, and
    the exact time predicate, which Parquet row-group statistics can use."""
    if {"year", "month"} <= set(df.columns):
        y, m = start.year, start.month
        df = df.filter((F.col("year") > y) | ((F.col("year") == y) & (F.col("month") >= m)))
    return df.filter(F.col("pickup_time") >= _ts(start))
