"""Join helpers.

``bounded_broadcast`` is the only place a broadcast hint is set. It measures the side first and
hints the broadcast only when at most ``max_rows`` rows were found; a larger side is returned
unhinted so Spark plans a shuffle join, which scales with the data instead of with driver memory.

The measurement is ``take(n + 1)`` of a one-constant projection: Spark scans partitions
incrementally and stops as soon as ``n + 1`` rows are seen, so proving a side large costs at most
``n + 1`` tiny rows. (``limit(n + 1).count()`` would instead start a task on every partition and
gather up to ``n + 1`` rows from each into one task.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (brings back at most ``max_rows + 1`` constants)."""
    return len(df.select(F.lit(1).alias("one")).take(max_rows + 1)) <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
