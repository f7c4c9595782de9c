"""Parquet sinks.

A run's trips are written under its own run id, partitioned by split and pickup month, ZSTD. Nothing
is ever overwritten there: which runs count is the manifest's matter (``manifest.py``). How many files a
month gets is the layout's:

- ``keep``: no shuffle. Each task writes the months it holds: for raw files that are large and laid out by
  month, one file per task, split and month.
- ``rebalance``: one shuffle by split and month, after which Spark divides large months and joins small
  ones from the sizes it has just measured, about ``TARGET_BYTES`` of shuffled rows a task: for many small
  files, or files in no order of months.
- ``month_salt`` deals each month over that many parts, whatever its size.

``planned_layout`` is for tables whose counts are known (a published run that is compacted): every month
gets as many parts as its rows fill files of the wanted size, and each part is written by one task.

What a write has seen (rows by file) is observed while it writes, after the last shuffle, so that nothing
is read again to count it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

TRIP_PARTITIONS = ("split", "year", "month")
TARGET_BYTES = 128 << 20
LARGE_RAW_BYTES = 32 << 20  # raw files of this size on average are written as they come


def with_month_partitions(df: DataFrame, ts: str = "pickup_time") -> DataFrame:
    cols = {}
    if "year" not in df.columns:
        cols["year"] = F.year(ts)
    if "month" not in df.columns:
        cols["month"] = F.month(ts)
    return df.withColumns(cols) if cols else df


def layout_for(sizes: Sequence[int]) -> str:
    """The layout for raw files of these sizes."""
    return "keep" if sizes and sum(sizes) >= LARGE_RAW_BYTES * len(sizes) else "rebalance"


@contextmanager
def _partition_size(spark: SparkSession, size: int) -> Iterator[None]:
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_trips(df: DataFrame, path: str, partition_by: Sequence[str] = TRIP_PARTITIONS, compression: str = "zstd",
                month_salt: int | None = None, layout: str = "keep", metrics: Sequence[Column] = (),
                mode: str = "errorifexists") -> dict:
    """Write one run's trips to a new folder; the values of ``metrics`` (named aggregates) over the rows written."""
    out = with_month_partitions(df)
    if month_salt:
        salt = F.pmod(F.xxhash64("pickup_time", "dropoff_time", "pickup_loc", "dropoff_loc", "fare"), F.lit(month_salt))
        out = out.repartition("year", "month", salt)
    elif layout == "rebalance":
        out = out.hint("rebalance", *partition_by)
    elif layout != "keep":
        raise ValueError(f"unknown layout {layout!r}")
    seen = Observation()
    if metrics:
        out = out.observe(seen, *metrics)
    with _partition_size(df.sparkSession, TARGET_BYTES):
        out.write.mode(mode).option("compression", compression).partitionBy(*partition_by).parquet(path)
    return dict(seen.get) if metrics else {}


# -- rows by file, observed -------------------------------------------------------------------------

def file_mark(path: Column, seed: int) -> Column:
    """A number for a file's path that a double holds exactly."""
    return F.xxhash64(F.lit(seed), path).bitwiseAND(F.lit((1 << 52) - 1)).cast("double")


def count_by_file(mark: Column, n_files: int) -> Column:
    """Counts by mark as a histogram with a bin for every file: no two different marks ever share a bin."""
    return F.histogram_numeric(mark, F.lit(2 * n_files + 2))


def counts_of(histogram: list | None, marks: dict[float, str]) -> dict[str, int]:
    """Rows by path. Bins of one file may come several times and are added up."""
    known = sorted(marks)
    out: dict[str, int] = {}
    for x, y in histogram or []:
        at = bisect_left(known, x)  # joined bins may be off by the rounding of a mean
        near = min(known[max(0, at - 1):at + 1], key=lambda m: abs(m - x))
        out[marks[near]] = out.get(marks[near], 0) + int(round(y))
    return out


# -- layout planned from counts ------------------------------------------------------------------------

def planned_layout(df: DataFrame, counts: DataFrame, bytes_per_row: float, row_key: Sequence[Column],
                   target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``df`` dealt so that each split and month (``counts``: split, year, month, trip_count) is written in files
    of about ``target_bytes``, each by one task; ``row_key`` tells rows apart. ``counts`` has one row a month,
    so the plan of parts is bounded by the calendar."""
    plan, n = [], 0
    for r in counts.orderBy(*TRIP_PARTITIONS).collect():  # one row a split and month
        parts = max(1, round(r["trip_count"] * bytes_per_row / target_bytes))
        plan.append((*[r[c] for c in TRIP_PARTITIONS], n, parts))
        n += parts
    first = df.sparkSession.createDataFrame(plan, "_split string, _year int, _month int, _first int, _parts int")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in TRIP_PARTITIONS]
    dealt = df.withColumn("_key", F.xxhash64(*row_key)).join(F.broadcast(first), on)
    return dealt.repartitionById(n, F.col("_first") + F.pmod("_key", F.col("_parts")).cast("int")) \
        .drop("_key", *[c for c in first.columns])


def write_result(df: DataFrame, path: str, compression: str = "zstd", ordered: bool = False) -> None:
    """Write a small result as one file (whole overwrite); an ordered result keeps its order, as its sorted
    partitions are concatenated."""
    out = df.coalesce(1) if ordered else df.repartition(1)
    out.write.mode("overwrite").option("compression", compression).parquet(path)
