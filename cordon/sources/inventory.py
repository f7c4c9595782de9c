"""Source inventory (S3-S6): what arrived, what is missing, what is not processed yet, whether imputation is
needed. Which files an ingest run takes is in ``manifest.py``.

Counting rows per source file is a grouped count (partial aggregation per task, one row per file
after the shuffle). The expected grid is types x years x months, built with ``sequence``/``explode``
on the executors; completeness is a left-anti join against it. No list of files is walked on the
driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from cordon.config import TRIP_FILE_FORMAT, AuditConfig

FILE_MONTH = r"(\d{4})-(\d{2})"


def source_row_counts(raw_by_type: Mapping[str, DataFrame], listing: DataFrame | None = None) -> DataFrame:
    """Rows per source file of each type; a file is valid when it holds at least one row. With a
    ``listing`` (``taxi_type, source_file``) there is one row per listed file, also for files without rows."""
    frames = [df.select(F.lit(t).alias("taxi_type"), "source_file") for t, df in raw_by_type.items()]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f)
    counts = stacked.groupBy("taxi_type", "source_file").agg(F.count(F.lit(1)).alias("row_count"))
    if listing is not None:
        counts = listing.join(counts, ["taxi_type", "source_file"], "left") \
            .withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("long")))
    return counts.select(
        "taxi_type",
        "source_file",
        F.regexp_extract("source_file", FILE_MONTH, 1).cast("int").alias("year"),
        F.regexp_extract("source_file", FILE_MONTH, 2).cast("int").alias("month"),
        "row_count",
        (F.col("row_count") > 0).alias("is_valid"),
    )


def expected_grid(spark: SparkSession, cfg: AuditConfig) -> DataFrame:
    one = spark.range(1)
    return one.select(
        F.explode(F.array(*[F.lit(t) for t in cfg.taxi_types])).alias("taxi_type"),
    ).select(
        "taxi_type",
        F.explode(F.array(*[F.lit(y) for y in cfg.grid_years])).alias("year"),
    ).select(
        "taxi_type", "year",
        F.explode(F.array(*[F.lit(m) for m in cfg.grid_months])).alias("month"),
    )


def missing_months(spark: SparkSession, counts: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Expected (type, year, month) with no valid source, with the file name that would hold it."""
    present = counts.filter("is_valid").select("taxi_type", "year", "month").distinct()
    missing = expected_grid(spark, cfg).join(present, ["taxi_type", "year", "month"], "left_anti")
    return missing.select(
        "taxi_type", "year", "month",
        F.format_string(TRIP_FILE_FORMAT, "taxi_type", "year", "month").alias("expected_file"),
    ).orderBy("taxi_type", "year", "month")


def unprocessed_months(counts: DataFrame, processed: DataFrame) -> DataFrame:
    """Months with a valid source that the processed table does not hold yet, with the rows that wait: a
    left-anti join of the sources' months with ``processed`` (``taxi_type, year, month``, in any number)."""
    waiting = counts.filter("is_valid").groupBy("taxi_type", "year", "month").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("row_count").alias("row_count"))
    return waiting.join(processed.select("taxi_type", "year", "month").distinct(), ["taxi_type", "year", "month"], "left_anti") \
        .orderBy("taxi_type", "year", "month")


def counts_by_file(report: DataFrame) -> DataFrame:
    """The same columns from the manifest's file report, invalid files included."""
    name = F.element_at(F.split("file_path", "/"), -1)
    return report.select(
        "taxi_type", name.alias("source_file"), F.regexp_extract(name, FILE_MONTH, 1).try_cast("int").alias("year"),
        F.regexp_extract(name, FILE_MONTH, 2).try_cast("int").alias("month"),
        F.col("rows_read").alias("row_count"), "is_valid")


def expected_files(spark: SparkSession, cfg: AuditConfig) -> DataFrame:
    """The listing that the expected grid names: ``taxi_type, source_file``."""
    return expected_grid(spark, cfg).select(
        "taxi_type", F.format_string(TRIP_FILE_FORMAT, "taxi_type", "year", "month").alias("source_file"))


def impute_needed(counts: DataFrame, cfg: AuditConfig) -> DataFrame:
    """One row: whether the target month has a valid source for every taxi type."""
    target = counts.filter(
        F.col("is_valid") & (F.col("year") == cfg.impute_year) & (F.col("month") == cfg.impute_month)
    )
    agg = target.agg(F.count_distinct("taxi_type").alias("types_present"))
    return agg.select(
        F.lit(f"{cfg.impute_year:04d}-{cfg.impute_month:02d}").alias("target_month"),
        "types_present",
        (F.col("types_present") >= F.lit(len(cfg.taxi_types))).alias("month_complete"),
        (F.col("types_present") < F.lit(len(cfg.taxi_types))).alias("needs_imputation"),
    )
