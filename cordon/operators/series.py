"""Results read from the zone-day rollup: daily series, running revenue, category tables (A14-A17,
A19, A20, W1). The rollup has one row per (day, category, period), so each of these is a small
aggregation; the running total is a window over days, which are bounded by the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cordon.config import AuditConfig
from cordon.functions.trip import metric, period_label


def daily_trips(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("trip_date").agg(F.sum("trip_count").alias("total_trips")).orderBy("trip_date")


def revenue_daily_cumulative(rollup: DataFrame) -> DataFrame:
    """Daily surcharge revenue after the start and its running total by date.

    Aggregated to one row per day before the window, so the single ordered partition of the
    window holds only days.
    """
    daily = (
        rollup.filter(F.col("after_congestion_start") == 1)
        .groupBy("trip_date")
        .agg(F.sum("total_congestion_collected").alias("daily_revenue"))
    )
    running = Window.orderBy("trip_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "trip_date",
        metric(F.col("daily_revenue")).alias("daily_revenue"),
        metric(F.sum("daily_revenue").over(running)).alias("cumulative_revenue"),
    ).orderBy("trip_date")


def zone_period(rollup: DataFrame, cfg: AuditConfig) -> DataFrame:
    return (
        rollup.groupBy("zone_category", period_label(F.col("after_congestion_start"), cfg).alias("period"))
        .agg(F.sum("trip_count").alias("total_trips"))
        .orderBy("zone_category", "period")
    )


def daily_leakage(rollup: DataFrame) -> DataFrame:
    """Per day after the start: trips with and without surcharge (all categories) and their sum."""
    return (
        rollup.filter(F.col("after_congestion_start") == 1)
        .groupBy("trip_date")
        .agg(
            F.sum("trips_with_surcharge").alias("with_surcharge"),
            F.sum("trips_without_surcharge").alias("without_surcharge"),
        )
        .withColumn("stacked_total", F.col("with_surcharge") + F.col("without_surcharge"))
        .orderBy("trip_date")
    )


def zone_revenue(rollup: DataFrame) -> DataFrame:
    return (
        rollup.groupBy("zone_category", "after_congestion_start")
        .agg(
            F.sum("trip_count").alias("trips"),
            metric(F.sum("total_congestion_collected")).alias("revenue"),
        )
        .orderBy("zone_category", "after_congestion_start")
    )


def zone_period_pivot(rollup: DataFrame) -> DataFrame:
    """Category x period table of trips; a missing cell is 0. Pivot values are given, so Spark
    plans one aggregation without a distinct-values pass."""
    p = rollup.groupBy("zone_category").pivot("after_congestion_start", [0, 1]).agg(F.sum("trip_count"))
    return p.select(
        "zone_category",
        F.coalesce(F.col("0"), F.lit(0).cast("long")).alias("trips_before_start"),
        F.coalesce(F.col("1"), F.lit(0).cast("long")).alias("trips_after_start"),
    ).orderBy("zone_category")
