"""Toll leakage (A11, I6): cross-border trips after the start that paid no surcharge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cordon.config import CROSS_BORDER, AuditConfig
from cordon.functions.trip import metric, pct


def leakage_summary(rollup: DataFrame, cfg: AuditConfig) -> DataFrame:
    """One row: cross-border totals after the start, leakage %, revenue and estimated loss."""
    r = rollup.filter((F.col("after_congestion_start") == 1) & F.col("zone_category").isin(*CROSS_BORDER))
    agg = r.agg(
        F.sum("trip_count").alias("total_trips"),
        F.sum("trips_with_surcharge").alias("trips_with_surcharge"),
        F.sum("trips_without_surcharge").alias("trips_without_surcharge"),
        F.sum("total_congestion_collected").alias("_revenue"),
    )
    return agg.select(
        "total_trips", "trips_with_surcharge", "trips_without_surcharge",
        pct(F.col("trips_without_surcharge"), F.col("total_trips")).alias("leakage_pct"),
        metric(F.col("_revenue")).alias("total_revenue_collected"),
        metric(F.col("trips_without_surcharge") * F.lit(cfg.leakage_loss_per_trip)).alias("estimated_revenue_lost"),
    )


def top_leakage_pickups(hub: DataFrame, cfg: AuditConfig) -> DataFrame:
    """The k pickup locations with most cross-border trips lacking the surcharge after the start, from the
    location hub: aggregated per location, then a distributed take-ordered; the rank is numbered over the
    k surviving rows only.
    """
    per_loc = hub.filter(F.col("zone_category").isin(*CROSS_BORDER)).groupBy("pickup_loc").agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum("trips_without_surcharge").alias("trips_without_surcharge"),
    )
    order = [F.col("trips_without_surcharge").desc(), F.col("pickup_loc").asc()]
    top = per_loc.orderBy(*order).limit(cfg.top_leakage_k)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("leakage_rank"),
        "pickup_loc", "trip_count", "trips_without_surcharge",
        pct(F.col("trips_without_surcharge"), F.col("trip_count")).alias("leakage_pct"),
    )
