"""Key figures after the start over all categories.

``avg_fare`` and ``avg_distance`` are means of the rollup's group means, as reported; the
trip-weighted means are given beside them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cordon.config import AuditConfig
from cordon.functions.trip import metric


def kpi_overview(rollup: DataFrame, cfg: AuditConfig) -> DataFrame:
    r = rollup.filter(F.col("after_congestion_start") == 1)
    z = F.lit(0)
    agg = r.agg(
        F.coalesce(F.sum("trip_count"), z.cast("long")).alias("total_trips"),
        F.coalesce(F.sum("total_congestion_collected"), F.lit(0.0)).alias("_revenue"),
        F.coalesce(F.sum("trips_with_surcharge"), z.cast("long")).alias("trips_with_surcharge"),
        F.coalesce(F.sum("trips_without_surcharge"), z.cast("long")).alias("trips_without_surcharge"),
        F.coalesce(F.avg("avg_fare"), F.lit(0.0)).alias("_avg_fare"),
        F.coalesce(F.avg("avg_distance"), F.lit(0.0)).alias("_avg_distance"),
        (F.sum(F.col("avg_fare") * F.col("fare_n")) / F.nullif(F.sum("fare_n"), z.cast("long"))).alias("_avg_fare_weighted"),
    )
    w, wo = F.col("trips_with_surcharge"), F.col("trips_without_surcharge")
    compliance = F.when(w + wo > 0, w / (w + wo) * F.lit(100.0)).otherwise(F.lit(0.0))
    return agg.select(
        "total_trips",
        metric(F.col("_revenue")).alias("total_revenue"),
        "trips_with_surcharge",
        "trips_without_surcharge",
        metric(compliance).alias("compliance_pct"),
        metric(F.lit(100.0) - compliance).alias("leakage_pct"),
        metric(wo * F.lit(cfg.kpi_loss_per_trip)).alias("estimated_lost_revenue"),
        metric(F.col("_avg_fare")).alias("avg_fare"),
        metric(F.col("_avg_distance")).alias("avg_distance"),
        metric(F.col("_avg_fare_weighted")).alias("avg_fare_weighted"),
    )
