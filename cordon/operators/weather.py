"""Weather and demand.

The daily series is aggregated from the rollup (one row per day) before it meets the weather table
(one row per day), so the join is between two calendar-bounded tables; AQE sizes it at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cordon.config import AuditConfig
from cordon.functions.trip import metric, pct, stat


def _with_rain_flag(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    filled = F.coalesce(F.col("prcp"), F.lit(0.0))
    return df.withColumns({
        "prcp_filled": filled,
        "is_rainy_day": F.when(filled > F.lit(cfg.rainy_threshold_mm), F.lit(1)).otherwise(F.lit(0)),
    })


def weather_joined(rollup: DataFrame, weather: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Daily trips, mean of group-mean fare and revenue, left-joined to the weather of the day."""
    daily = rollup.groupBy("trip_date").agg(
        F.sum("trip_count").alias("total_trips"),
        F.avg("avg_fare").alias("avg_fare"),
        F.sum("total_congestion_collected").alias("congestion_revenue"),
    ).withColumn("date", F.to_date("trip_date"))
    joined = daily.join(weather, "date", "left")
    return _with_rain_flag(joined, cfg)


def weather_joined_report(joined: DataFrame) -> DataFrame:
    doubles = [f.name for f in joined.schema.fields if f.dataType.typeName() == "double"]
    return joined.withColumns({c: metric(F.col(c)) for c in doubles})


def weather_correlation(joined: DataFrame) -> DataFrame:
    """Pearson correlation of daily trips with precipitation (missing as 0) and temperature;
    pairs with a NULL are skipped per pair."""
    return joined.agg(
        F.count(F.lit(1)).alias("days"),
        stat(F.corr(F.col("total_trips").cast("double"), F.col("prcp_filled"))).alias("corr_trips_prcp"),
        stat(F.corr(F.col("total_trips").cast("double"), F.col("tavg"))).alias("corr_trips_tavg"),
    )


def rain_effect(joined: DataFrame) -> DataFrame:
    rainy = F.col("is_rainy_day") == 1
    agg = joined.agg(
        F.count_if(rainy).alias("rainy_days"),
        F.count_if(~rainy).alias("dry_days"),
        F.avg(F.when(rainy, F.col("total_trips"))).alias("_r"),
        F.avg(F.when(~rainy, F.col("total_trips"))).alias("_d"),
    )
    r, d = F.col("_r"), F.col("_d")
    return agg.select(
        "rainy_days", "dry_days",
        metric(r).alias("rainy_avg_trips"),
        metric(d).alias("dry_avg_trips"),
        metric(F.when(d > 0, (r - d) / d * F.lit(100.0)).otherwise(F.lit(0.0))).alias("rain_effect_pct"),
    )


def precip_elasticity(joined: DataFrame) -> DataFrame:
    """Slope of ln(trips) on ln(precipitation) over days with recorded rain (prcp > 0): the %
    change in trips per % change in precipitation."""
    wet = joined.filter((F.col("prcp") > 0) & (F.col("total_trips") > 0))
    return wet.agg(
        F.count(F.lit(1)).alias("wet_days"),
        stat(F.regr_slope(F.ln(F.col("total_trips").cast("double")), F.ln(F.col("prcp")))).alias("elasticity"),
    )


def rain_compliance(rollup: DataFrame, weather: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Surcharge compliance after the start on rainy against dry days (all categories)."""
    daily = (
        rollup.filter(F.col("after_congestion_start") == 1)
        .groupBy(F.to_date("trip_date").alias("date"))
        .agg(
            F.sum("trips_with_surcharge").alias("w"),
            F.sum("trips_without_surcharge").alias("wo"),
        )
    )
    j = _with_rain_flag(daily.join(weather.select("date", "prcp"), "date", "left"), cfg)
    return (
        j.groupBy("is_rainy_day")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("w").alias("trips_with_surcharge"),
            F.sum("wo").alias("trips_without_surcharge"),
        )
        .withColumn("compliance_pct", pct(F.col("trips_with_surcharge"),
                                          F.col("trips_with_surcharge") + F.col("trips_without_surcharge")))
        .orderBy("is_rainy_day")
    )
