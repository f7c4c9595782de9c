"""Missing-month imputation.

The target month is estimated per day of month as a weighted sum of the same month in two earlier
years. Both years are read in one pruned scan and split by conditional aggregation, which is the
inner join of the two day profiles without the join: a day absent from either year is dropped.
The typical locations are modes of the newer year (ties: smallest id). A mode keeps one counter
per distinct location of the group, which the location dimension bounds. The ``..._from_hubs`` forms
read the hubs instead of trips: counts by (type, day, location) add up over runs, and the mode is
their arg-max.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from cordon.config import AuditConfig
from cordon.functions.trip import metric
from cordon.operators import hubs
from cordon.operators.periods import in_months


def _source_months(clean: DataFrame, cfg: AuditConfig) -> DataFrame:
    return in_months(clean, [(cfg.impute_older_year, cfg.impute_month), (cfg.impute_newer_year, cfg.impute_month)])


def month_profile(clean: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Day-of-month profile of the source months, per taxi type and year."""
    s0 = F.coalesce(F.col("congestion_surcharge"), F.lit(0.0))
    return (
        _source_months(clean, cfg)
        .groupBy("taxi_type", F.year("pickup_time").alias("year"), F.dayofmonth("pickup_time").alias("day_of_month"))
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            metric(F.avg("fare")).alias("avg_fare"),
            metric(F.avg("total_amount")).alias("avg_total"),
            metric(F.avg("trip_distance")).alias("avg_distance"),
            metric(F.avg(s0)).alias("avg_congestion"),
            F.mode("pickup_loc", deterministic=True).alias("typical_pickup"),
            F.mode("dropoff_loc", deterministic=True).alias("typical_dropoff"),
        )
    )


def _profile_from_hubs(days: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Sums and counts of the source months by type, year and day of month."""
    d = F.col("trip_date")
    source = F.year(d).isin(cfg.impute_older_year, cfg.impute_newer_year) & (F.month(d) == cfg.impute_month)
    return hubs.clean(days).filter(source).groupBy("taxi_type", F.year(d).alias("year"), F.dayofmonth(d).alias("day_of_month")).agg(
        *hubs.sums("trip_count", "fare_sum", "fare_n", "total_sum", "total_n", "distance_sum", "distance_n", "total_congestion_collected"))


def _modes_from_hubs(pickups: DataFrame, dropoffs: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Typical locations of the source months by type, year and day of month: an arg-max of summed counts."""
    d = F.col("mode_date")
    source = F.year(d).isin(cfg.impute_older_year, cfg.impute_newer_year) & (F.month(d) == cfg.impute_month)
    keys = ("taxi_type", "year", "day_of_month")

    def of(hub: DataFrame, key: str, name: str) -> DataFrame:
        dated = hub.filter(source).withColumns({"year": F.year(d), "day_of_month": F.dayofmonth(d)})
        return hubs.modes(dated, key, *keys).withColumnRenamed(key, name)

    return of(pickups, "mode_pickup", "typical_pickup").join(of(dropoffs, "mode_dropoff", "typical_dropoff"), list(keys))


def _mean(s: Column, n: Column) -> Column:
    return s / F.nullif(n, F.lit(0).cast("long"))


def month_profile_from_hubs(days: DataFrame, pickups: DataFrame, dropoffs: DataFrame, cfg: AuditConfig) -> DataFrame:
    """``month_profile`` from the day, pickup and dropoff hubs."""
    keys = ["taxi_type", "year", "day_of_month"]
    return _profile_from_hubs(days, cfg).join(_modes_from_hubs(pickups, dropoffs, cfg), keys).select(
        *keys, "trip_count",
        *[metric(_mean(F.col(f"{n}_sum"), F.col(f"{n}_n"))).alias(f"avg_{n}") for n in ("fare", "total", "distance")],
        metric(F.col("total_congestion_collected") / F.col("trip_count")).alias("avg_congestion"),
        "typical_pickup", "typical_dropoff")


def impute_month_from_hubs(days: DataFrame, pickups: DataFrame, dropoffs: DataFrame, cfg: AuditConfig) -> DataFrame:
    """``impute_month`` from the day, pickup and dropoff hubs."""
    old, new = (F.col("year") == y for y in (cfg.impute_older_year, cfg.impute_newer_year))

    def of(period: Column, name: str) -> Column:
        return F.sum(F.when(period, F.col(name)))

    def both(name: str, total: str, n: str) -> list[Column]:
        return [_mean(of(p, total), of(p, n)).alias(f"{name}_{k}") for p, k in ((old, "old"), (new, "new"))]

    none = F.lit(0).cast("long")
    prof = _profile_from_hubs(days, cfg).groupBy("taxi_type", "day_of_month").agg(
        F.coalesce(of(old, "trip_count"), none).alias("n_old"), F.coalesce(of(new, "trip_count"), none).alias("n_new"),
        *both("fare", "fare_sum", "fare_n"), *both("total", "total_sum", "total_n"), *both("distance", "distance_sum", "distance_n"),
        *both("congestion", "total_congestion_collected", "trip_count"),
    ).filter((F.col("n_old") > 0) & (F.col("n_new") > 0))
    typical = _modes_from_hubs(pickups, dropoffs, cfg).filter(new).drop("year")
    return _weighted(prof.join(typical, ["taxi_type", "day_of_month"]), cfg)


def impute_month(clean: DataFrame, cfg: AuditConfig) -> DataFrame:
    y = F.year("pickup_time")
    old, new = y == cfg.impute_older_year, y == cfg.impute_newer_year
    s0 = F.coalesce(F.col("congestion_surcharge"), F.lit(0.0))

    def both(name, c):
        return [F.avg(F.when(old, c)).alias(f"{name}_old"), F.avg(F.when(new, c)).alias(f"{name}_new")]

    prof = (
        _source_months(clean, cfg)
        .groupBy("taxi_type", F.dayofmonth("pickup_time").alias("day_of_month"))
        .agg(
            F.count_if(old).alias("n_old"),
            F.count_if(new).alias("n_new"),
            *both("fare", F.col("fare")),
            *both("total", F.col("total_amount")),
            *both("distance", F.col("trip_distance")),
            *both("congestion", s0),
            F.mode(F.when(new, F.col("pickup_loc")), deterministic=True).alias("typical_pickup"),
            F.mode(F.when(new, F.col("dropoff_loc")), deterministic=True).alias("typical_dropoff"),
        )
        .filter((F.col("n_old") > 0) & (F.col("n_new") > 0))
    )
    return _weighted(prof, cfg)


def _weighted(prof: DataFrame, cfg: AuditConfig) -> DataFrame:
    """The target month's days from the profiles of both years."""
    w_old, w_new = float(cfg.weight_older), float(cfg.weight_newer)
    # The trip count is weighted in exact decimals and rounded half away from zero before the cast.
    count = F.round(F.lit(Decimal(cfg.weight_older)) * F.col("n_old") + F.lit(Decimal(cfg.weight_newer)) * F.col("n_new"), 0)

    def weighted(name):
        return metric(F.lit(w_old) * F.col(f"{name}_old") + F.lit(w_new) * F.col(f"{name}_new"))

    return prof.select(
        "taxi_type",
        "day_of_month",
        count.cast("long").alias("imputed_trip_count"),
        weighted("fare").alias("imputed_avg_fare"),
        weighted("total").alias("imputed_avg_total"),
        weighted("distance").alias("imputed_avg_distance"),
        weighted("congestion").alias("imputed_avg_congestion"),
        "typical_pickup",
        "typical_dropoff",
        F.lit(cfg.weight_older).alias("weight_older"),
        F.lit(cfg.weight_newer).alias("weight_newer"),
        F.lit(f"{cfg.impute_year:04d}-{cfg.impute_month:02d}").alias("target_month"),
        F.lit("IMPUTED").alias("data_source"),
    )


def impute_total(imputed: DataFrame) -> DataFrame:
    return imputed.groupBy("taxi_type").agg(F.sum("imputed_trip_count").alias("total_imputed_trips"))
