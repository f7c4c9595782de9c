"""Period comparison by taxi type.

Both periods are read in one pruned scan (or from the day hub, ``..._from_days``) as sums by period and
type, and split by conditional aggregation, so the comparison has no join: a type missing in either
period is dropped, as in the audited row matching.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cordon.config import AuditConfig
from cordon.functions.trip import change_pct, metric
from cordon.operators import hubs
from cordon.operators.periods import in_months


def _quarters(clean: DataFrame, cfg: AuditConfig) -> DataFrame:
    months = [(y, m) for y in (cfg.compare_before_year, cfg.compare_after_year) for m in cfg.compare_months]
    return in_months(clean, months).withColumn("period_year", F.year("pickup_time"))


def _sums(clean: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Sums and counts by period and type."""
    return _quarters(clean, cfg).groupBy("period_year", "taxi_type").agg(
        F.count(F.lit(1)).alias("trip_count"),
        *[f(c).alias(f"{n}_{k}") for c, n in (("fare", "fare"), ("total_amount", "total")) for k, f in (("sum", F.sum), ("n", F.count))])


def _sums_from_days(days: DataFrame, cfg: AuditConfig) -> DataFrame:
    months = F.year("trip_date").isin(cfg.compare_before_year, cfg.compare_after_year) & F.month("trip_date").isin(*cfg.compare_months)
    return hubs.clean(days).filter(months).groupBy(F.year("trip_date").alias("period_year"), "taxi_type").agg(
        *hubs.sums("trip_count", "fare_sum", "fare_n", "total_sum", "total_n"))


def _stats(sums: DataFrame) -> DataFrame:
    return sums.select(
        "period_year", "taxi_type", "trip_count",
        metric(_mean("fare_sum", "fare_n")).alias("avg_fare"),
        metric(_mean("total_sum", "total_n")).alias("avg_total"),
        metric(F.col("total_sum")).alias("total_revenue"),
    ).orderBy("period_year", "taxi_type")


def _mean(s: str | Column, n: str | Column) -> Column:
    total, count = (F.col(c) if isinstance(c, str) else c for c in (s, n))
    return total / F.nullif(count, F.lit(0).cast("long"))


def quarter_stats(clean: DataFrame, cfg: AuditConfig) -> DataFrame:
    return _stats(_sums(clean, cfg))


def quarter_stats_from_days(days: DataFrame, cfg: AuditConfig) -> DataFrame:
    return _stats(_sums_from_days(days, cfg))


def _by_type(sums: DataFrame, cfg: AuditConfig) -> DataFrame:
    before = F.col("period_year") == cfg.compare_before_year
    after = F.col("period_year") == cfg.compare_after_year

    def of(period: Column, name: str) -> Column:
        return F.sum(F.when(period, F.col(name)))

    none = F.lit(0).cast("long")
    return sums.groupBy("taxi_type").agg(
        F.coalesce(of(before, "trip_count"), none).alias("trips_before"),
        F.coalesce(of(after, "trip_count"), none).alias("trips_after"),
        _mean(of(before, "fare_sum"), of(before, "fare_n")).alias("fare_before"),
        _mean(of(after, "fare_sum"), of(after, "fare_n")).alias("fare_after"),
        of(before, "total_sum").alias("revenue_before"),
        of(after, "total_sum").alias("revenue_after"),
    )


def quarter_comparison(clean: DataFrame, cfg: AuditConfig) -> DataFrame:
    return _comparison(_by_type(_sums(clean, cfg), cfg))


def quarter_comparison_from_days(days: DataFrame, cfg: AuditConfig) -> DataFrame:
    return _comparison(_by_type(_sums_from_days(days, cfg), cfg))


def _comparison(by_type: DataFrame) -> DataFrame:
    t = by_type.filter((F.col("trips_before") > 0) & (F.col("trips_after") > 0))
    return t.select(
        "taxi_type",
        "trips_before",
        "trips_after",
        metric(change_pct(F.col("trips_before"), F.col("trips_after"))).alias("trip_change_pct"),
        metric(F.col("fare_before")).alias("fare_before"),
        metric(F.col("fare_after")).alias("fare_after"),
        metric(change_pct(F.col("fare_before"), F.col("fare_after"))).alias("fare_change_pct"),
        metric(F.col("revenue_before")).alias("revenue_before"),
        metric(F.col("revenue_after")).alias("revenue_after"),
        metric(change_pct(F.col("revenue_before"), F.col("revenue_after"))).alias("revenue_change_pct"),
    ).orderBy("taxi_type")


def market_share_shift(clean: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Share of trips per taxi type in each period and the shift in percentage points.

    The window spans the per-type rows only (one row per taxi type).
    """
    return _shares(_by_type(_sums(clean, cfg), cfg))


def market_share_shift_from_days(days: DataFrame, cfg: AuditConfig) -> DataFrame:
    return _shares(_by_type(_sums_from_days(days, cfg), cfg))


def _shares(t: DataFrame) -> DataFrame:
    everything = Window.partitionBy()
    share_b = F.lit(100.0) * F.col("trips_before") / F.nullif(F.sum("trips_before").over(everything), F.lit(0))
    share_a = F.lit(100.0) * F.col("trips_after") / F.nullif(F.sum("trips_after").over(everything), F.lit(0))
    return t.select(
        "taxi_type", "trips_before", "trips_after",
        share_b.alias("_sb"), share_a.alias("_sa"),
    ).select(
        "taxi_type", "trips_before", "trips_after",
        metric(F.col("_sb")).alias("share_before_pct"),
        metric(F.col("_sa")).alias("share_after_pct"),
        metric(F.col("_sa") - F.col("_sb")).alias("share_shift_pts"),
    ).orderBy("taxi_type")
