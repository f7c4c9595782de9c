"""Registered queries over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from the whole tables
through the fixture projection (FIXTURES.md) and the audit operators. Shared stages are plain
functions, so a query is one Catalyst plan from the Parquet scans to its result; only queries that read
several merged hubs write the hubs first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cordon.config import FIXTURE_CONFIG as CFG
from cordon.operators import anomaly, compare, hubs, impute, kpi, leakage, series, unify, weather, zones
from cordon.session import scratch_path
from cordon.sources import fixture, inventory, schema

Query = Callable[[SparkSession, str], DataFrame]


# -- shared stages ---------------------------------------------------------------------------

def raw_by_type(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {t: fixture.raw_trips(spark, d, t) for t in CFG.taxi_types}


def unified(spark: SparkSession, d: str) -> DataFrame:
    return unify.unify_tagged(fixture.raw_tagged(spark, d), CFG.column_maps)


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.flag_trips(unified(spark, d), CFG)


def hub(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.anomaly_hub(flagged(spark, d))


def clean(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.clean_trips(flagged(spark, d))


def ghosts(spark: SparkSession, d: str) -> DataFrame:
    return anomaly.ghost_trips(flagged(spark, d))


def zone_ids(spark: SparkSession, d: str) -> DataFrame:
    return zones.zone_id_set(zones.congestion_zones(fixture.zones(spark, d), CFG), CFG)


def classified(spark: SparkSession, d: str) -> DataFrame:
    return zones.classify(clean(spark, d), zone_ids(spark, d), CFG)


def places(spark: SparkSession, d: str) -> DataFrame:
    return zones.location_hub(classified(spark, d), CFG)


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Every trip, clean or not, with its label and its zone category."""
    return zones.classify(flagged(spark, d), zone_ids(spark, d), CFG)


def hub_of(spark: SparkSession, d: str, grain: str) -> DataFrame:
    return hubs.trip_hub(labelled(spark, d), grain, CFG)


def all_hubs(spark: SparkSession, d: str) -> DataFrame:
    """All hubs by one scan, as an ingest run writes them."""
    return hubs.trip_hubs(labelled(spark, d), CFG)


def merged_hubs(spark: SparkSession, d: str, *grains: str) -> list[DataFrame]:
    """The hubs of some grains. Several are read from the hubs written once, as an ingest run does: from an
    unwritten frame each grain would join and scan all trips again."""
    every = all_hubs(spark, d)
    if len(grains) > 1:
        path = scratch_path(spark, "hubs")
        every.write.parquet(path)
        every = spark.read.schema(every.schema).parquet(path)
    return [hubs.merged(every, g) for g in grains]


def processed_months(spark: SparkSession, d: str) -> DataFrame:
    """Months of the clean trips that a run before the policy start has taken."""
    t = clean(spark, d).filter(F.col("pickup_time") < F.lit(CFG.policy_start_literal).cast("timestamp_ntz"))
    return t.select("taxi_type", F.year("pickup_time").alias("year"), F.month("pickup_time").alias("month")).distinct()


def rollup(spark: SparkSession, d: str) -> DataFrame:
    return zones.zone_daily(classified(spark, d))


def counts(spark: SparkSession, d: str) -> DataFrame:
    return inventory.source_row_counts(raw_by_type(spark, d))


def weather_daily(spark: SparkSession, d: str) -> DataFrame:
    return weather.weather_joined(rollup(spark, d), fixture.weather(spark, d), CFG)


# -- registered queries ----------------------------------------------------------------------

QUERIES: dict[str, Query] = {
    # sources and inventory
    "source_row_counts": lambda s, d: counts(s, d),
    "missing_months": lambda s, d: inventory.missing_months(s, counts(s, d), CFG),
    "impute_needed": lambda s, d: inventory.impute_needed(counts(s, d), CFG),
    "schema_check": lambda s, d: schema.schema_check(unified(s, d).drop("taxi_type", "source_file")),
    "raw_schema_check": lambda s, d: schema.raw_schema_check(raw_by_type(s, d)),
    "file_inventory": lambda s, d: inventory.source_row_counts(raw_by_type(s, d), inventory.expected_files(s, CFG)),
    "unprocessed_months": lambda s, d: inventory.unprocessed_months(counts(s, d), processed_months(s, d)),
    # unification
    "unify_yellow": lambda s, d: unify.unify(fixture.raw_trips(s, d, "yellow"), CFG.column_maps["yellow"], "yellow"),
    "unify_green": lambda s, d: unify.unify(fixture.raw_trips(s, d, "green"), CFG.column_maps["green"], "green"),
    "unify_all": lambda s, d: unify.unify_all(raw_by_type(s, d), CFG.column_maps),
    "unify_tagged": lambda s, d: unified(s, d),
    # anomaly split
    "ghost_flags": lambda s, d: flagged(s, d),
    "clean_trips": lambda s, d: clean(s, d),
    "ghost_trips": lambda s, d: ghosts(s, d),
    "ghost_stats": lambda s, d: anomaly.ghost_stats(hub(s, d)),
    "ghost_totals": lambda s, d: anomaly.ghost_totals(hub(s, d)),
    "ghost_patterns": lambda s, d: anomaly.ghost_patterns(hub(s, d)),
    "ghost_stats_merged": lambda s, d: anomaly.ghost_stats(*merged_hubs(s, d, "file")),
    "value_drift": lambda s, d: hubs.value_drift(hub_of(s, d, "file")),
    "ghost_by_hour_dow": lambda s, d: hubs.ghost_by_hour_dow(hub_of(s, d, "clock")),
    "ghost_by_location": lambda s, d: hubs.ghost_by_location(hub_of(s, d, "place")),
    # imputation
    "month_profile": lambda s, d: impute.month_profile(clean(s, d), CFG),
    "impute_month": lambda s, d: impute.impute_month(clean(s, d), CFG),
    "month_profile_merged": lambda s, d: impute.month_profile_from_hubs(*merged_hubs(s, d, "day", "pickup", "dropoff"), CFG),
    "impute_month_merged": lambda s, d: impute.impute_month_from_hubs(*merged_hubs(s, d, "day", "pickup", "dropoff"), CFG),
    "impute_total": lambda s, d: impute.impute_total(impute.impute_month(clean(s, d), CFG)),
    # zones
    "congestion_zones": lambda s, d: zones.congestion_zones(fixture.zones(s, d), CFG),
    "congestion_zone_sample": lambda s, d: zones.zone_name_sample(zones.congestion_zones(fixture.zones(s, d), CFG)),
    "classify_trips": lambda s, d: classified(s, d),
    "zone_daily": lambda s, d: zones.zone_daily_report(rollup(s, d)),
    "zone_daily_merged": lambda s, d: zones.zone_daily_report(
        zones.zone_daily_from_partials(zones.zone_daily_partials(classified(s, d)))),
    "zone_daily_from_days": lambda s, d: zones.zone_daily_report(
        zones.zone_daily_from_partials(hubs.clean(*merged_hubs(s, d, "day")))),
    "zone_summary": lambda s, d: hubs.zone_summary(hub_of(s, d, "day")),
    "top_pickups_entering": lambda s, d: zones.top_pickups_entering(places(s, d), CFG),
    "top_pickups_same_loc": lambda s, d: zones.top_pickups_same_loc(places(s, d), CFG),
    "top_dropoffs_exiting": lambda s, d: zones.top_dropoffs_exiting(places(s, d), CFG),
    "zone_hourly": lambda s, d: hubs.zone_hourly(hub_of(s, d, "clock")),
    "zone_dow": lambda s, d: hubs.zone_dow(hub_of(s, d, "clock")),
    # leakage and key figures
    "leakage_summary": lambda s, d: leakage.leakage_summary(rollup(s, d), CFG),
    "top_leakage_pickups": lambda s, d: leakage.top_leakage_pickups(places(s, d), CFG),
    "kpi_overview": lambda s, d: kpi.kpi_overview(rollup(s, d), CFG),
    # period comparison
    "quarter_stats": lambda s, d: compare.quarter_stats(clean(s, d), CFG),
    "quarter_comparison": lambda s, d: compare.quarter_comparison(clean(s, d), CFG),
    "market_share_shift": lambda s, d: compare.market_share_shift(clean(s, d), CFG),
    "quarter_stats_merged": lambda s, d: compare.quarter_stats_from_days(*merged_hubs(s, d, "day"), CFG),
    "quarter_comparison_merged": lambda s, d: compare.quarter_comparison_from_days(*merged_hubs(s, d, "day"), CFG),
    "market_share_shift_merged": lambda s, d: compare.market_share_shift_from_days(*merged_hubs(s, d, "day"), CFG),
    # series from the rollup
    "daily_trips": lambda s, d: series.daily_trips(rollup(s, d)),
    "revenue_daily_cumulative": lambda s, d: series.revenue_daily_cumulative(rollup(s, d)),
    "zone_period": lambda s, d: series.zone_period(rollup(s, d), CFG),
    "daily_leakage": lambda s, d: series.daily_leakage(rollup(s, d)),
    "zone_revenue": lambda s, d: series.zone_revenue(rollup(s, d)),
    "zone_period_pivot": lambda s, d: series.zone_period_pivot(rollup(s, d)),
    # weather
    "weather_joined": lambda s, d: weather.weather_joined_report(weather_daily(s, d)),
    "weather_correlation": lambda s, d: weather.weather_correlation(weather_daily(s, d)),
    "rain_effect": lambda s, d: weather.rain_effect(weather_daily(s, d)),
    "precip_elasticity": lambda s, d: weather.precip_elasticity(weather_daily(s, d)),
    "rain_compliance": lambda s, d: weather.rain_compliance(rollup(s, d), fixture.weather(s, d), CFG),
}
