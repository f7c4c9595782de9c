"""Tolled-zone selection, trip classification and the zone-day rollup.

The rollup (``zone_daily``) is the hub: one row per (day, category, period), so it grows with the
calendar, not with the trips. Every later result reads it, so it is written once and reused.
Classification is two broadcast hash joins against the (size-checked) zone id set: the trip side
is never shuffled for it, and the category stays inside the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cordon.config import ENTERING, EXITING, AuditConfig
from cordon.functions.trip import (
    after_start, metric, pct, surcharge_missing, surcharge_paid, trip_date, zone_category,
)
from cordon.operators.joins import bounded_broadcast
from cordon.operators.periods import since_start

ROLLUP_KEYS = ("trip_date", "zone_category", "after_congestion_start")


def keyword_pattern(cfg: AuditConfig) -> str:
    """One case-insensitive alternation of the zone keywords (they are matched as regex text)."""
    return "(?i)" + "|".join(cfg.zone_keywords)


def congestion_zones(zones: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Zones of the tolled area: borough equality and a keyword match on the name (NULL: no match)."""
    name_match = F.coalesce(F.col("zone").rlike(keyword_pattern(cfg)), F.lit(False))
    return zones.filter((F.col("borough") == cfg.zone_borough) & name_match).select("LocationID", "zone", "borough")


def zone_name_sample(zones_in_area: DataFrame, n: int = 5) -> DataFrame:
    """A few zones of the tolled area, lowest ids first (a sample for reports and logs)."""
    return zones_in_area.orderBy("LocationID", "zone").limit(n)


def zone_id_set(zones_in_area: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Distinct zone ids, broadcast when their count is proven small."""
    ids = zones_in_area.select(F.col("LocationID").cast("int").alias("zone_id")).dropna().distinct()
    return bounded_broadcast(ids, cfg.broadcast_max_rows)


def classify(trips: DataFrame, zone_ids: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Add ``pickup_in_zone``, ``dropoff_in_zone`` (0/1), ``zone_category`` and ``after_congestion_start``."""
    pick = zone_ids.select(F.col("zone_id").alias("_pz"), F.lit(1).alias("pickup_in_zone"))
    drop = zone_ids.select(F.col("zone_id").alias("_dz"), F.lit(1).alias("dropoff_in_zone"))
    joined = (
        trips.join(pick, F.col("pickup_loc") == F.col("_pz"), "left")
        .join(drop, F.col("dropoff_loc") == F.col("_dz"), "left")
        .drop("_pz", "_dz")
    )
    pin = F.coalesce(F.col("pickup_in_zone"), F.lit(0))
    din = F.coalesce(F.col("dropoff_in_zone"), F.lit(0))
    return joined.withColumns({
        "pickup_in_zone": pin,
        "dropoff_in_zone": din,
    }).withColumns({
        "zone_category": zone_category(F.col("pickup_in_zone"), F.col("dropoff_in_zone")),
        "after_congestion_start": after_start(F.col("pickup_time"), cfg),
    })


def _surcharge_measures() -> list:
    s = F.col("congestion_surcharge")
    return [
        F.count_if(surcharge_paid(s)).alias("trips_with_surcharge"),
        F.count_if(surcharge_missing(s)).alias("trips_without_surcharge"),
    ]


def rollup_measures() -> list:
    """The measures of the zone-day rollup (shared by the batch and the streaming rollup); ``fare_n`` is how
    many trips have a fare, the weight of their mean."""
    s0 = F.coalesce(F.col("congestion_surcharge"), F.lit(0.0))
    return [
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("fare").alias("avg_fare"),
        F.count("fare").alias("fare_n"),
        F.avg("total_amount").alias("avg_total"),
        F.avg("trip_distance").alias("avg_distance"),
        F.sum(s0).alias("total_congestion_collected"),
        F.avg(s0).alias("avg_congestion_surcharge"),
        *_surcharge_measures(),
    ]


def zone_daily(classified: DataFrame) -> DataFrame:
    """The hub rollup by (day, category, period)."""
    return classified.groupBy(
        trip_date(F.col("pickup_time")).alias("trip_date"), "zone_category", "after_congestion_start"
    ).agg(*rollup_measures())


# -- mergeable form: sums and counts of any set of trips, so that increments and micro-batches add up ----

PARTIAL_SUMS = ("trip_count", "fare_sum", "fare_n", "total_sum", "total_n", "distance_sum", "distance_n",
                "total_congestion_collected", "trips_with_surcharge", "trips_without_surcharge")


def zone_daily_partials(classified: DataFrame) -> DataFrame:
    """Partial rollup (sums and counts) of a set of classified trips."""
    s0 = F.coalesce(F.col("congestion_surcharge"), F.lit(0.0))
    return classified.groupBy(
        trip_date(F.col("pickup_time")).alias("trip_date"), "zone_category", "after_congestion_start"
    ).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("fare").alias("fare_sum"), F.count("fare").alias("fare_n"),
        F.sum("total_amount").alias("total_sum"), F.count("total_amount").alias("total_n"),
        F.sum("trip_distance").alias("distance_sum"), F.count("trip_distance").alias("distance_n"),
        F.sum(s0).alias("total_congestion_collected"),
        *_surcharge_measures(),
    )


def zone_daily_from_partials(partials: DataFrame) -> DataFrame:
    """The zone-day rollup from any number of partial rows per key (same columns as ``zone_daily``)."""
    m = partials.groupBy(*ROLLUP_KEYS).agg(*[F.sum(c).alias(c) for c in PARTIAL_SUMS])

    def mean(s, n):
        return F.col(s) / F.nullif(F.col(n), F.lit(0).cast("long"))

    return m.select(
        *ROLLUP_KEYS,
        "trip_count",
        mean("fare_sum", "fare_n").alias("avg_fare"),
        "fare_n",
        mean("total_sum", "total_n").alias("avg_total"),
        mean("distance_sum", "distance_n").alias("avg_distance"),
        "total_congestion_collected",
        (F.col("total_congestion_collected") / F.col("trip_count")).alias("avg_congestion_surcharge"),
        "trips_with_surcharge", "trips_without_surcharge",
    )


def zone_daily_report(rollup: DataFrame) -> DataFrame:
    """The rollup's eight reported measures, doubles at reporting precision (for display and comparison)."""
    doubles = ["avg_fare", "avg_total", "avg_distance", "total_congestion_collected", "avg_congestion_surcharge"]
    return rollup.drop("fare_n").withColumns({c: metric(F.col(c)) for c in doubles})


LOCATION_KEYS = ("pickup_loc", "dropoff_loc", "zone_category")


def location_hub(classified: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Counts and sums of the trips after the start per pair of locations and category: one pass, and a
    row per pair that occurs (the location dimension squared at most). All location reports read it."""
    after = since_start(classified, cfg.policy_start).filter(F.col("after_congestion_start") == 1)
    return after.groupBy(*LOCATION_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"), F.sum("fare").alias("fare_sum"), F.count("fare").alias("fare_n"),
        *_surcharge_measures())


def _top_locations(hub: DataFrame, key: str, k: int) -> DataFrame:
    """Top-k locations by trip count (ties broken by location id): a distributed take-ordered."""
    agg = hub.groupBy(key).agg(
        F.sum("trip_count").alias("trip_count"),
        metric(F.sum("fare_sum") / F.nullif(F.sum("fare_n"), F.lit(0).cast("long"))).alias("avg_fare"),
        *[F.sum(c).alias(c) for c in ("trips_with_surcharge", "trips_without_surcharge")],
    )
    agg = agg.withColumn("compliance_pct", pct(F.col("trips_with_surcharge"), F.col("trip_count")))
    return agg.orderBy(F.col("trip_count").desc(), F.col(key).asc()).limit(k)


def top_pickups_entering(hub: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Pickup locations of trips entering the zone after the start (the stated intent)."""
    return _top_locations(hub.filter(F.col("zone_category") == ENTERING), "pickup_loc", cfg.top_k)


def top_pickups_same_loc(hub: DataFrame, cfg: AuditConfig) -> DataFrame:
    """The same report as the audited SQL evaluates it: its subquery binds ``pickup_loc`` to the
    outer row, so the membership test reduces to ``dropoff_loc = pickup_loc`` (the rollup it reads
    is non-empty exactly when there are clean trips)."""
    return _top_locations(hub.filter(F.col("dropoff_loc") == F.col("pickup_loc")), "pickup_loc", cfg.top_k)


def top_dropoffs_exiting(hub: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Dropoff locations of trips leaving the zone after the start."""
    return _top_locations(hub.filter(F.col("zone_category") == EXITING), "dropoff_loc", cfg.top_k)
