"""The hubs: sums and counts of trips at a few grains, from one pass, that add up.

All results of the audit but the trips themselves follow from six small tables (grains):

=========  ==========================================================================================
file       source file, taxi type, label
day        taxi type, day, label, zone category, period
clock      weekday, hour, label, zone category, period
place      pickup and dropoff location, label, zone category, period
pickup     taxi type, day, pickup location, label: days of the month that is imputed, the others as one
dropoff    the same of dropoff locations
=========  ==========================================================================================

``trip_hubs`` makes them in one scan (grouping sets: each trip counts once in each grain, added up per
task before the only shuffle). Their measures are sums and counts, so hubs of any sets of trips add up:
each ingest run has its own, written once, and ``merged`` adds those of the current runs. Their size is
bounded by the calendar, the files and the location dimension, never by the trips.

A mode is the location with the highest count (the smallest id of several), which ``modes`` takes from the
pickup and dropoff grains; a mean is a sum over a count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cordon.config import CLEAN_LABEL, AuditConfig
from cordon.functions.trip import metric, surcharge_missing, surcharge_paid, trip_date

GRAINS = {
    "file": ("source_file", "taxi_type", "ghost_flag"),
    "day": ("taxi_type", "trip_date", "ghost_flag", "zone_category", "after_congestion_start"),
    "clock": ("pickup_dow", "pickup_hour", "ghost_flag", "zone_category", "after_congestion_start"),
    "place": ("pickup_loc", "dropoff_loc", "ghost_flag", "zone_category", "after_congestion_start"),
    "pickup": ("taxi_type", "mode_date", "mode_pickup", "ghost_flag"),
    "dropoff": ("taxi_type", "mode_date", "mode_dropoff", "ghost_flag"),
}
KEYS = ("source_file", "taxi_type", "trip_date", "pickup_dow", "pickup_hour", "pickup_loc", "dropoff_loc", "mode_date", "mode_pickup",
        "mode_dropoff", "ghost_flag", "zone_category", "after_congestion_start")
_SUMMED = {"speed_mph": "speed", "fare": "fare", "total_amount": "total", "trip_distance": "distance",
           "duration_seconds": "duration", "congestion_surcharge": "surcharge"}
MEASURES = ("trip_count", *[f"{n}_{k}" for n in _SUMMED.values() for k in ("sum", "n")], "total_congestion_collected",
            "trips_with_surcharge", "trips_without_surcharge")


_KEY_TYPES = {"trip_date": "timestamp_ntz", "mode_date": "timestamp_ntz", **dict.fromkeys(
    ("pickup_dow", "pickup_hour", "pickup_loc", "dropoff_loc", "mode_pickup", "mode_dropoff", "after_congestion_start"), "int")}
_LONG = {"trip_count", "trips_with_surcharge", "trips_without_surcharge", *[f"{n}_n" for n in _SUMMED.values()]}
# Hubs of a run as they are stored, one folder a grain.
STORED = ", ".join([*[f"{k} {_KEY_TYPES.get(k, 'string')}" for k in KEYS],
                    *[f"{m} {'long' if m in _LONG else 'double'}" for m in MEASURES], "run_id string", "hub string"])


def _measures() -> list[Column]:
    s = F.col("congestion_surcharge")
    return [
        F.count(F.lit(1)).alias("trip_count"),
        *[f(c).alias(f"{n}_{k}") for c, n in _SUMMED.items() for k, f in (("sum", F.sum), ("n", F.count))],
        F.sum(F.coalesce(s, F.lit(0.0))).alias("total_congestion_collected"),
        F.count_if(surcharge_paid(s)).alias("trips_with_surcharge"),
        F.count_if(surcharge_missing(s)).alias("trips_without_surcharge"),
    ]


def _keyed(classified: DataFrame, cfg: AuditConfig) -> DataFrame:
    day = trip_date(F.col("pickup_time"))
    imputed = F.month("pickup_time") == cfg.impute_month
    return classified.withColumns({
        "trip_date": day, "pickup_hour": F.hour("pickup_time"), "pickup_dow": F.dayofweek("pickup_time"),
        "mode_date": F.when(imputed, day), "mode_pickup": F.when(imputed, F.col("pickup_loc")),
        "mode_dropoff": F.when(imputed, F.col("dropoff_loc"))})


def trip_hub(classified: DataFrame, grain: str, cfg: AuditConfig) -> DataFrame:
    """One grain of labelled and classified trips."""
    return _keyed(classified, cfg).groupBy(*GRAINS[grain]).agg(*_measures())


def trip_hubs(classified: DataFrame, cfg: AuditConfig, grains: Sequence[str] = tuple(GRAINS)) -> DataFrame:
    """Several grains in one pass: column ``hub`` names the grain, keys of other grains are null."""
    keys = [k for k in KEYS if any(k in GRAINS[g] for g in grains)]
    code = {g: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in GRAINS[g]) for g in grains}
    hub = F.lit(None).cast("string")
    for g in grains:
        hub = F.when(F.col("grain") == code[g], F.lit(g)).otherwise(hub)
    sets = [[F.col(k) for k in GRAINS[g]] for g in grains]
    return (_keyed(classified, cfg).groupingSets(sets, *[F.col(k) for k in keys]).agg(F.grouping_id().alias("grain"), *_measures())
            .withColumn("hub", hub).drop("grain"))


def merged(partials: DataFrame, grain: str) -> DataFrame:
    """One grain of the trips behind any number of partial hubs."""
    return partials.filter(F.col("hub") == grain).groupBy(*GRAINS[grain]).agg(*[F.sum(c).alias(c) for c in MEASURES])


# -- views -------------------------------------------------------------------------------------------

def clean(hub: DataFrame) -> DataFrame:
    return hub.filter(F.col("ghost_flag") == CLEAN_LABEL)


def ghosts(hub: DataFrame) -> DataFrame:
    return hub.filter(F.col("ghost_flag") != CLEAN_LABEL)


def after_start(places: DataFrame) -> DataFrame:
    """Clean trips after the policy start per pair of locations: what the location reports read."""
    return clean(places).filter(F.col("after_congestion_start") == 1)


def mean(name: str) -> Column:
    """Mean of a measure over the grouped hub rows; null if there are no values."""
    return F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0).cast("long"))


def count() -> Column:
    return F.sum("trip_count").alias("trip_count")


def sums(*names: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in names]


# -- results that need nothing but one hub ---------------------------------------------------------------

def zone_summary(days: DataFrame) -> DataFrame:
    """Trips and mean surcharge (NULL as 0) by category and period."""
    return (clean(days).groupBy("zone_category", "after_congestion_start")
            .agg(count(), metric(F.sum("total_congestion_collected") / F.sum("trip_count")).alias("avg_surcharge"))
            .orderBy("zone_category", "after_congestion_start"))


def _pattern(clock: DataFrame, bucket: str) -> DataFrame:
    return clean(clock).groupBy(bucket, "zone_category", "after_congestion_start").agg(
        count(), metric(mean("fare")).alias("avg_fare"), *sums("trips_with_surcharge", "trips_without_surcharge"))


def zone_hourly(clock: DataFrame) -> DataFrame:
    """Trips by pickup hour, category and period (I4)."""
    return _pattern(clock, "pickup_hour")


def zone_dow(clock: DataFrame) -> DataFrame:
    """Trips by pickup day of week (1 = Sunday .. 7 = Saturday), category and period."""
    return _pattern(clock, "pickup_dow")


def ghost_by_hour_dow(clock: DataFrame) -> DataFrame:
    """Ghost trips by pickup hour, day of week and label."""
    return ghosts(clock).groupBy("pickup_hour", "pickup_dow", "ghost_flag").agg(
        count(), metric(mean("fare")).alias("avg_fare"))


def ghost_by_location(places: DataFrame) -> DataFrame:
    """Ghost trips by location, counted once as pickup and once as dropoff."""
    pairs = ghosts(places).select("ghost_flag", "trip_count", F.inline(F.array(
        F.struct(F.lit("pickup").alias("location_role"), F.col("pickup_loc").alias("location_id")),
        F.struct(F.lit("dropoff").alias("location_role"), F.col("dropoff_loc").alias("location_id")))))
    return pairs.groupBy("location_role", "location_id", "ghost_flag").agg(count())


def modes(locations: DataFrame, key: str, *by: str) -> DataFrame:
    """The commonest location of each group, the smallest id of several: an arg-max over summed counts."""
    per = clean(locations).groupBy(*by, key).agg(F.sum("trip_count").alias("n"))
    return per.groupBy(*by).agg(F.min_by(key, F.struct(-F.col("n"), F.col(key))).alias(key))


def value_drift(files: DataFrame) -> DataFrame:
    """Per source file and optional column: rows and values. A column without any value in a file that has
    rows was dropped there, if another file of its type has values (S13)."""
    per_file = files.groupBy("taxi_type", "source_file").agg(
        count(), *[F.sum(f"{n}_n").alias(c) for c, n in _SUMMED.items() if c not in ("speed_mph", "duration_seconds")])
    columns = ("fare", "total_amount", "trip_distance", "congestion_surcharge")
    long = per_file.select("taxi_type", "source_file", "trip_count", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for c in columns])))
    known = long.groupBy("taxi_type", "column_name").agg(F.max("n_values").alias("most"))
    return (long.join(known, ["taxi_type", "column_name"]).select(
        "taxi_type", "source_file", "column_name", F.col("trip_count").alias("row_count"), "n_values",
        ((F.col("n_values") == 0) & (F.col("most") > 0)).alias("dropped")))
