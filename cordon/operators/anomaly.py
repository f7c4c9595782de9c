"""Rule-based anomaly split (P4-P8) and its statistics (A1-A3).

One label column is computed per trip with a first-match CASE; the clean and the ghost (audit)
sets are two filters of the same frame, so nothing is dropped: every trip lands in exactly one.
All statistics are grouped aggregations with map-side partial aggregation; their outputs are
bounded by the number of labels (and hours, days or locations), never by the number of trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cordon.config import CLEAN_LABEL, GHOST_LABELS, UNIFIED_COLUMNS, AuditConfig
from cordon.functions.trip import duration_seconds, ghost_flag, metric, pct, speed_mph

FLAG_COLUMNS = ("duration_seconds", "speed_mph", "ghost_flag")


def flag_trips(unified: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Add ``duration_seconds``, ``speed_mph`` and the first-match ``ghost_flag`` label."""
    dur = duration_seconds(F.col("pickup_time"), F.col("dropoff_time"))
    with_dur = unified.withColumn("duration_seconds", dur)
    d = F.col("duration_seconds")
    return with_dur.withColumns({
        "speed_mph": speed_mph(F.col("trip_distance"), d),
        "ghost_flag": ghost_flag(F.col("trip_distance"), d, F.col("fare"), F.col("total_amount"), cfg),
    })


def clean_trips(flagged: DataFrame) -> DataFrame:
    """Trips that passed every rule, in the unified columns (plus ``taxi_type``)."""
    keep = [*UNIFIED_COLUMNS, "taxi_type"]
    return flagged.filter(F.col("ghost_flag") == CLEAN_LABEL).select(*keep)


def ghost_trips(flagged: DataFrame) -> DataFrame:
    """Audit trail: every flagged trip with its label, measures and source lineage."""
    return flagged.filter(F.col("ghost_flag") != CLEAN_LABEL)


HUB_KEYS = ("source_file", "taxi_type", "ghost_flag")
_MEASURES = {"speed_mph": "speed", "fare": "fare", "trip_distance": "distance", "duration_seconds": "duration"}


def anomaly_hub(flagged: DataFrame) -> DataFrame:
    """Counts and sums per source file, type and label: one pass over the trips, one row per file and
    label, from which all split statistics follow."""
    return flagged.groupBy(*HUB_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        *[f(c).alias(f"{name}_{kind}") for c, name in _MEASURES.items() for kind, f in (("sum", F.sum), ("n", F.count))])


def _mean(name: str):
    """Mean from the sums and counts of hub rows."""
    return metric(F.sum(F.col(f"{name}_sum").cast("double")) / F.nullif(F.sum(f"{name}_n"), F.lit(0).cast("long")))


def ghost_stats(hub: DataFrame) -> DataFrame:
    """Per source file and label (clean included): count and rounded means."""
    return (
        hub.groupBy(*HUB_KEYS)
        .agg(
            F.sum("trip_count").alias("trip_count"),
            _mean("speed").alias("avg_speed_mph"),
            _mean("fare").alias("avg_fare"),
            _mean("distance").alias("avg_distance"),
        )
        .orderBy(F.col("source_file"), F.col("trip_count").desc(), F.col("ghost_flag"))
    )


def ghost_totals(hub: DataFrame) -> DataFrame:
    """Run totals per taxi type and over all types: total, clean, ghost, rate and per-rule counts."""
    label, n = F.col("ghost_flag"), F.col("trip_count")

    def count_of(condition):
        return F.sum(F.when(condition, n).otherwise(F.lit(0).cast("long")))

    per_type = hub.groupBy("taxi_type").agg(
        F.sum(n).alias("total_trips"),
        count_of(label == CLEAN_LABEL).alias("clean_trips"),
        count_of(label != CLEAN_LABEL).alias("ghost_trips"),
        *[count_of(label == g).alias(f"{g}_trips") for g in GHOST_LABELS],
    )
    counts = [c for c in per_type.columns if c != "taxi_type"]
    out = per_type.rollup("taxi_type").agg(*[F.sum(c).alias(c) for c in counts])  # one row a type
    return out.select(
        F.coalesce(F.col("taxi_type"), F.lit("all")).alias("taxi_type"),
        "total_trips", "clean_trips", "ghost_trips",
        pct(F.col("ghost_trips"), F.col("total_trips")).alias("ghost_rate_pct"),
        *[f"{g}_trips" for g in GHOST_LABELS],
    )


def ghost_patterns(hub: DataFrame) -> DataFrame:
    """Ghost-only profile per label, over all files, with mean duration."""
    return (
        hub.filter(F.col("ghost_flag") != CLEAN_LABEL).groupBy("ghost_flag")
        .agg(
            F.sum("trip_count").alias("trip_count"),
            _mean("speed").alias("avg_speed"),
            _mean("fare").alias("avg_fare"),
            _mean("distance").alias("avg_distance"),
            _mean("duration").alias("avg_duration_sec"),
        )
        .orderBy(F.col("trip_count").desc(), F.col("ghost_flag"))
    )
