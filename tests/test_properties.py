"""Invariants of the audit on the sf0.001 driver tables."""

from pyspark.sql import functions as F

from cordon.config import FIXTURE_CONFIG as CFG, GHOST_LABELS
from cordon.operators import anomaly, hubs, series
from cordon.plans import catalog


def test_clean_plus_ghost_is_total(spark, sf_small):
    flagged = catalog.flagged(spark, sf_small)
    total = flagged.count()
    assert anomaly.clean_trips(flagged).count() + anomaly.ghost_trips(flagged).count() == total
    t = {r.taxi_type: r for r in anomaly.ghost_totals(anomaly.anomaly_hub(flagged)).collect()}
    assert t["all"].total_trips == total == t["yellow"].total_trips + t["green"].total_trips
    assert t["all"].ghost_trips == sum(getattr(t["all"], f"{g}_trips") for g in GHOST_LABELS)


def test_label_counts_of_the_fixture(spark, sf_small):
    # Counts measured on the same projection (FIXTURES.md, sf0.001 column).
    t = {r.taxi_type: r for r in anomaly.ghost_totals(catalog.hub(spark, sf_small)).collect()}["all"]
    assert (t.total_trips, t.clean_trips) == (6000, 5120)
    assert (t.excessive_speed_trips, t.short_trip_high_fare_trips, t.zero_distance_positive_fare_trips,
            t.negative_duration_trips, t.negative_fare_trips) == (493, 18, 137, 3, 229)


def test_rollup_partitions_the_clean_trips(spark, sf_small):
    clean_n = catalog.clean(spark, sf_small).count()
    rollup = catalog.rollup(spark, sf_small)
    agg = rollup.agg(F.sum("trip_count").alias("n"), F.sum("trips_with_surcharge").alias("w"),
                     F.sum("trips_without_surcharge").alias("wo")).collect()[0]
    assert agg.n == clean_n
    negative = catalog.clean(spark, sf_small).filter(F.col("congestion_surcharge") < 0).count()
    assert agg.w + agg.wo + negative == agg.n
    per_cat = {r.zone_category: r.trips_before_start + r.trips_after_start
               for r in series.zone_period_pivot(rollup).collect()}
    assert sum(per_cat.values()) == clean_n


def test_zone_split_of_the_fixture(spark, sf_small):
    got = {(r.zone_category, r.after_congestion_start): r.trip_count
           for r in hubs.zone_summary(catalog.hub_of(spark, sf_small, "day")).collect()}
    assert got == {("entering_zone", 0): 478, ("entering_zone", 1): 68, ("exiting_zone", 0): 401,
                   ("exiting_zone", 1): 47, ("inside_zone", 0): 57, ("inside_zone", 1): 7,
                   ("outside_zone", 0): 3584, ("outside_zone", 1): 478}


def test_cumulative_ends_at_total(spark, sf_small):
    rollup = catalog.rollup(spark, sf_small)
    rows = series.revenue_daily_cumulative(rollup).collect()
    total = rollup.filter("after_congestion_start = 1").agg(F.sum("total_congestion_collected")).collect()[0][0]
    assert abs(rows[-1].cumulative_revenue - total) < 0.01
    assert all(a.cumulative_revenue <= b.cumulative_revenue for a, b in zip(rows, rows[1:]))


def test_literal_same_location_report_equals_intended_filter(spark, sf_small):
    same = {r.pickup_loc for r in catalog.QUERIES["top_pickups_same_loc"](spark, sf_small).collect()}
    direct = {r.pickup_loc for r in catalog.classified(spark, sf_small)
              .filter("after_congestion_start = 1 AND pickup_loc = dropoff_loc").select("pickup_loc").distinct().collect()}
    assert same == direct


def test_queries_are_deterministic(spark, sf_small):
    for name in ("zone_daily", "impute_month", "top_pickups_entering"):
        a = sorted(map(tuple, catalog.QUERIES[name](spark, sf_small).collect()))
        b = sorted(map(tuple, catalog.QUERIES[name](spark, sf_small).collect()))
        assert a == b, name


def test_imputed_count_rounds_half_away_from_zero(spark):
    from datetime import datetime

    from cordon.config import UNIFIED_COLUMNS, UNIFIED_TYPES
    from cordon.operators import impute
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, UNIFIED_TYPES[c], True) for c in UNIFIED_COLUMNS]
                          + [T.StructField("taxi_type", T.StringType(), True)])
    old, new = CFG.impute_older_year, CFG.impute_newer_year

    def t(y, day, loc):
        ts = datetime(y, 12, day, 10)
        return (ts, ts, loc, loc, 1.0, 10.0, 10.0, None, "green")

    # day 1: 1 older + 2 newer -> 0.3 + 1.4 = 1.7 -> 2; day 2: 5 older + 0 newer -> dropped;
    # day 3: 5 older + 5 newer -> 5.0 -> 5; newer-year mode tie 3 vs 4 -> 3.
    rows = [t(old, 1, 9)] + [t(new, 1, 4), t(new, 1, 3)] + [t(old, 2, 1)] * 5 + [t(old, 3, 1)] * 5 \
        + [t(new, 3, 7)] * 5
    out = {r.day_of_month: r for r in impute.impute_month(spark.createDataFrame(rows, schema), CFG).collect()}
    assert sorted(out) == [1, 3]
    assert out[1].imputed_trip_count == 2 and out[3].imputed_trip_count == 5
    assert out[1].typical_pickup == 3 and out[3].typical_pickup == 7
    assert out[1].imputed_avg_congestion == 0.0
