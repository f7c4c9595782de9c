"""Edge cases of the first-match anomaly rules, on hand-made trips."""

from datetime import datetime, timedelta

import pytest
from cordon.config import FIXTURE_CONFIG as CFG, UNIFIED_COLUMNS, UNIFIED_TYPES, AuditConfig
from cordon.operators.anomaly import clean_trips, flag_trips, ghost_trips
from pyspark.sql import types as T

T0 = datetime(2000, 3, 1, 12, 0, 0)
SCHEMA = T.StructType([T.StructField(c, UNIFIED_TYPES[c], True) for c in UNIFIED_COLUMNS]
                      + [T.StructField("taxi_type", T.StringType(), True)])


def trip(seconds, distance, fare, total=None, surcharge=2.5):
    return (T0, T0 + timedelta(seconds=seconds), 1, 2, distance, fare,
            fare if total is None else total, surcharge, "yellow")


def trip_total(seconds, distance, fare, total):
    return (T0, T0 + timedelta(seconds=seconds), 1, 2, distance, fare, total, 2.5, "yellow")


def label(spark, *trips, cfg=CFG):
    df = spark.createDataFrame(list(trips), SCHEMA)
    return [r.ghost_flag for r in flag_trips(df, cfg).collect()]


@pytest.mark.parametrize("seconds,distance,fare,expected", [
    (0, 1.0, 10.0, "excessive_speed"),           # x/0 = +inf > 65
    (0, 0.0, 10.0, "excessive_speed"),           # 0/0 = NaN, ordered above every number
    (0, -1.0, 10.0, "zero_distance_positive_fare"),  # -inf is not > 65; rule 3 comes before rule 4
    (0, -1.0, 0.0, "negative_duration"),
    (3600, 65.0, 10.0, "clean"),                 # exactly 65 mph is not > 65
    (3600, 65.5, 10.0, "excessive_speed"),
    (59, 0.5, 20.01, "short_trip_high_fare"),
    (59, 0.5, 20.0, "clean"),                    # fare must exceed 20
    (60, 0.5, 25.0, "clean"),                    # 60 s is not short
    (600, 0.01, 5.0, "zero_distance_positive_fare"),
    (600, 0.011, 5.0, "clean"),
    (600, 0.0, 0.0, "clean"),                    # zero fare is not positive
    (600, -2.0, 5.0, "zero_distance_positive_fare"),
    (-30, 0.5, 5.0, "negative_duration"),        # negative speed is not > 65
    (-30, 0.5, 25.0, "short_trip_high_fare"),    # rule 2 takes negative durations first
    (600, 1.0, -5.0, "negative_fare"),
    (-30, -1.0, 5.0, "excessive_speed"),         # both negative: positive speed above 65
])
def test_rule_edges(spark, seconds, distance, fare, expected):
    assert label(spark, trip(seconds, distance, fare)) == [expected]


def test_negative_total_only(spark):
    assert label(spark, trip(600, 1.0, 5.0, total=-1.0)) == ["negative_fare"]


def test_nulls_do_not_fire(spark):
    # NULL distance: rules 1 and 3 are NULL, so a row with an ordinary duration and fare is clean.
    assert label(spark, trip(600, None, 10.0)) == ["clean"]
    # NULL fare with a negative total still hits rule 5 (OR with a true side).
    assert label(spark, trip(600, 1.0, None, total=-3.0)) == ["negative_fare"]
    # NULL fare and total: nothing fires.
    assert label(spark, trip_total(600, 1.0, None, None)) == ["clean"]
    # Zero duration with NULL distance: rule 1 is NULL, rule 4 fires.
    assert label(spark, trip(0, None, 10.0)) == ["negative_duration"]


def test_zero_duration_switch(spark):
    cfg = AuditConfig(zero_duration_is_speeding=False)
    assert label(spark, trip(0, 1.0, 10.0), cfg=cfg) == ["negative_duration"]


def test_speed_and_duration_columns(spark):
    df = spark.createDataFrame([trip(1800, 10.0, 30.0), trip(0, 1.0, 5.0), trip(-60, 1.0, 5.0)], SCHEMA)
    rows = flag_trips(df, CFG).collect()
    assert [r.duration_seconds for r in rows] == [1800.0, 0.0, -60.0]
    assert rows[0].speed_mph == pytest.approx(20.0)
    assert rows[1].speed_mph == 0.0 and rows[2].speed_mph == 0.0


def test_fractional_seconds_are_kept(spark):
    df = spark.createDataFrame([(T0, T0 + timedelta(seconds=59, microseconds=500000), 1, 2, 1.0, 25.0, 25.0, 2.5,
                                 "yellow")], SCHEMA)
    r = flag_trips(df, CFG).collect()[0]
    assert r.duration_seconds == 59.5 and r.ghost_flag == "short_trip_high_fare"


def test_split_keeps_every_row(spark):
    trips = [trip(600, 1.0, 10.0), trip(0, 1.0, 10.0), trip(600, 1.0, -1.0), trip(59, 0.5, 30.0)]
    flagged = flag_trips(spark.createDataFrame(trips, SCHEMA), CFG)
    assert clean_trips(flagged).count() + ghost_trips(flagged).count() == len(trips)
    assert clean_trips(flagged).columns == [*UNIFIED_COLUMNS, "taxi_type"]


def _duck_label(seconds, distance, fare, total):
    import duckdb

    from cordon.plans.oracle import EPOCH

    sql = f"""
    SELECT CASE
      WHEN trip_distance / ({EPOCH} / 3600.0) > {CFG.max_speed_mph} THEN 'excessive_speed'
      WHEN {EPOCH} < {CFG.short_trip_seconds} AND fare > {CFG.high_fare} THEN 'short_trip_high_fare'
      WHEN trip_distance <= {CFG.min_distance_miles} AND fare > 0 THEN 'zero_distance_positive_fare'
      WHEN {EPOCH} <= 0 THEN 'negative_duration'
      WHEN fare < 0 OR total_amount < 0 THEN 'negative_fare'
      ELSE 'clean' END
    FROM (SELECT TIMESTAMP '2000-03-01 12:00:00' AS pickup_time,
                 TIMESTAMP '2000-03-01 12:00:00' + to_microseconds(CAST(CAST(? AS DOUBLE) * 1000000 AS BIGINT)) AS dropoff_time,
                 CAST(? AS DOUBLE) AS trip_distance, CAST(? AS DOUBLE) AS fare, CAST(? AS DOUBLE) AS total_amount)"""
    return duckdb.execute(sql, [seconds, distance, fare, total]).fetchone()[0]


@pytest.mark.parametrize("seconds,distance,fare,total", [
    (0, 1.0, 10.0, 10.0), (0, 0.0, 10.0, 10.0), (0, -1.0, 10.0, 10.0), (0, -1.0, 0.0, 0.0), (3600, 65.0, 1.0, 1.0),
    (59, 0.5, 20.01, 20.01), (59, 0.5, 20.0, 20.0), (600, 0.01, 5.0, 5.0), (-30, 0.5, 25.0, 25.0),
    (-30, -1.0, 5.0, 5.0), (600, None, 10.0, 10.0), (600, 1.0, None, -3.0), (0, None, 10.0, 10.0),
    (1.5, 0.1, 3.0, -1.0),
])
def test_rules_agree_with_reference_sql(spark, seconds, distance, fare, total):
    assert label(spark, trip_total(seconds, distance, fare, total)) == [_duck_label(seconds, distance, fare, total)]


def test_random_trips_agree_with_reference_sql(spark):
    """2,000 generated trips (boundary values, NULLs, zero and negative durations) labelled by Spark
    and by the reference-form CASE in DuckDB."""
    import random

    import duckdb
    import pandas as pd

    from cordon.plans.oracle import EPOCH

    rng = random.Random(7)
    secs = [0, 0.5, 59, 59.999, 60, 3600, -1, -30, 86400]
    dist = [0.0, 0.005, 0.01, 0.0101, 1.0, 65.0, -1.0, None]
    fares = [0.0, 0.01, 20.0, 20.01, -5.0, 100.0, None]
    rows = []
    for i in range(2000):
        s = rng.choice(secs) if rng.random() < 0.5 else round(rng.uniform(-100, 5000), 3)
        x = rng.choice(dist) if rng.random() < 0.5 else round(rng.uniform(-1, 80), 2)
        f = rng.choice(fares) if rng.random() < 0.5 else round(rng.uniform(-30, 120), 2)
        tot = None if rng.random() < 0.05 else (f if f is not None else 0.0) + rng.choice([0.0, -200.0, 3.5])
        rows.append((i, s, x, f, tot))
    spark_rows = [(T0, T0 + timedelta(seconds=s), 1, 2, x, f, tot, 2.5, "yellow") for _, s, x, f, tot in rows]
    spark_labels = [r.ghost_flag for r in flag_trips(spark.createDataFrame(spark_rows, SCHEMA), CFG)
                    .select("ghost_flag").collect()]

    pdf = pd.DataFrame(rows, columns=["i", "s", "trip_distance", "fare", "total_amount"])
    con = duckdb.connect()
    con.register("gen", pdf)
    duck = con.execute(f"""
      SELECT CASE
        WHEN trip_distance / ({EPOCH} / 3600.0) > {CFG.max_speed_mph} THEN 'excessive_speed'
        WHEN {EPOCH} < {CFG.short_trip_seconds} AND fare > {CFG.high_fare} THEN 'short_trip_high_fare'
        WHEN trip_distance <= {CFG.min_distance_miles} AND fare > 0 THEN 'zero_distance_positive_fare'
        WHEN {EPOCH} <= 0 THEN 'negative_duration'
        WHEN fare < 0 OR total_amount < 0 THEN 'negative_fare'
        ELSE 'clean' END
      FROM (SELECT i, TIMESTAMP '2000-03-01 12:00:00' AS pickup_time,
                   TIMESTAMP '2000-03-01 12:00:00' + to_microseconds(CAST(round(s * 1000000) AS BIGINT)) AS dropoff_time,
                   CAST(trip_distance AS DOUBLE) AS trip_distance, CAST(fare AS DOUBLE) AS fare,
                   CAST(total_amount AS DOUBLE) AS total_amount FROM gen) ORDER BY i""").fetchall()
    assert spark_labels == [r[0] for r in duck]
    assert len(set(spark_labels)) == 6
