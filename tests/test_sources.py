"""Unification from two raw schemas, zone selection, inventory, schema check and sinks."""

import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from cordon.config import FIXTURE_CONFIG as CFG, GREEN_COLUMN_MAP, UNIFIED_COLUMNS, YELLOW_COLUMN_MAP
from cordon.operators import unify, zones
from cordon.operators.joins import bounded_broadcast, row_count_at_most
from cordon.plans import audit
from cordon.sources import fixture, inventory, raw, schema


def _raw(spark, cmap, rows):
    types = ["timestamp_ntz", "timestamp_ntz", "long", "long", "double", "double", "double", "double"]
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(cmap, types)))


def test_unify_yellow_and_green_names(spark):
    t = datetime(2000, 1, 2, 3, 4, 5)
    y = _raw(spark, YELLOW_COLUMN_MAP, [(t, t, 1, 2, 1.5, 10.0, 12.0, 2.5)])
    g = _raw(spark, GREEN_COLUMN_MAP, [(t, t, 3, 4, 2.5, 20.0, 22.0, None)])
    u = unify.unify_all({"yellow": y, "green": g})
    assert u.columns[:8] == list(UNIFIED_COLUMNS)
    got = {r.taxi_type: r for r in u.collect()}
    assert got["yellow"].pickup_loc == 1 and got["green"].fare == 20.0 and got["green"].congestion_surcharge is None
    assert dict((f.name, f.dataType.simpleString()) for f in u.schema.fields)["pickup_time"] == "timestamp_ntz"


def test_unify_drops_incomplete_rows_and_nulls_unmapped(spark):
    t = datetime(2000, 1, 2)
    cmap = dict(YELLOW_COLUMN_MAP)
    del cmap["congestion_surcharge"]
    schema_ = T.StructType([T.StructField(c, T.TimestampNTZType() if "datetime" in c else T.DoubleType()
                                          if c not in ("PULocationID", "DOLocationID") else T.LongType())
                            for c in cmap])
    rows = [(t, t, 1, 2, 1.0, 5.0, 6.0), (None, t, 1, 2, 1.0, 5.0, 6.0), (t, t, None, 2, 1.0, 5.0, 6.0)]
    u = unify.unify(spark.createDataFrame(rows, schema_), cmap, "yellow")
    out = u.collect()
    assert len(out) == 1 and out[0].congestion_surcharge is None


def test_zone_keywords_are_case_insensitive_and_null_safe(spark):
    z = spark.createDataFrame(
        [(1, "Lower East Side", "Manhattan"), (2, "midtown center", "Manhattan"), (3, None, "Manhattan"),
         (4, "Midtown", "Queens"), (5, "Upper West Side", "Manhattan"), (5, "Upper West Side", "Manhattan")],
        "LocationID int, zone string, borough string")
    from cordon.config import DEFAULT_CONFIG

    ids = sorted(r.LocationID for r in zones.congestion_zones(z, DEFAULT_CONFIG).collect())
    assert ids == [1, 2]


def test_classify_with_duplicate_zone_rows(spark):
    trips = spark.createDataFrame(
        [(datetime(2001, 2, 1), 1, 2), (datetime(2000, 2, 1), 2, 1), (datetime(2001, 2, 1), 1, 1),
         (datetime(2001, 2, 1), 3, 3)], "pickup_time timestamp_ntz, pickup_loc int, dropoff_loc int")
    ids = spark.createDataFrame([(1,), (1,)], "LocationID int")
    out = zones.classify(trips, zones.zone_id_set(ids, CFG), CFG).collect()
    assert len(out) == 4
    assert [(r.zone_category, r.after_congestion_start) for r in out] == [
        ("exiting_zone", 1), ("entering_zone", 0), ("inside_zone", 1), ("outside_zone", 1)]


def test_bounded_broadcast_falls_back(spark):
    small = spark.range(5)
    assert row_count_at_most(small, 5) and not row_count_at_most(small, 4)
    hinted = bounded_broadcast(small, 10)
    plan = spark.range(100).join(hinted, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
    unhinted = bounded_broadcast(spark.range(50), 10)
    plan = spark.range(100).join(unhinted, "id")._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in plan
    hinted = spark.range(100).join(bounded_broadcast(spark.range(10), 10), "id")._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" in hinted


def test_inventory_finds_the_missing_month(spark, sf_small):
    counts = inventory.source_row_counts({t: fixture.raw_trips(spark, sf_small, t) for t in CFG.taxi_types})
    missing = {(r.taxi_type, r.year, r.month) for r in inventory.missing_months(spark, counts, CFG).collect()}
    assert ("yellow", 2001, 12) in missing and ("green", 2001, 12) in missing
    need = inventory.impute_needed(counts, CFG).collect()[0]
    assert need.needs_imputation and not need.month_complete


def test_schema_check_reports_types_and_nulls(spark):
    t = datetime(2000, 1, 1)
    df = spark.createDataFrame([(t, t, 1, 2, 1.0, None)], "pickup_time timestamp_ntz, dropoff_time timestamp_ntz, "
                               "pickup_loc int, dropoff_loc long, trip_distance double, fare double")
    rows = {r.column_name: r for r in schema.schema_check(df).collect()}
    assert rows["pickup_loc"].type_ok and not rows["dropoff_loc"].type_ok
    assert rows["fare"].non_null_count == 0 and rows["fare"].row_count == 1
    assert not rows["congestion_surcharge"].is_present


def test_raw_schema_check_sees_types_and_missing_columns(spark):
    t = datetime(2000, 1, 1)
    df = spark.createDataFrame([(t, "x", 1, None)], "TPEP_pickup_datetime timestamp_ntz, tpep_dropoff_datetime string, "
                               "PULocationID int, fare_amount double")
    rows = {r.column_name: r for r in schema.raw_schema_check({"yellow": df}).collect()}
    assert rows["tpep_pickup_datetime"].type_ok and rows["tpep_pickup_datetime"].is_present
    assert rows["tpep_dropoff_datetime"].is_present and not rows["tpep_dropoff_datetime"].type_ok
    assert not rows["congestion_surcharge"].is_present and rows["congestion_surcharge"].actual_type is None
    assert rows["fare_amount"].non_null_count == 0 and rows["fare_amount"].row_count == 1


def test_raw_reader_lineage(spark):
    d = tempfile.mkdtemp(prefix="cordon-raw-")
    t = datetime(2000, 1, 1)
    _raw(spark, YELLOW_COLUMN_MAP, [(t, t, 1, 2, 1.0, 2.0, 3.0, 2.5)]).write.parquet(f"{d}/y")
    r = raw.read_trip_files(spark, f"{d}/y", "yellow")
    assert r.select("source_file").collect()[0][0].endswith(".parquet")
    assert unify.unify(r, YELLOW_COLUMN_MAP, "yellow").select("source_file").count() == 1


@pytest.mark.parametrize("keep_unified", [False, True])
def test_full_audit_run_matches_direct_queries(spark, sf_small, keep_unified):
    root = tempfile.mkdtemp(prefix="cordon-audit-")
    rb = {t: fixture.raw_trips(spark, sf_small, t) for t in CFG.taxi_types}
    tables = audit.run_audit(spark, rb, fixture.zones(spark, sf_small), fixture.weather(spark, sf_small), root, CFG,
                             keep_unified=keep_unified)
    from cordon.plans import catalog

    for name in ("leakage_summary", "kpi_overview", "quarter_comparison", "impute_month", "top_pickups_entering",
                 "daily_leakage", "weather_correlation"):
        a = sorted(map(tuple, spark.read.parquet(tables.result(name)).collect()))
        b = sorted(map(tuple, catalog.QUERIES[name](spark, sf_small).collect()))
        assert a == b, name


def test_weather_reader_takes_time_as_date(spark):
    d = tempfile.mkdtemp(prefix="cordon-weather-")
    spark.createDataFrame([("2001-01-05", 3.2, 1.5)], "time string, prcp double, tavg double") \
        .write.option("header", "true").csv(f"{d}/w")
    w = raw.read_weather(spark, f"{d}/w", "csv")
    r = w.collect()[0]
    assert "date" in w.columns and str(r.date) == "2001-01-05" and r.prcp == 3.2
