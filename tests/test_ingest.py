"""Ingest runs: nothing lost, nothing twice, every listed file reported."""

import os
import tempfile
from datetime import datetime

import pytest

from cordon.config import FIXTURE_CONFIG as CFG, GREEN_COLUMN_MAP, YELLOW_COLUMN_MAP
from cordon.plans import audit
from cordon.sources import manifest, raw

MAPS = {"yellow": YELLOW_COLUMN_MAP, "green": GREEN_COLUMN_MAP}


def _write(spark, path, n, taxi="yellow", day=datetime(2000, 2, 3, 8), types=None, drop=(), extra=None, upper=False):
    kinds = {"pickup_loc": "long", "dropoff_loc": "long", "pickup_time": "timestamp_ntz", "dropoff_time": "timestamp_ntz"}
    kinds.update(types or {})
    values = {"pickup_time": day, "dropoff_time": day.replace(minute=30), "pickup_loc": 1, "dropoff_loc": 2, "trip_distance": 3.0,
              "fare": 10.0, "total_amount": 12.0, "congestion_surcharge": 2.5}
    cols = [(c, u) for c, u in MAPS[taxi].items() if u not in drop]
    row = tuple(int(values[u]) if "int" in kinds.get(u, "") or kinds.get(u) == "long" else values[u] for _, u in cols)
    schema = ", ".join(f"{c.upper() if upper else c} {kinds.get(u, 'double')}" for c, u in cols)
    df = spark.createDataFrame([row] * n, schema).coalesce(1)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({k: F.lit(v) for k, v in extra.items()})
    df.write.mode("append").parquet(path)


@pytest.fixture
def place():
    root = tempfile.mkdtemp(prefix="cordon-ingest-")
    for t in MAPS:
        os.makedirs(f"{root}/{t}")
    return root, {t: f"{root}/{t}" for t in MAPS}, audit.AuditTables(f"{root}/out")


def _count(spark, tables):
    return audit.read_labelled(spark, tables).count()


def test_a_stray_trip_of_another_month_replaces_nothing(spark, place):
    root, paths, tables = place
    _write(spark, paths["yellow"], 1000, day=datetime(2000, 1, 31, 8))
    audit.ingest(spark, paths, CFG, tables)
    _write(spark, paths["yellow"], 1, day=datetime(2000, 1, 31, 9))
    _write(spark, paths["yellow"], 10, day=datetime(2000, 2, 1, 9))
    audit.ingest(spark, paths, CFG, tables, full=False)
    assert _count(spark, tables) == 1011
    assert audit.ingest(spark, paths, CFG, tables, full=False) is None  # nothing new
    assert _count(spark, tables) == 1011


def test_read_error_of_the_manifest_is_an_error(spark, place, monkeypatch):
    root, paths, tables = place
    _write(spark, paths["yellow"], 30)
    audit.ingest(spark, paths, CFG, tables)

    def broken(*_):
        raise OSError("store not reachable")

    monkeypatch.setattr(manifest, "exists", broken)
    with pytest.raises(OSError):
        audit.ingest(spark, paths, CFG, tables, full=False)
    monkeypatch.undo()
    assert _count(spark, tables) == 30


def test_carried_lineage_column_and_equal_names(spark, place):
    root, paths, tables = place
    for part in ("year=2000/a", "year=2001/a"):
        _write(spark, f"{paths['yellow']}/{part}", 5, extra={"source_file": "other.parquet", "file_path": "x"})
    for folder, _, names in list(os.walk(paths["yellow"])):
        for n in names:
            if n.endswith(".crc"):
                os.unlink(f"{folder}/{n}")
        for n in names:
            if n.endswith(".parquet"):
                os.rename(f"{folder}/{n}", f"{folder}/same.parquet")
    audit.ingest(spark, paths, CFG, tables)
    assert _count(spark, tables) == 10
    assert audit.ingest(spark, paths, CFG, tables, full=False) is None
    assert {r.source_file for r in audit.read_labelled(spark, tables).select("source_file").collect()} == {"same.parquet"}


def test_every_listed_file_is_reported(spark, place):
    root, paths, tables = place
    _write(spark, paths["yellow"], 4)
    _write(spark, f"{paths['yellow']}/none", 0)
    _write(spark, f"{paths['green']}/lacking", 6, taxi="green", drop=("pickup_loc",))
    _write(spark, f"{paths['green']}/optional", 7, taxi="green", drop=("congestion_surcharge",))
    with open(f"{paths['yellow']}/bad.parquet", "wb") as f:
        f.write(b"PAR1 this is no parquet file PAR1")
    audit.ingest(spark, paths, CFG, tables)
    report = {("lacking" in r.file_path and "lacking") or ("optional" in r.file_path and "optional") or ("none" in r.file_path and "none")
              or ("bad" in r.file_path and "bad") or "good": r
              for r in manifest.file_report(manifest.read(spark, tables.manifest)).collect()}
    assert {k: r.is_valid for k, r in report.items()} == {"good": True, "optional": True, "lacking": False, "none": False, "bad": False}
    assert report["none"].reason == "empty" and "required" in report["lacking"].reason and report["bad"].reason
    assert (report["good"].rows_kept, report["optional"].rows_kept, report["lacking"].rows_read) == (4, 7, 6)
    labelled = audit.read_labelled(spark, tables)
    assert labelled.count() == 11
    assert labelled.filter("congestion_surcharge IS NULL").count() == 7
    assert audit.ingest(spark, paths, CFG, tables, full=False) is None  # files without rows are known too


def test_types_drift_between_files(spark, place):
    root, paths, tables = place
    _write(spark, paths["yellow"], 3, types={"pickup_loc": "int", "dropoff_loc": "int", "fare": "float"})
    _write(spark, paths["yellow"], 4, types={"pickup_loc": "long", "dropoff_loc": "int"})
    _write(spark, paths["yellow"], 5, upper=True, drop=("congestion_surcharge",))
    audit.ingest(spark, paths, CFG, tables)
    rows = audit.read_labelled(spark, tables)
    assert rows.count() == 12 and rows.filter("congestion_surcharge = 2.5").count() == 7


def test_a_run_that_was_not_published_is_not_read(spark, place, monkeypatch):
    root, paths, tables = place
    _write(spark, paths["yellow"], 9)
    publish = manifest.publish

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(manifest, "publish", killed)
    with pytest.raises(KeyboardInterrupt):
        audit.ingest(spark, paths, CFG, tables, full=False)
    monkeypatch.setattr(manifest, "publish", publish)
    with pytest.raises(ValueError):
        audit.read_labelled(spark, tables)
    audit.ingest(spark, paths, CFG, tables, full=False)
    assert _count(spark, tables) == 9


def test_changed_file_needs_a_full_run(spark, place):
    root, paths, tables = place
    _write(spark, paths["yellow"], 9)
    audit.ingest(spark, paths, CFG, tables)
    name = next(n for n in os.listdir(paths["yellow"]) if n.endswith(".parquet"))
    os.utime(f"{paths['yellow']}/{name}", (1, 1))
    with pytest.raises(ValueError, match="changed"):
        audit.ingest(spark, paths, CFG, tables, full=False)
    audit.ingest(spark, paths, CFG, tables, full=True)
    assert _count(spark, tables) == 9


def test_increments_add_up_to_a_full_run(spark, place):
    root, paths, tables = place
    zones = spark.createDataFrame([(1, "NATION_2", "ASIA")], "LocationID int, zone string, borough string")
    for k, day in enumerate((datetime(2001, 2, 1, 8), datetime(2098, 1, 1, 8), datetime(2001, 1, 1, 8))):
        _write(spark, paths["yellow"], 5 + k, day=day)
        audit.ingest(spark, paths, CFG, tables, full=False, month_salt=2 if k else None)
        audit.write_zone_daily(spark, zones, CFG, tables)
    whole = audit.AuditTables(f"{root}/whole")
    audit.ingest(spark, paths, CFG, whole)
    audit.write_zone_daily(spark, zones, CFG, whole)
    rows = [sorted(map(tuple, audit.read_zone_daily(spark, t).collect())) for t in (tables, whole)]
    assert rows[0] == rows[1] and len(rows[0]) == 3


def test_empty_zone_set_is_refused(spark, place):
    root, paths, tables = place
    _write(spark, paths["yellow"], 2)
    audit.ingest(spark, paths, CFG, tables)
    with pytest.raises(ValueError, match="zone"):
        audit.write_zone_daily(spark, spark.createDataFrame([(1, "x", "y")], "LocationID int, zone string, borough string"), CFG, tables)


def test_row_counts_read_no_column(spark, place):
    root, paths, tables = place
    _write(spark, paths["yellow"], 2)
    plan = raw.row_counts(spark, [paths["yellow"]])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
