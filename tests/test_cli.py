"""Command-line runs on trip files: a full run, and file-level increments as files arrive."""

import tempfile

from pyspark.sql import functions as F

from cordon.__main__ import parse, run
from cordon.config import FIXTURE_CONFIG as CFG
from cordon.plans import audit, catalog
from cordon.sources import fixture


def _stage(spark, sf_small, root):
    fixture.zones(spark, sf_small).write.option("header", "true").csv(f"{root}/zones")
    fixture.weather(spark, sf_small).write.parquet(f"{root}/weather")
    return ["--yellow", f"{root}/raw/yellow", "--green", f"{root}/raw/green", "--zones", f"{root}/zones",
            "--zones-format", "csv", "--weather", f"{root}/weather", "--out", f"{root}/out"]


def _raw(spark, sf_small, t):
    # Real trip files carry no lineage column: the file name is the lineage.
    return fixture.raw_trips(spark, sf_small, t).drop("source_file")


def test_cli_full_run(spark, sf_small):
    root = tempfile.mkdtemp(prefix="cordon-cli-")
    for t in CFG.taxi_types:
        _raw(spark, sf_small, t).write.parquet(f"{root}/raw/{t}")
    tables = run(spark, parse(_stage(spark, sf_small, root)), CFG)
    assert audit.read_labelled(spark, tables).count() == catalog.flagged(spark, sf_small).count()
    import os

    own = {"file_report"}  # of the run itself
    queries = set(catalog.QUERIES) - {"unify_yellow", "unify_green", "unify_all", "unify_tagged", "ghost_flags", "clean_trips",
                                      "ghost_trips", "classify_trips", "zone_daily", "zone_daily_merged", "raw_schema_check",
                                      "file_inventory", "zone_daily_from_days"}  # trip tables, and checks of raw tables
    queries = {q for q in queries if not q.endswith("_merged")}  # the same results by another way
    assert set(os.listdir(f"{root}/out/results")) == queries | own
    for name, keys in (("top_pickups_entering", ["-trip_count", "pickup_loc"]), ("file_report", ["taxi_type", "file_path"]),
                       ("ghost_patterns", ["-trip_count", "ghost_flag"]), ("missing_months", ["taxi_type", "year", "month"])):
        rows = spark.read.parquet(tables.result(name)).collect()  # one file, read in its order
        want = sorted(rows, key=lambda r: tuple(-r[k[1:]] if k[0] == "-" else r[k] for k in keys))
        assert rows == want and len(rows) > 1, name
    for name in ("leakage_summary", "zone_hourly", "ghost_by_location", "quarter_comparison", "impute_month", "schema_check",
                 "ghost_totals", "top_pickups_entering"):
        a = sorted(map(str, spark.read.parquet(tables.result(name)).collect()))
        assert a == sorted(map(str, catalog.QUERIES[name](spark, sf_small).collect())), name


def test_cli_incremental_reads_only_new_files(spark, sf_small):
    root = tempfile.mkdtemp(prefix="cordon-inc-")
    argv = _stage(spark, sf_small, root) + ["--phase", "trips", "--incremental"]
    for t in CFG.taxi_types:
        r = _raw(spark, sf_small, t)
        pick = [c for c in r.columns if c.endswith("pickup_datetime")][0]
        r.filter(F.year(pick) < 1999).repartition(3).write.parquet(f"{root}/raw/{t}")
    tables = run(spark, parse(argv), CFG)
    first = audit.read_labelled(spark, tables).count()
    total = catalog.flagged(spark, sf_small).count()
    assert 0 < first < total

    for t in CFG.taxi_types:  # a second drop of files lands next to the first
        r = _raw(spark, sf_small, t)
        pick = [c for c in r.columns if c.endswith("pickup_datetime")][0]
        r.filter(F.year(pick) >= 1999).repartition(2).write.mode("append").parquet(f"{root}/raw/{t}")
    run(spark, parse(argv), CFG)
    assert audit.read_labelled(spark, tables).count() == total
    run(spark, parse(argv), CFG)  # nothing new: no change
    assert audit.read_labelled(spark, tables).count() == total
    files = audit.read_labelled(spark, tables).select("source_file").distinct().count()
    assert files == 2 * (3 + 2)


def test_a_complete_month_is_not_imputed(spark, sf_small):
    from dataclasses import replace

    root = tempfile.mkdtemp(prefix="cordon-month-")
    for t in CFG.taxi_types:
        _raw(spark, sf_small, t).write.parquet(f"{root}/raw/{t}")
    cfg = replace(CFG, impute_year=2000, impute_month=3)
    argv = _stage(spark, sf_small, root)
    for t in CFG.taxi_types:  # files named by month, one of them the month in question
        d = f"{root}/raw/{t}"
        first = sorted(n for n in __import__("os").listdir(d) if n.endswith(".parquet"))[0]
        __import__("shutil").copy(f"{d}/{first}", f"{d}/{t}_tripdata_2000-03.parquet")
    tables = run(spark, parse(argv), cfg)
    import os

    assert not any(n.startswith(("impute_month", "impute_total", "month_profile")) for n in os.listdir(f"{root}/out/results"))
    assert not spark.read.parquet(tables.result("impute_needed")).collect()[0].needs_imputation
