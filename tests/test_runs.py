"""Concurrent runs, damaged files, observed counts, planned layout, hubs per run, streamed runs."""

import os
import tempfile
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cordon.config import FIXTURE_CONFIG as CFG
from cordon.operators import hubs, zones
from cordon.plans import audit, catalog
from cordon.sources import fixture, manifest, raw, sinks
from cordon.streaming import read_raw_stream, start_ingest
from test_ingest import MAPS, _write

ZONES = [(1, "NATION_2", "ASIA")]
ZONE_SCHEMA = "LocationID int, zone string, borough string"


@pytest.fixture
def place():
    root = tempfile.mkdtemp(prefix="cordon-runs-")
    for t in MAPS:
        os.makedirs(f"{root}/{t}")
    return root, {t: f"{root}/{t}" for t in MAPS}, audit.AuditTables(f"{root}/out")


def _count(spark, tables):
    return audit.read_labelled(spark, tables).count()


def _many(spark, folder, n_files, rows=3, day=datetime(2000, 2, 3, 8)):
    """One written file, copied under many names."""
    import shutil

    _write(spark, f"{folder}/first", rows, day=day)
    own = next(f"{folder}/first/{n}" for n in os.listdir(f"{folder}/first") if n.endswith(".parquet"))
    for i in range(n_files - 1):
        shutil.copy(own, f"{folder}/copy-{i:04d}.parquet")


# -- S6 ------------------------------------------------------------------------------------------

def test_two_increments_at_once_take_each_file_once(spark, place, monkeypatch):
    root, paths, tables = place
    _write(spark, paths["yellow"], 10)
    _write(spark, paths["green"], 20, taxi="green")
    both_wrote = threading.Barrier(2, timeout=300)
    publish, local = manifest.publish, threading.local()

    def after_both(*a, **k):
        if not getattr(local, "waited", False):  # both have listed and written the same files by then
            local.waited = True
            both_wrote.wait()
        return publish(*a, **k)

    monkeypatch.setattr(manifest, "publish", after_both)
    got, errors = [], []

    def run():
        try:
            got.append(audit.ingest(spark, paths, CFG, tables, full=False))
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=run) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sorted(x is None for x in got) == [False, True]
    assert _count(spark, tables) == 30
    assert manifest.last_version(spark, tables.manifest) == 1


def test_an_overtaken_increment_takes_what_is_left(spark, place, monkeypatch):
    root, paths, tables = place
    _write(spark, paths["yellow"], 10)
    publish, once = manifest.publish, []

    def overtaken(*a, **k):
        if not once:
            once.append(1)
            only_yellow = {"yellow": paths["yellow"]}
            assert audit.ingest(spark, only_yellow, CFG, tables, full=False) is not None
        return publish(*a, **k)

    _write(spark, paths["green"], 20, taxi="green")
    monkeypatch.setattr(manifest, "publish", overtaken)
    assert audit.ingest(spark, paths, CFG, tables, full=False) is not None
    assert _count(spark, tables) == 30
    per_file = manifest.file_report(manifest.read(spark, tables.manifest)).collect()
    assert [(r.taxi_type, r.rows_kept) for r in per_file] == [("green", 20), ("yellow", 10)]


def test_increments_of_different_files_both_publish(spark, place, monkeypatch):
    root, paths, tables = place
    _write(spark, paths["yellow"], 10)
    _write(spark, paths["green"], 20, taxi="green")
    publish, once = manifest.publish, []

    def overtaken(*a, **k):
        if not once:
            once.append(1)
            audit.ingest(spark, {"green": paths["green"]}, CFG, tables, full=False)
        return publish(*a, **k)

    monkeypatch.setattr(manifest, "publish", overtaken)
    audit.ingest(spark, {"yellow": paths["yellow"]}, CFG, tables, full=False)
    assert _count(spark, tables) == 30 and manifest.last_version(spark, tables.manifest) == 2


@pytest.mark.parametrize("local", [True, False])
def test_a_log_entry_is_made_once(spark, place, monkeypatch, local):
    root = place[0]
    if not local:  # the way of other stores, here on the local one
        monkeypatch.setattr(manifest, "_local", lambda *_: None)
    path = f"file://{root}/log/{1:020d}"
    wins, go = [], threading.Barrier(6)

    def run(i):
        go.wait()
        if manifest.create_once(spark, path, f"run {i}"):
            wins.append(i)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(6 if local else 1)]
    if not local:
        go = threading.Barrier(1)
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(wins) == 1
    assert not manifest.create_once(spark, path, "late")
    with open(f"{root}/log/{1:020d}") as f:
        assert f.read() == f"run {wins[0]}"
    assert [n for n in os.listdir(f"{root}/log") if not n.startswith(".")] == [f"{1:020d}"]


def test_unprocessed_months(spark):
    from cordon.sources import inventory

    counts = spark.createDataFrame([("yellow", "a", 2000, 1, 5, True), ("yellow", "b", 2000, 1, 6, True), ("yellow", "c", 2000, 2, 0, False),
                                    ("green", "d", 2000, 1, 7, True)],
                                   "taxi_type string, source_file string, year int, month int, row_count long, is_valid boolean")
    done = spark.createDataFrame([("green", 2000, 1), ("green", 2000, 1)], "taxi_type string, year int, month int")
    assert [tuple(r) for r in inventory.unprocessed_months(counts, done).collect()] == [("yellow", 2000, 1, 2, 11)]


# -- S3 ------------------------------------------------------------------------------------------

class _Jobs:
    """Jobs started inside the block."""

    def __init__(self, spark):
        self.sc, self.group = spark.sparkContext, f"g{id(self)}"

    def __enter__(self):
        self.sc.setJobGroup(self.group, "counted")
        return self

    def __exit__(self, *_):
        self.n = len(self.sc.statusTracker().getJobIdsForGroup(self.group))
        self.sc.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_of_validation_do_not_grow_with_the_files(spark, place):
    root, paths, tables = place
    _many(spark, paths["yellow"], 40)  # beyond 32 paths Spark lists them in a job of its own
    jobs = []
    for n_bad in (34, 80):
        for i in range(n_bad):
            with open(f"{paths['yellow']}/bad-{n_bad}-{i}.parquet", "wb") as f:
                f.write(b"PAR1 this is no parquet file PAR1")
        files = manifest.list_files(spark, {"yellow": paths["yellow"]}).collect()
        with _Jobs(spark) as counted:
            rows, bad = raw.file_states(spark, files)
        jobs.append(counted.n)
        assert len(rows) == 40 and set(rows.values()) == {3}
        assert len(bad) == len(files) - 40 and all("bad" in p and r for p, r in bad.items())
    assert jobs[0] == jobs[1], jobs


def test_damaged_pages_are_found_and_the_rest_goes_on(spark, place):
    root, paths, tables = place
    _many(spark, paths["yellow"], 10, rows=2000)
    with open(f"{paths['yellow']}/copy-0003.parquet", "r+b") as f:  # pages destroyed, footer sound
        f.seek(4)
        f.write(b"\xff" * 300)
    audit.ingest(spark, paths, CFG, tables)
    assert _count(spark, tables) == 9 * 2000
    report = {os.path.basename(r.file_path): r for r in manifest.file_report(manifest.read(spark, tables.manifest)).collect()}
    assert [n for n, r in report.items() if not r.is_valid] == ["copy-0003.parquet"]
    assert "of 2000 rows can be read" in report["copy-0003.parquet"].reason


# -- S14 -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("layout", ["keep", "rebalance"])
def test_rows_by_file_are_observed_while_writing(spark, place, monkeypatch, layout):
    root, paths, tables = place
    for i in range(7):
        _write(spark, paths["yellow"], 3 + i, day=datetime(2000, 1 + i, 3, 8), types={"fare": "double"})
    _write(spark, paths["green"], 11, taxi="green")
    opened = []
    read_runs = audit.read_runs
    monkeypatch.setattr(audit, "read_runs", lambda *a: opened.append(a) or read_runs(*a))
    audit.ingest(spark, paths, CFG, tables, layout=layout)
    assert not opened  # the written table is not read
    rows = manifest.read(spark, tables.manifest).collect()
    want = {(r.taxi_type, r.source_file): r.n for r in read_runs(spark, tables, [rows[0].run_id]).groupBy("taxi_type", "source_file")
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {(r.taxi_type, os.path.basename(r.file_path)): r.rows_kept for r in rows} == want
    assert sum(r.rows_clean for r in rows) == audit.read_clean(spark, tables).count()
    assert all(r.rows_read == r.rows_kept for r in rows)


def test_counts_by_mark_are_exact_for_many_files(spark):
    n = 3000
    rows = spark.range(0, 200_000, numPartitions=16).select(
        F.concat(F.lit("store://x/"), (F.col("id") * F.col("id") % n).cast("string")).alias("p"))
    paths = [r.p for r in rows.select("p").distinct().collect()]
    seed, marks = audit.file_marks(spark, paths)
    h = rows.agg(sinks.count_by_file(sinks.file_mark(F.col("p"), seed), len(paths)).alias("h")).collect()[0].h
    assert sinks.counts_of(h, marks) == {r.p: r.n for r in rows.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}


# -- S7 ------------------------------------------------------------------------------------------

def _files(tables, run_id):
    out = {}
    for folder, _, names in os.walk(tables.run(run_id)):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(folder[len(tables.run(run_id)):], []).append(os.path.getsize(f"{folder}/{n}"))
    return out


def test_rebalanced_months_have_one_file_each(spark, place):
    root, paths, tables = place
    for i in range(6):  # six files of the same two months
        _write(spark, paths["yellow"], 5, day=datetime(2000, 1 + i % 2, 3, 8))
    run_id = audit.ingest(spark, paths, CFG, tables)
    assert {k: len(v) for k, v in _files(tables, run_id).items()} == {"/split=clean/year=2000/month=1": 1, "/split=clean/year=2000/month=2": 1}


def test_compaction_plans_files_from_counts(spark, sf_small, place):
    root, paths, tables = place
    for t in CFG.taxi_types:
        fixture.raw_trips(spark, sf_small, t).drop("source_file").repartition(5).write.mode("append").parquet(paths[t])
    audit.ingest(spark, paths, CFG, tables, full=False, layout="keep")
    _write(spark, paths["yellow"], 4000, day=datetime(2000, 2, 3, 8))
    audit.ingest(spark, paths, CFG, tables, full=False)
    before = sorted(map(str, audit.read_labelled(spark, tables).drop("run_id").collect()))
    report = sorted(map(str, manifest.file_report(manifest.read(spark, tables.manifest)).drop("run_id").collect()))
    many = sum(map(len, (v for r in manifest.published_runs(manifest.read(spark, tables.manifest)) for v in _files(tables, r).values())))
    run_id = audit.compact(spark, tables, target_bytes=8 << 10)
    files = _files(tables, run_id)
    assert sum(map(len, files.values())) < many
    assert len(files["/split=clean/year=2000/month=2"]) > 1  # the large month
    assert all(len(v) == 1 for k, v in files.items() if sum(v) < 6 << 10)
    assert before == sorted(map(str, audit.read_labelled(spark, tables).drop("run_id").collect()))
    assert report == sorted(map(str, manifest.file_report(manifest.read(spark, tables.manifest)).drop("run_id").collect()))
    assert audit.ingest(spark, paths, CFG, tables, full=False) is None  # the files are still known
    gone = audit.vacuum(spark, tables, older_than_seconds=0)
    assert len(gone) == 4 and os.listdir(tables.trips) == [f"run_id={run_id}"]
    assert before == sorted(map(str, audit.read_labelled(spark, tables).drop("run_id").collect()))


def test_a_compaction_that_was_overtaken_replaces_nothing(spark, place, monkeypatch):
    root, paths, tables = place
    _write(spark, paths["yellow"], 5)
    audit.ingest(spark, paths, CFG, tables)
    publish, once = manifest.publish, []

    def overtaken(*a, **k):
        if not once:
            once.append(1)
            _write(spark, paths["yellow"], 6)
            audit.ingest(spark, paths, CFG, tables, full=False)
        return publish(*a, **k)

    monkeypatch.setattr(manifest, "publish", overtaken)
    with pytest.raises(manifest.Conflict):
        audit.compact(spark, tables)
    assert _count(spark, tables) == 11


# -- hubs ----------------------------------------------------------------------------------------

def _rows(df):
    def value(x):
        return round(x, 6) if isinstance(x, float) else x

    return sorted(str(tuple(value(x) for x in r)) for r in df.collect())


def test_hubs_of_one_pass_equal_each_grain_alone(spark, sf_small):
    plan = hubs.trip_hubs(catalog.labelled(spark, sf_small), CFG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1  # one scan for all of them
    labelled = catalog.labelled(spark, sf_small).cache()
    every = hubs.trip_hubs(labelled, CFG).cache()
    for g in hubs.GRAINS:
        assert _rows(hubs.merged(every, g)) == _rows(hubs.trip_hub(labelled, g, CFG)), g
    labelled.unpersist()
    every.unpersist()


def test_hubs_add_up_over_runs_and_results_read_no_trip(spark, sf_small, place, monkeypatch):
    root, paths, tables = place
    zone_table, weather = fixture.zones(spark, sf_small), fixture.weather(spark, sf_small)
    raws = {t: fixture.raw_trips(spark, sf_small, t).drop("source_file") for t in CFG.taxi_types}
    for part in range(3):
        for t, r in raws.items():
            r.filter(F.pmod(F.xxhash64(*r.columns), F.lit(3)) == part).repartition(2).write.mode("append").parquet(paths[t])
        read = []
        read_runs = audit.read_runs
        monkeypatch.setattr(audit, "read_runs", lambda s, tb, ids: read.extend(ids) or read_runs(s, tb, ids))
        run_id = audit.ingest(spark, paths, CFG, tables, full=False)
        ids = audit.write_zone_daily(spark, zone_table, CFG, tables)
        assert read == [run_id]  # an increment reads its own trips only
        monkeypatch.undo()
    out = audit.results(spark, tables, zone_table, weather, CFG, zone_ids=ids)
    for name in ("zone_summary", "zone_hourly", "zone_dow", "ghost_by_hour_dow", "ghost_by_location", "quarter_stats", "impute_month",
                 "month_profile", "market_share_shift", "ghost_totals", "kpi_overview", "top_leakage_pickups", "weather_correlation"):
        plan = out[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "split" not in plan, name
        assert _rows(out[name]) == _rows(catalog.QUERIES[name](spark, sf_small)), name


def test_another_zone_table_makes_its_own_hubs(spark, sf_small, place):
    root, paths, tables = place
    for t in CFG.taxi_types:
        fixture.raw_trips(spark, sf_small, t).drop("source_file").repartition(2).write.mode("append").parquet(paths[t])
    first = fixture.zones(spark, sf_small)
    other = spark.createDataFrame([(3, "NATION_2", "ASIA"), (5, "NATION_7", "ASIA")], ZONE_SCHEMA)
    audit.ingest(spark, paths, CFG, tables)
    audit.write_zone_daily(spark, first, CFG, tables)
    old = _rows(audit.read_zone_daily(spark, tables))
    audit.write_zone_daily(spark, other, CFG, tables)  # the rollup phase alone, with another zone table
    fresh = audit.AuditTables(f"{root}/fresh")
    audit.ingest(spark, paths, CFG, fresh)
    audit.write_zone_daily(spark, other, CFG, fresh)
    assert _rows(audit.read_zone_daily(spark, tables)) == _rows(audit.read_zone_daily(spark, fresh)) != old
    audit.write_zone_daily(spark, first, CFG, tables)
    assert _rows(audit.read_zone_daily(spark, tables)) == old


def test_modes_take_the_smallest_of_several(spark):
    rows = [("a", 5, "clean", 3), ("a", 5, "clean", 1), ("a", 2, "clean", 4), ("a", 9, "negative_fare", 90), ("b", 7, "clean", 1)]
    hub = spark.createDataFrame(rows, "taxi_type string, pickup_loc int, ghost_flag string, trip_count long")
    assert sorted(map(tuple, hubs.modes(hub, "pickup_loc", "taxi_type").collect())) == [("a", 2), ("b", 7)]


def test_dropped_column_is_reported(spark, place):
    root, paths, tables = place
    _write(spark, paths["yellow"], 5)
    audit.ingest(spark, paths, CFG, tables, full=False)
    _write(spark, paths["yellow"], 6, drop=("congestion_surcharge",))
    audit.ingest(spark, paths, CFG, tables, full=False)
    zone_table = spark.createDataFrame(ZONES, ZONE_SCHEMA)
    ids = audit.write_zone_daily(spark, zone_table, CFG, tables)
    drift = audit.results(spark, tables, zone_table, None, CFG, zone_ids=ids)["value_drift"].filter("dropped").collect()
    assert [(r.column_name, r.row_count, r.n_values) for r in drift] == [("congestion_surcharge", 6, 0)]


# -- streamed runs ---------------------------------------------------------------------------------

def _stream(spark, root, paths, tables, checkpoint="ckpt"):
    streams = {t: read_raw_stream(spark, p, t, max_files_per_trigger=2) for t, p in paths.items()}
    start_ingest(streams, CFG, tables, f"{root}/{checkpoint}", available_now=True).awaitTermination(600)


def test_stream_and_batch_share_the_manifest(spark, place):
    root, paths, tables = place
    for i in range(3):
        _write(spark, paths["yellow"], 4 + i, day=datetime(2000, 1 + i, 3, 8))
    _write(spark, paths["green"], 9, taxi="green")
    _stream(spark, root, paths, tables)
    assert _count(spark, tables) == 4 + 5 + 6 + 9
    assert audit.ingest(spark, paths, CFG, tables, full=False) is None  # batch after stream takes nothing twice
    _write(spark, paths["yellow"], 7)
    audit.ingest(spark, paths, CFG, tables, full=False)
    _write(spark, paths["green"], 8, taxi="green")
    _stream(spark, root, paths, tables)  # stream after batch: only the file that the batch has not taken
    assert _count(spark, tables) == 24 + 7 + 8
    _stream(spark, root, paths, tables, "another-checkpoint")  # sees all files again
    assert _count(spark, tables) == 24 + 7 + 8
    rows = manifest.read(spark, tables.manifest).collect()
    assert all(r.rows_kept == r.rows_read > 0 for r in rows) and len(rows) == 6


def test_a_replayed_batch_publishes_nothing_twice(spark, place):
    from cordon.operators import unify
    from cordon.streaming.trips import take_batch

    root, paths, tables = place
    _write(spark, paths["yellow"], 5)
    files = {r.file_path: r for r in manifest.list_files(spark, {"yellow": paths["yellow"]}).collect()}
    own = raw.read_trip_files(spark, paths["yellow"], "yellow")
    f = next(iter(files.values()))
    batch = unify.unify(own.withColumns({"file_size": F.lit(f.file_size), "modified": F.lit(f.modified)}), MAPS["yellow"], "yellow")
    for _ in range(2):
        assert take_batch(batch, "sq-000000000000", CFG, tables) == "sq-000000000000"
    assert take_batch(batch, "sq-000000000001", CFG, tables) is None
    assert _count(spark, tables) == 5 and manifest.last_version(spark, tables.manifest) == 1


def test_weighted_mean_fare_is_the_mean_over_trips_with_a_fare(spark, place):
    from cordon.operators import kpi

    day = datetime(2002, 1, 1)
    rows = [(day, "inside_zone", 1, 1, 10.0), (day, "inside_zone", 1, 1, None), (day, "inside_zone", 1, 1, None), (day, "outside_zone", 1, 1, 40.0)]
    df = spark.createDataFrame(rows, "pickup_time timestamp_ntz, zone_category string, after_congestion_start int, n int, fare double") \
        .withColumns({c: F.lit(1.0) for c in ("total_amount", "trip_distance", "congestion_surcharge")})
    for rollup in (zones.zone_daily(df), zones.zone_daily_from_partials(zones.zone_daily_partials(df))):
        assert kpi.kpi_overview(rollup, CFG).collect()[0].avg_fare_weighted == 25.0
