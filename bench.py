"""Benchmark of the audit on the driver tables.

Untimed setup: the driver tables are projected once into raw per-type trip files (the shape of the
downloaded monthly files) and the whole audit is run once on the sf0.001 tables to warm the JVM
(class loading, JIT, codec libraries). Timed: the ingest (listing, unification and anomaly split in one
job, manifest); all hubs, which hold the split statistics, in one pass; the zone rollup; opening the written
tables; and the queries read from them. Prints one JSON line, with rows a second of ingest + split statistics, the written files, and the
task seconds of the ingest by Spark's event log.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cordon.config import FIXTURE_CONFIG as CFG  # noqa: E402
from cordon.plans import audit  # noqa: E402
from cordon.session import get_session  # noqa: E402
from cordon.sources import fixture  # noqa: E402


def task_seconds(folder: str, began: float, ended: float) -> dict[str, float]:
    """Of the stages submitted in that time, by the event log: wall, all tasks, their CPU, and the rest."""
    wall = run = cpu = 0.0
    stages = set()
    for name in os.listdir(folder):
        with open(os.path.join(folder, name), errors="replace") as f:
            for line in f:
                if '"SparkListenerTaskEnd"' not in line and '"SparkListenerStageCompleted"' not in line:
                    continue
                e = json.loads(line)
                if "Stage Info" in e:
                    i = e["Stage Info"]
                    if began <= i.get("Submission Time", 0) / 1000 <= ended:
                        wall += (i.get("Completion Time", 0) - i["Submission Time"]) / 1000
                        stages.add(i["Stage ID"])
                elif began <= e["Task Info"]["Launch Time"] / 1000 <= ended:
                    m = e.get("Task Metrics") or {}
                    run += m.get("Executor Run Time", 0) / 1000
                    cpu += m.get("Executor CPU Time", 0) / 1e9
    return {"stages": len(stages), "stage_wall": round(wall, 2), "task_run": round(run, 2), "task_cpu": round(cpu, 2)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    scratch = tempfile.mkdtemp(prefix="cordon-bench-")
    os.makedirs(f"{scratch}/events")
    spark = get_session(
        f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="cordon-bench",
        extra={
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": f"{scratch}/ckpt",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"{scratch}/events",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            # Local disk only: without Hadoop's native library the local filesystem forks a chmod for
            # every file and directory it creates; skipping the .crc sidecar files halves those forks.
            # Cluster storage (HDFS, object stores) has neither cost.
            "spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
        },
    )

    def stage_raw(src_dir: str, dst: str) -> dict[str, str]:
        paths = {}
        for t in CFG.taxi_types:
            p = f"{dst}/raw/{t}"
            r = fixture.raw_trips(spark, src_dir, t)
            r.withColumns({"year": r.source_file.substr(-15, 4).cast("int"),
                           "month": r.source_file.substr(-10, 2).cast("int")}) \
                .write.mode("overwrite").partitionBy("year", "month").parquet(p)
            paths[t] = p
        return paths

    # -- untimed setup ----------------------------------------------------------------------------
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        warm_paths = stage_raw(warm_dir, f"{scratch}/warm")
        warm = audit.AuditTables(f"{scratch}/warm/out")
        audit.ingest(spark, warm_paths, CFG, warm)
        warm_zones = fixture.zones(spark, warm_dir)
        warm_ids = audit.write_zone_daily(spark, warm_zones, CFG, warm)
        audit.write_results(spark, warm, warm_zones, fixture.weather(spark, warm_dir), CFG, zone_ids=warm_ids)
    raw_paths = stage_raw(sf_dir, scratch)
    zones_df = fixture.zones(spark, sf_dir).cache()
    weather_df = fixture.weather(spark, sf_dir).cache()
    zones_df.count()
    weather_df.count()

    tables = audit.AuditTables(f"{scratch}/out")
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    began = time.time()
    timed("unify_and_split", lambda: audit.ingest(spark, raw_paths, CFG, tables))
    ended = time.time()
    ids = audit.zone_ids_of(zones_df, CFG)
    timed("split_stats", lambda: audit.write_hubs(spark, tables, ids, CFG))
    timed("zone_rollup", lambda: audit.write_zone_daily(spark, zones_df, CFG, tables, zone_ids=ids))
    res = timed("open_tables", lambda: audit.results(spark, tables, zones_df, weather_df, CFG, zone_ids=ids))
    headline = [
        "daily_trips", "revenue_daily_cumulative", "zone_period", "daily_leakage",
        "leakage_summary", "kpi_overview", "zone_period_pivot", "quarter_comparison", "market_share_shift",
        "impute_month", "top_pickups_entering", "top_leakage_pickups", "ghost_totals", "ghost_patterns",
        "weather_joined", "weather_correlation", "rain_effect",
    ]
    for name in headline:
        timed(name, res[name].collect)

    trips = spark.read.parquet(tables.trips).count()
    files = [os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(tables.trips) for f in names if f.endswith(".parquet")]
    spark.stop()  # the event log is complete then
    print(json.dumps({
        "metric": "audit_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "trips": trips,
        "cpus": cpus,
        "files_written": len(files), "mean_file_kb": round(sum(files) / max(1, len(files)) / 1024),
        "ingest_task_seconds": task_seconds(f"{scratch}/events", began, ended),
        "unify_split_stats_rows_per_sec": round(trips / (timings["unify_and_split"] + timings["split_stats"])),
    }))


if __name__ == "__main__":
    main()
