"""The whole audit as a sequence of Spark jobs over written tables.

Phases hand over through Parquet tables in the shared folder (``spark.checkpoint.dir`` or a given
output root), never through the driver:

1. ``trips``  - raw files of every type -> unified schema -> labelled trips, in one job, under
                ``run_id=<run>/split=clean|ghost/year/month``: one scan and one write give both the clean
                set and the audit trail. The run then enters the manifest (``sources/manifest.py``), which
                makes it visible. A full run replaces all earlier ones; an increment adds its files.
2. ``hubs``   - per run and zone table, one pass over the run's labelled trips makes six small tables of sums
                and counts (``operators/hubs.py``). They add up, so an increment reads its own trips only,
                and they are kept under a mark of the zone ids, so another zone table makes its own.
3. ``results`` - everything else follows from the hubs of the current runs; no trip is read again.

Runs may work at the same time: of those that take the same files only one publishes each (``manifest``).
``compact`` rewrites all current runs as one with planned file sizes, and ``vacuum`` removes what was
replaced.

A phase that fails (or loses executors beyond Spark's task retries) is simply rerun: trips of a run
that was not published are never read. The written tables cut the lineage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cordon.config import CLEAN_LABEL, UNIFIED_COLUMNS, AuditConfig
from cordon.operators import anomaly, compare, hubs, impute, kpi, leakage, series, unify, weather, zones
from cordon.operators.joins import row_count_at_most
from cordon.sources import inventory, manifest, raw, schema, sinks

RUN_COLUMNS = [*UNIFIED_COLUMNS, "taxi_type", "year", "month"]


@dataclass(frozen=True)
class AuditTables:
    root: str

    @property
    def unified(self) -> str:
        return f"{self.root}/unified"

    @property
    def trips(self) -> str:
        return f"{self.root}/trips"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def hubs(self) -> str:
        return f"{self.root}/hubs"

    @property
    def zone_daily(self) -> str:
        return f"{self.root}/zone_daily"

    def run(self, run_id: str) -> str:
        return f"{self.trips}/run_id={run_id}"

    def result(self, name: str) -> str:
        return f"{self.root}/results/{name}"


# -- phase 1 ---------------------------------------------------------------------------------

def write_run(unified: DataFrame, cfg: AuditConfig, tables: AuditTables, run_id: str, month_salt: int | None = None,
              layout: str = "keep", n_files: int = 0, seed: int = 0, mode: str = "errorifexists") -> dict:
    """Label ``unified`` and write both splits under the run's own folder (not visible yet). What was written
    is observed on the way: ``kept``, ``clean`` and, for ``n_files`` files, both by file."""
    flagged = anomaly.flag_trips(unified, cfg)
    is_clean = F.col("ghost_flag") == CLEAN_LABEL
    metrics = [F.count(F.lit(1)).alias("kept"), F.count_if(is_clean).alias("clean")]
    if n_files:
        mark = sinks.file_mark(F.col("file_path"), seed)
        metrics += [sinks.count_by_file(mark, n_files).alias("kept_by_file"),
                    sinks.count_by_file(F.when(is_clean, mark), n_files).alias("clean_by_file")]
    split = F.when(is_clean, F.lit("clean")).otherwise(F.lit("ghost"))
    return sinks.write_trips(flagged.withColumn("split", split), tables.run(run_id), month_salt=month_salt, layout=layout,
                             metrics=metrics, mode=mode)


def write_labelled(unified: DataFrame, cfg: AuditConfig, tables: AuditTables, month_salt: int | None = None) -> str:
    """A full run from a frame instead of files; returns its run id."""
    spark, run_id = unified.sparkSession, manifest.new_run_id()
    base = manifest.last_version(spark, tables.manifest)
    seen = write_run(unified, cfg, tables, run_id, month_salt)
    manifest.publish(spark, tables.manifest, run_id, True,
                     [(None, None, None, None, seen["kept"], seen["kept"], seen["clean"], True, None)], base)
    return run_id


def file_marks(spark: SparkSession, paths: list[str]) -> tuple[int, dict[float, str]]:
    """A seed for which all files have different marks, and the marks."""
    listing = spark.createDataFrame([(p,) for p in paths], "file_path string")  # files of one run
    for seed in range(8):
        marks = {r["m"]: r["file_path"] for r in listing.select("file_path", sinks.file_mark(F.col("file_path"), seed).alias("m")).collect()}
        if len(marks) == len(paths):
            return seed, marks
    raise ValueError("the files' paths are not all different")


def ingest(spark: SparkSession, paths: Mapping[str, str], cfg: AuditConfig, tables: AuditTables,
           full: bool = True, month_salt: int | None = None, layout: str | None = None, attempts: int = 5) -> str | None:
    """Take the raw files (all, or those no published run has) in one run; None if there is nothing new.

    Raw files are read once and the written table never: rows read come from the footers, rows kept are
    observed while they are written. Every listed file gets a manifest row: an unreadable or empty file, and
    one whose rows all lack a required column, is reported as invalid with the reason, and the others go
    on. If another run published some of the files meanwhile, this one is dropped and takes what is left.
    The driver holds the list of files only."""
    for _ in range(attempts):
        base = manifest.last_version(spark, tables.manifest)
        listed = manifest.list_files(spark, paths)
        if not full:
            listed = manifest.new_files(listed, manifest.read(spark, tables.manifest))
        files = listed.orderBy("taxi_type", "file_path").collect()  # one row a file
        if not files:
            if full:
                raise ValueError(f"no trip files under {sorted(paths.values())}")
            return None
        run_id, rows = _take(spark, files, cfg, tables, month_salt, layout)
        try:
            manifest.publish(spark, tables.manifest, run_id, full, rows, base)
            return run_id
        except manifest.Conflict:
            continue
    raise manifest.Conflict(f"{attempts} attempts were overtaken by other runs")


def _take(spark: SparkSession, files: list, cfg: AuditConfig, tables: AuditTables, month_salt: int | None,
          layout: str | None) -> tuple[str, list[tuple]]:
    """Write the trips of the files; the run id and the manifest rows."""
    rows_read, bad = raw.file_states(spark, files)
    layout = layout or sinks.layout_for([f["file_size"] for f in files])

    def attempt() -> tuple[str, dict]:
        run_id = manifest.new_run_id()
        todo: dict[str, list[str]] = {}
        for f in files:
            if rows_read.get(f["file_path"]) and f["file_path"] not in bad:
                todo.setdefault(f["taxi_type"], []).append(f["file_path"])
        if not todo:
            return run_id, {}
        seed, marks = file_marks(spark, [p for ps in todo.values() for p in ps])
        unified = unify.unify_all(raw.read_raw_sources(spark, todo, cfg.column_maps), cfg.column_maps)
        seen = write_run(unified, cfg, tables, run_id, month_salt, layout, n_files=len(marks), seed=seed)
        return run_id, {k: sinks.counts_of(seen[f"{k}_by_file"], marks) for k in ("kept", "clean")} | {"total": seen["kept"]}

    try:
        run_id, seen = attempt()
    except raw.READ_ERRORS:
        # Data pages can be damaged behind a sound footer: find such files, leave them out, try once more.
        found = raw.file_states(spark, files, pages=True, column_maps=cfg.column_maps)[1]
        if not set(found) - set(bad):
            raise
        bad.update(found)
        run_id, seen = attempt()
    kept, clean = seen.get("kept", {}), seen.get("clean", {})
    if sum(kept.values()) != seen.get("total", 0):
        raise RuntimeError("rows by file do not add up to the rows written")
    rows = []
    for f in files:
        p = f["file_path"]
        n, k = rows_read.get(p, 0), kept.get(p, 0)
        reason = bad.get(p) or ("empty" if not n else None if k else "no row has all required columns")
        rows.append((f["taxi_type"], p, f["file_size"], f["modified"], n, k, clean.get(p, 0), reason is None, reason))
    return run_id, rows


def compact(spark: SparkSession, tables: AuditTables, target_bytes: int = sinks.TARGET_BYTES) -> str:
    """Rewrite the trips of all current runs as one run whose months are in files of about ``target_bytes``;
    it replaces them at once, or not at all if another run is published meanwhile (``Conflict``).

    The layout is planned from the counts by split and month in the footers and the mean bytes a row, so a
    month has as many files as it fills and a smaller one has one file."""
    base = manifest.last_version(spark, tables.manifest)
    now = manifest.read(spark, tables.manifest)
    runs, rows = manifest.published_runs(now), manifest.current(now)
    if not runs:
        raise ValueError(f"no published trips under {tables.root}")
    trips = read_runs(spark, tables, runs)
    counts = trips.groupBy(*sinks.TRIP_PARTITIONS).agg(F.count(F.lit(1)).alias("trip_count"))
    sizes = manifest.list_files(spark, {"": tables.trips}).filter(
        F.regexp_extract("file_path", "run_id=([^/]+)", 1).isin(runs)).agg(F.sum("file_size")).collect()[0][0]
    files = [tuple(r) for r in rows.select(*manifest.row_columns()).collect()]  # one row a file
    n = sum(f[5] for f in files)
    dealt = sinks.planned_layout(trips.drop("run_id"), counts, sizes / max(n, 1),
                                 [F.col("_metadata.file_path"), F.col("_metadata.row_index")], target_bytes)
    run_id = manifest.new_run_id()
    seen = sinks.write_trips(dealt, tables.run(run_id), metrics=[F.count(F.lit(1)).alias("kept")])
    if seen["kept"] != n:
        raise RuntimeError(f"{seen['kept']} trips were written and {n} are in the manifest")
    manifest.publish(spark, tables.manifest, run_id, True, files, base, alone=True)
    return run_id


def vacuum(spark: SparkSession, tables: AuditTables, older_than_seconds: float = 7 * 86400) -> list[str]:
    """Remove trips and hubs of runs that were replaced or never published and are that old."""
    folders = [tables.trips]
    if manifest.exists(spark, tables.hubs):
        fs, p = manifest._fs(spark, tables.hubs)
        folders += [s.getPath().toString() for s in fs.listStatus(p)]
    return manifest.vacuum(spark, tables.manifest, folders, older_than_seconds)


def read_labelled(spark: SparkSession, tables: AuditTables) -> DataFrame:
    """Trips of the published runs."""
    return read_runs(spark, tables, current_runs(spark, tables))


def read_runs(spark: SparkSession, tables: AuditTables, run_ids: list[str]) -> DataFrame:
    return spark.read.option("basePath", tables.trips).parquet(*[tables.run(r) for r in run_ids])


def clean_split(labelled: DataFrame) -> DataFrame:
    """Clean trips: the unified columns plus type and month partitions (split 'clean' only)."""
    return labelled.filter(F.col("split") == "clean").select(*RUN_COLUMNS)


def ghost_split(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("split") == "ghost").drop("split", "run_id")


def read_clean(spark: SparkSession, tables: AuditTables) -> DataFrame:
    return clean_split(read_labelled(spark, tables))


def read_ghost(spark: SparkSession, tables: AuditTables) -> DataFrame:
    return ghost_split(read_labelled(spark, tables))


# -- phase 2 ---------------------------------------------------------------------------------

def zone_ids_of(zone_table: DataFrame, cfg: AuditConfig) -> DataFrame:
    """The tolled zone's ids, size-checked once per run and shared by every phase that needs them. A zone
    table without any is refused: every trip would count as outside the zone."""
    found = zones.congestion_zones(zone_table, cfg)
    if row_count_at_most(found, 0):
        raise ValueError(f"the zone table names no zone of {cfg.zone_borough!r} with the configured keywords")
    return zones.zone_id_set(found, cfg)


def zones_mark(zone_ids: DataFrame, cfg: AuditConfig) -> str:
    """A mark of all that the hubs depend on: the zone ids, the policy start and the imputed month. Hubs are
    kept under it, so those of another zone table are never mixed in and are there again when it comes back."""
    h = F.xxhash64("zone_id")
    r = zone_ids.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).collect()[0]
    return hashlib.sha256(f"{r['n']} {r['x']} {r['s']} {cfg.policy_start_literal} {cfg.impute_month}".encode()).hexdigest()[:16]


def current_runs(spark: SparkSession, tables: AuditTables) -> list[str]:
    runs = manifest.published_runs(manifest.read(spark, tables.manifest))
    if not runs:
        raise ValueError(f"no published trips under {tables.root}")
    return runs


def write_hubs(spark: SparkSession, tables: AuditTables, zone_ids: DataFrame, cfg: AuditConfig,
               runs: list[str] | None = None) -> str:
    """The hubs of each published run that has none for these zones, one pass over its trips; their mark."""
    mark = zones_mark(zone_ids, cfg)
    for run_id in runs if runs is not None else current_runs(spark, tables):
        path = f"{tables.hubs}/zones={mark}/run_id={run_id}"
        if not manifest.exists(spark, f"{path}/_SUCCESS"):
            classified = zones.classify(read_runs(spark, tables, [run_id]), zone_ids, cfg)
            hubs.trip_hubs(classified, cfg).repartition("hub").write.mode("overwrite").option("compression", "zstd") \
                .partitionBy("hub").parquet(path)
    return mark


def read_hubs(spark: SparkSession, tables: AuditTables, mark: str, runs: list[str]) -> dict[str, DataFrame]:
    """Each grain over these runs."""
    base = f"{tables.hubs}/zones={mark}"
    partials = spark.read.schema(hubs.STORED).option("basePath", base).parquet(*[f"{base}/run_id={r}" for r in runs])
    if len(runs) == 1:
        return {g: partials.filter(F.col("hub") == g).select(*hubs.GRAINS[g], *hubs.MEASURES) for g in hubs.GRAINS}
    return {g: hubs.merged(partials, g) for g in hubs.GRAINS}


def write_zone_daily(spark: SparkSession, zone_table: DataFrame, cfg: AuditConfig, tables: AuditTables,
                     zone_ids: DataFrame | None = None) -> DataFrame:
    """Write the hubs that are missing, and the zone-day rollup of all current runs; returns the zone-id set."""
    ids = zone_ids if zone_ids is not None else zone_ids_of(zone_table, cfg)
    runs = current_runs(spark, tables)
    days = read_hubs(spark, tables, write_hubs(spark, tables, ids, cfg, runs), runs)["day"]
    sinks.write_result(zones.zone_daily_from_partials(hubs.clean(days)), tables.zone_daily)
    return ids


def read_zone_daily(spark: SparkSession, tables: AuditTables) -> DataFrame:
    return spark.read.parquet(tables.zone_daily)


# -- phase 3 -----------------------------------------------------------------------------------

# Results whose rows come in an order, which their files keep.
ORDERED = ("ghost_stats", "ghost_patterns", "missing_months", "unprocessed_months", "file_report", "zone_summary",
           "top_pickups_entering", "top_pickups_same_loc", "top_dropoffs_exiting", "top_leakage_pickups",
           "congestion_zone_sample")


class Results(Mapping):
    """Result frames by name, each built when it is asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _month_is_missing(spark: SparkSession, tables: AuditTables, days: DataFrame, cfg: AuditConfig) -> bool:
    """The month is imputed only while no valid file of it is there for every type. A run from frames lists no
    files; there the trips themselves say whether the month is complete."""
    files = inventory.counts_by_file(manifest.file_report(manifest.read(spark, tables.manifest)))
    there = F.col("is_valid") & (F.col("year") == cfg.impute_year) & (F.col("month") == cfg.impute_month)
    listed = files.agg(F.count(F.lit(1)).alias("n_files"), F.count_distinct(F.when(there, F.col("taxi_type"))).alias("types")).collect()[0]
    if listed["n_files"]:
        return listed["types"] < len(cfg.taxi_types)
    d = F.col("trip_date")
    target = hubs.clean(days).filter((F.year(d) == cfg.impute_year) & (F.month(d) == cfg.impute_month))
    return target.select("taxi_type").distinct().count() < len(cfg.taxi_types)


def results(spark: SparkSession, tables: AuditTables, zone_table: DataFrame, weather_table: DataFrame | None,
            cfg: AuditConfig, zone_ids: DataFrame | None = None) -> Mapping[str, DataFrame]:
    """Result frames over the hubs, the rollup and the manifest: no trip is read, and a frame is built only
    when it is asked for."""
    ids = zone_ids if zone_ids is not None else zone_ids_of(zone_table, cfg)
    runs = current_runs(spark, tables)
    hub = read_hubs(spark, tables, zones_mark(ids, cfg), runs)
    files, days, clock, places = (hub[g] for g in ("file", "day", "clock", "place"))
    after = hubs.after_start(places)
    rollup = read_zone_daily(spark, tables)

    def report() -> DataFrame:
        return manifest.file_report(manifest.read(spark, tables.manifest))

    def counts() -> DataFrame:
        return inventory.counts_by_file(report())

    def processed() -> DataFrame:
        return counts().join(files.filter("trip_count > 0").select("taxi_type", "source_file").distinct(), ["taxi_type", "source_file"])

    def zones_found() -> DataFrame:
        return zones.congestion_zones(zone_table, cfg)

    def stored() -> DataFrame:
        return spark.read.option("basePath", tables.trips).parquet(tables.run(runs[-1]))

    out: dict[str, Callable[[], DataFrame]] = {
        "file_report": report,
        "source_row_counts": counts,
        "missing_months": lambda: inventory.missing_months(spark, counts(), cfg),
        "unprocessed_months": lambda: inventory.unprocessed_months(counts(), processed()),
        "impute_needed": lambda: inventory.impute_needed(counts(), cfg),
        "schema_check": lambda: schema.schema_check_from_files(stored(), files),
        "value_drift": lambda: hubs.value_drift(files),
        "ghost_stats": lambda: anomaly.ghost_stats(files),
        "ghost_totals": lambda: anomaly.ghost_totals(files),
        "ghost_patterns": lambda: anomaly.ghost_patterns(files),
        "ghost_by_hour_dow": lambda: hubs.ghost_by_hour_dow(clock),
        "ghost_by_location": lambda: hubs.ghost_by_location(places),
        "congestion_zones": zones_found,
        "congestion_zone_sample": lambda: zones.zone_name_sample(zones_found()),
        "zone_summary": lambda: hubs.zone_summary(days),
        "zone_hourly": lambda: hubs.zone_hourly(clock),
        "zone_dow": lambda: hubs.zone_dow(clock),
        "daily_trips": lambda: series.daily_trips(rollup),
        "revenue_daily_cumulative": lambda: series.revenue_daily_cumulative(rollup),
        "zone_period": lambda: series.zone_period(rollup, cfg),
        "daily_leakage": lambda: series.daily_leakage(rollup),
        "zone_revenue": lambda: series.zone_revenue(rollup),
        "zone_period_pivot": lambda: series.zone_period_pivot(rollup),
        "leakage_summary": lambda: leakage.leakage_summary(rollup, cfg),
        "kpi_overview": lambda: kpi.kpi_overview(rollup, cfg),
        "quarter_stats": lambda: compare.quarter_stats_from_days(days, cfg),
        "quarter_comparison": lambda: compare.quarter_comparison_from_days(days, cfg),
        "market_share_shift": lambda: compare.market_share_shift_from_days(days, cfg),
        "top_pickups_entering": lambda: zones.top_pickups_entering(after, cfg),
        "top_pickups_same_loc": lambda: zones.top_pickups_same_loc(after, cfg),
        "top_dropoffs_exiting": lambda: zones.top_dropoffs_exiting(after, cfg),
        "top_leakage_pickups": lambda: leakage.top_leakage_pickups(after, cfg),
    }
    if _month_is_missing(spark, tables, days, cfg):
        grains = (days, hub["pickup"], hub["dropoff"])
        out["month_profile"] = lambda: impute.month_profile_from_hubs(*grains, cfg)
        out["impute_month"] = lambda: impute.impute_month_from_hubs(*grains, cfg)
        out["impute_total"] = lambda: impute.impute_total(impute.impute_month_from_hubs(*grains, cfg))
    if weather_table is not None:
        def joined() -> DataFrame:
            return weather.weather_joined(rollup, weather_table, cfg)

        out["weather_joined"] = lambda: weather.weather_joined_report(joined())
        out["weather_correlation"] = lambda: weather.weather_correlation(joined())
        out["rain_effect"] = lambda: weather.rain_effect(joined())
        out["precip_elasticity"] = lambda: weather.precip_elasticity(joined())
        out["rain_compliance"] = lambda: weather.rain_compliance(rollup, weather_table, cfg)
    return Results(out)


def write_results(spark: SparkSession, tables: AuditTables, zone_table: DataFrame, weather_table: DataFrame | None,
                  cfg: AuditConfig, zone_ids: DataFrame | None = None) -> None:
    ids = zone_ids if zone_ids is not None else zone_ids_of(zone_table, cfg)
    write_zone_daily(spark, zone_table, cfg, tables, zone_ids=ids)  # hubs that are there already are not made again
    for name, df in results(spark, tables, zone_table, weather_table, cfg, zone_ids=ids).items():
        sinks.write_result(df, tables.result(name), ordered=name in ORDERED)


def run_audit(spark: SparkSession, raw_by_type: Mapping[str, DataFrame], zone_table: DataFrame,
              weather_table: DataFrame | None, root: str, cfg: AuditConfig,
              keep_unified: bool = False) -> AuditTables:
    """Run every phase on raw frames and write every result under ``root``."""
    tables = AuditTables(root.rstrip("/"))
    unified = unify.unify_all(raw_by_type, cfg.column_maps)
    if keep_unified:
        unified.write.mode("overwrite").parquet(tables.unified)
        unified = spark.read.parquet(tables.unified)
    write_labelled(unified, cfg, tables)
    write_results(spark, tables, zone_table, weather_table, cfg)
    return tables
