"""Runs of the ingest and the files they took (incremental ingest, S3, S6).

Every run writes its trips under its own ``run_id`` folder, then its manifest rows (one per raw file:
path, size, modification time, rows read, kept and clean, whether it is valid), and at last one entry in
the log, which makes it visible. Log entries are numbered without gaps, and an entry is made only if none
with its number is there, so two runs cannot both be the next one:

- a run remembers the number of the log's last entry when it listed its files;
- when it publishes and finds further entries, it looks at the files of the runs behind them. If none of
  its own is among them and no full run is, it takes the next free number. Else it is refused
  (``Conflict``), its folder is never read, and the caller goes on with the files that are left.

So of runs that work at the same time on the same files only one publishes each file. A run that dies
leaves a folder that nobody reads, holds nothing locked, and its files count as new. A file is known by
its full path, size and modification time, so equal names in two folders are two files. ``vacuum``
removes the folders of runs that were replaced or never published.

The one operation asked of the store is to make a file under a name that must not be there yet: a hard
link on local and shared file systems, a rename that refuses an existing target elsewhere.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Mapping
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROW_SCHEMA = ("taxi_type string, file_path string, file_size long, modified timestamp, rows_read long, rows_kept long, "
              "rows_clean long, is_valid boolean, reason string")
SCHEMA = f"run_id string, version long, is_full boolean, {ROW_SCHEMA}"
_LOG_NAME = "%020d"


class Conflict(RuntimeError):
    """Another run has published files of this one, or replaced everything, since this one listed its files."""


# -- the store ---------------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; any other trouble with the store is an error, not an answer."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _local(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    full = fs.makeQualified(p).toString()
    return unquote(urlparse(full).path) if full.startswith("file:") else None


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Make a file with this content unless one is there; whether this call made it. The content is
    complete whenever the name is there."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    draft = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"  # names that begin so are hidden from Spark's readers
    local = _local(spark, path)
    if local is not None:
        own = _local(spark, draft)
        with open(own, "w") as f:
            f.write(content)
        try:
            os.link(own, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    jvm = spark._jvm
    out = fs.create(jvm.org.apache.hadoop.fs.Path(draft), True)
    out.write(bytearray(content.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(draft), p, spark.sparkContext._gateway.new_array(kind, 0))
        return True
    except Exception as e:
        fs.delete(jvm.org.apache.hadoop.fs.Path(draft), False)
        if fs.exists(p):
            return False
        raise e


# -- runs ----------------------------------------------------------------------------------------

def new_run_id() -> str:
    return f"r{time.time_ns()}-{uuid.uuid4().hex[:8]}"


def log(spark: SparkSession, path: str) -> DataFrame:
    """``version, run_id`` of the published runs (one row a run)."""
    if not exists(spark, f"{path}/log"):
        return spark.createDataFrame([], "version long, run_id string")
    return spark.read.text(f"{path}/log").select(
        F.col("_metadata.file_name").cast("long").alias("version"), F.col("value").alias("run_id"))


def last_version(spark: SparkSession, path: str) -> int:
    """Number of the last log entry, 0 if there is none. Only the folder is listed."""
    fs, p = _fs(spark, f"{path}/log")
    if not fs.exists(p):
        return 0
    return max((int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()), default=0)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all published runs; empty if there is none yet."""
    published = log(spark, path)
    if not exists(spark, f"{path}/runs"):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(f"is_full boolean, {ROW_SCHEMA}, run_id string").parquet(f"{path}/runs")
    return rows.join(published, "run_id").select("run_id", "version", "is_full", *row_columns())


def row_columns() -> list[str]:
    return [f.split()[0] for f in ROW_SCHEMA.split(", ")]


def publish(spark: SparkSession, path: str, run_id: str, is_full: bool, rows: list[tuple], base: int,
            alone: bool = False) -> int:
    """Write a run's rows and enter it in the log; the version it got. ``base`` is the log's last version when
    the run listed its files; with ``alone`` any entry since then is a conflict."""
    folder = f"{path}/runs/run_id={run_id}"
    spark.createDataFrame(rows, ROW_SCHEMA).withColumn("is_full", F.lit(is_full)).coalesce(1) \
        .write.mode("overwrite").parquet(folder)
    own = {(r[0], r[1]) for r in rows if r[1] is not None}
    seen = base
    while True:
        last = last_version(spark, path)
        if last > seen and (alone or not is_full):
            since = read(spark, path).filter((F.col("version") > seen) & (F.col("version") <= last))
            if alone or not since.filter("is_full").isEmpty() or _shares(spark, since, own):
                raise Conflict(f"run {run_id}: runs {seen + 1} to {last} took its files or replaced all")
        seen = max(seen, last)
        if create_once(spark, f"{path}/log/{_LOG_NAME % (last + 1)}", run_id):
            return last + 1


def _shares(spark: SparkSession, since: DataFrame, own: set) -> bool:
    mine = spark.createDataFrame(sorted(own), "taxi_type string, file_path string")  # files of one run
    return not since.select("taxi_type", "file_path").join(mine, ["taxi_type", "file_path"], "left_semi").isEmpty()


def current(manifest: DataFrame) -> DataFrame:
    """Rows of the last full run and of the increments after it."""
    start = manifest.filter("is_full").agg(F.coalesce(F.max("version"), F.lit(0)).alias("_from"))
    return manifest.join(F.broadcast(start), F.col("version") >= F.col("_from")).drop("_from")  # one row


def published_runs(manifest: DataFrame) -> list[str]:
    """Runs that hold trips, in order (one entry a run)."""
    runs = manifest.groupBy("run_id", "version", "is_full").agg(F.sum("rows_kept").alias("n")).collect()
    start = max((r["version"] for r in runs if r["is_full"]), default=0)
    return [r["run_id"] for r in sorted(runs, key=lambda r: r["version"]) if r["version"] >= start and r["n"]]


def vacuum(spark: SparkSession, path: str, folders: list[str], older_than_seconds: float) -> list[str]:
    """Remove the run folders under ``folders`` whose run is not current and whose last change is that long
    ago (longer than any run or reader takes); the folders removed."""
    keep = {r["run_id"] for r in current(read(spark, path)).select("run_id").distinct().collect()}
    gone = []
    for folder in [*folders, f"{path}/runs"]:
        fs, p = _fs(spark, folder)
        if not fs.exists(p):
            continue
        for s in fs.listStatus(p):
            name = s.getPath().getName()
            old = time.time() - s.getModificationTime() / 1000 >= older_than_seconds
            if name.startswith("run_id=") and name[len("run_id="):] not in keep and old:
                fs.delete(s.getPath(), True)
                gone.append(s.getPath().toString())
    return gone


# -- files ---------------------------------------------------------------------------------------

def plain_path(path: Column) -> Column:
    """One spelling of a path: scheme, colon, three slashes at most."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/(?!/)", "$1:///")


def list_files(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row per raw file: ``taxi_type, file_path, file_size, modified``. Only the listing is read."""
    out = None
    for t, p in paths.items():
        found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
                 .load(p).select(F.lit(t).alias("taxi_type"), plain_path(F.col("path")).alias("file_path"),
                                 F.col("length").alias("file_size"), F.col("modificationTime").alias("modified")))
        out = found if out is None else out.unionByName(found)
    return out


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files that no current run has taken. A file that has changed since it was taken is refused:
    its old trips are in the table, so it takes a full run."""
    done = current(manifest).filter("file_path IS NOT NULL").select(
        "taxi_type", "file_path", F.col("file_size").alias("_size"), F.col("modified").alias("_modified"))
    both = files.join(done, ["taxi_type", "file_path"], "left")
    changed = [r["file_path"] for r in both.filter((F.col("_size") != F.col("file_size"))
                                                   | (F.col("_modified") != F.col("modified"))).take(5)]
    if changed:
        raise ValueError(f"these files changed after they were taken; run in full: {changed}")
    return both.filter(F.col("_size").isNull()).select(*files.columns)


def file_report(manifest: DataFrame) -> DataFrame:
    """One row per file of the current runs."""
    return current(manifest).filter("file_path IS NOT NULL").select(
        "taxi_type", "file_path", "file_size", "rows_read", "rows_kept", "is_valid", "reason", "run_id") \
        .orderBy("taxi_type", "file_path")
