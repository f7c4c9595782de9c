"""Trip streams: a zone-day rollup as mergeable partials, and an ingest into the same manifest as the batch.

Nothing is held in state and nothing is late: every micro-batch is aggregated to sums and counts per
(day, category, period) and written under its batch id; ``zones.zone_daily_from_partials`` merges them
on read. Trip files arrive by month and hold stray and future dates, so a watermark would drop trips.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from cordon.config import COLUMN_MAPS, AuditConfig
from cordon.operators import anomaly, unify, zones
from cordon.plans import audit
from cordon.plans.audit import AuditTables
from cordon.sources import manifest, raw, sinks
from cordon.sources.raw import raw_schema


def read_raw_stream(spark: SparkSession, path: str, taxi_type: str, max_files_per_trigger: int | None = None,
                    time_type: DataType | None = None) -> DataFrame:
    """Stream the trip files of one type as they land in ``path``, under the explicit raw schema."""
    reader = spark.readStream.schema(raw_schema(COLUMN_MAPS[taxi_type], time_type))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(path).withColumns({
        "source_file": F.col("_metadata.file_name"), "file_path": manifest.plain_path(F.col("_metadata.file_path")),
        "file_size": F.col("_metadata.file_size"), "modified": F.col("_metadata.file_modification_time")})


def start_zone_daily_partials(raw_streams: Mapping[str, DataFrame], zone_ids: DataFrame, cfg: AuditConfig,
                              path: str, checkpoint: str, available_now: bool = False,
                              processing_time: str | None = None) -> StreamingQuery:
    """Stream trips into a table of partial rollups, one partition per micro-batch.

    Nothing is held in state and nothing is late: a trip for an old day adds a partial row for that
    day. Each micro-batch overwrites only its own ``batch_id`` partition, so a replayed batch (after
    a failure) replaces its earlier attempt: the table is exactly-once.
    """
    unified = unify.unify_all(raw_streams, cfg.column_maps)
    classified = zones.classify(anomaly.clean_trips(anomaly.flag_trips(unified, cfg)), zone_ids, cfg)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (
            zones.zone_daily_partials(batch).withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(path)
        )

    writer = classified.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


# -- streamed ingest into the manifest -------------------------------------------------------------------

def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The query's own id, which its checkpoint keeps for as long as its batch numbers go on."""
    text = "".join(r["value"] for r in spark.read.text(f"{checkpoint}/metadata").collect())  # one line
    return json.loads(text)["id"]


def take_batch(batch: DataFrame, run_id: str, cfg: AuditConfig, tables: AuditTables, attempts: int = 5) -> str | None:
    """Publish the files of one micro-batch as the run ``run_id``; None if all of them are taken already.

    ``batch`` holds unified trips with ``file_path, file_size, modified``; a file is never split over
    micro-batches. A run id that is in the log is a replayed batch and is left as it is. Files that another
    run has taken are left out."""
    spark = batch.sparkSession
    for _ in range(attempts):
        base = manifest.last_version(spark, tables.manifest)
        if not manifest.log(spark, tables.manifest).filter(F.col("run_id") == run_id).isEmpty():
            return run_id
        seen = batch.select("taxi_type", "file_path", "file_size", "modified").distinct()
        todo = manifest.new_files(seen, manifest.read(spark, tables.manifest)).orderBy("taxi_type", "file_path").collect()
        if not todo:
            return None
        paths = [f["file_path"] for f in todo]  # files of one micro-batch
        read = {r["file_path"]: r["rows_read"] for r in raw.row_counts(spark, paths).collect()}
        seed, marks = audit.file_marks(spark, paths)
        mine = spark.createDataFrame([(p,) for p in paths], "file_path string")
        trips = batch.join(F.broadcast(mine), "file_path", "left_semi").drop("file_size", "modified")
        layout = sinks.layout_for([f["file_size"] for f in todo])
        got = audit.write_run(trips, cfg, tables, run_id, layout=layout, n_files=len(marks), seed=seed, mode="overwrite")
        kept, clean = (sinks.counts_of(got[f"{k}_by_file"], marks) for k in ("kept", "clean"))
        rows = [(f["taxi_type"], f["file_path"], f["file_size"], f["modified"], read.get(f["file_path"], 0),
                 kept.get(f["file_path"], 0), clean.get(f["file_path"], 0), True, None) for f in todo]
        try:
            manifest.publish(spark, tables.manifest, run_id, False, rows, base)
            return run_id
        except manifest.Conflict:
            continue
    raise manifest.Conflict(f"{attempts} attempts were overtaken by other runs")


def start_ingest(raw_streams: Mapping[str, DataFrame], cfg: AuditConfig, tables: AuditTables, checkpoint: str,
                 available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Stream trip files into the same runs and manifest as the batch ingest: every micro-batch is a run whose
    id follows from the query's id and the batch's number, so a replayed batch publishes nothing twice, and
    a file that either has taken the other leaves alone. (A file none of whose rows is complete gives the
    stream no rows; it is left to the batch ingest, which reports it.)"""
    unified = None
    for t, s in raw_streams.items():
        one = unify.unify(s, cfg.column_maps[t], t)
        unified = one if unified is None else unified.unionByName(one)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        take_batch(batch, f"s{_stream_id(batch.sparkSession, checkpoint)}-{batch_id:012d}", cfg, tables)

    writer = unified.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
