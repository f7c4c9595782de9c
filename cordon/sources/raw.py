"""Raw trip files: one directory, glob or list of files per taxi type, read as one dataset.

Files are read with an explicit schema per type: the mapped raw columns at their widest types (whole
numbers as long, money and distance as double), so files that store a column as int or long, float or
double can stand side by side, and a file that lacks a column gives NULL for its own rows only. Names
match whatever their case. Lineage (``source_file``, ``file_path``) always comes from the file itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cordon.config import COLUMN_MAPS, UNIFIED_TYPES
from cordon.sources.manifest import plain_path

READ_ERRORS = (PySparkException, Py4JJavaError)
_WIDEST = {"int": T.LongType(), "double": T.DoubleType()}


def raw_schema(column_map: Mapping[str, str], time_type: T.DataType | None = None) -> T.StructType:
    """Mapped raw columns at their widest types."""
    out = T.StructType()
    for name, unified in column_map.items():
        kind = UNIFIED_TYPES[unified]
        out.add(name, _WIDEST.get(kind.simpleString(), time_type or kind))
    return out


def _time_type(spark: SparkSession, paths: list[str], column_map: Mapping[str, str]) -> T.DataType:
    """How these files store times (with or without zone): the reader does not convert between the two."""
    times = {n.lower() for n, u in column_map.items() if UNIFIED_TYPES[u].simpleString().startswith("timestamp")}
    for p in paths:
        try:
            found = [f.dataType for f in spark.read.parquet(p).schema if f.name.lower() in times]
        except READ_ERRORS:  # unreadable: file validation reports it
            continue
        if found:
            return found[0]
    return T.TimestampNTZType()


def read_trip_files(spark: SparkSession, path: str | list[str], taxi_type: str,
                    column_maps: Mapping[str, Mapping[str, str]] = COLUMN_MAPS) -> DataFrame:
    """Trip files of one type with lineage columns."""
    paths = [path] if isinstance(path, str) else list(path)
    column_map = column_maps[taxi_type]
    schema = raw_schema(column_map, _time_type(spark, paths, column_map))
    df = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)
    return df.withColumns({"source_file": F.col("_metadata.file_name"), "file_path": plain_path(F.col("_metadata.file_path"))})


def read_raw_sources(spark: SparkSession, paths: Mapping[str, str | list[str]],
                     column_maps: Mapping[str, Mapping[str, str]] = COLUMN_MAPS) -> dict[str, DataFrame]:
    """``{"yellow": path, "green": path}`` -> raw frames with lineage."""
    return {t: read_trip_files(spark, p, t, column_maps) for t, p in paths.items() if p}


def _lenient(spark: SparkSession):
    """A reader that gives the rows before the first damage of each file instead of an error."""
    return spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")


def row_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows per file, from the footers alone (no column is read). A file without rows or with a damaged
    footer has no row here; one job, however many files are damaged."""
    df = _lenient(spark).schema(T.StructType()).parquet(*paths)
    return df.groupBy(plain_path(F.col("_metadata.file_path")).alias("file_path")).agg(F.count(F.lit(1)).alias("rows_read"))


def readable_rows(spark: SparkSession, paths: Mapping[str, list[str]],
                  column_maps: Mapping[str, Mapping[str, str]] = COLUMN_MAPS) -> DataFrame:
    """Rows per file that can be read in all mapped columns: ``file_path, rows_readable, seen``. One job that
    decodes every page: ``seen`` is a checksum of all values, without which the columns would be left out."""
    out = None
    for t, ps in paths.items():
        if not ps:
            continue
        schema = raw_schema(column_maps[t], _time_type(spark, ps, column_maps[t]))
        rows = _lenient(spark).schema(schema).parquet(*ps)
        one = rows.select(plain_path(F.col("_metadata.file_path")).alias("file_path"), F.xxhash64(*schema.names).alias("h"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("file_path").agg(F.count("h").alias("rows_readable"), F.bit_xor("h").alias("seen"))


def _footer_state(batches):
    """What a small file is that gave no rows: empty, or the reason why its footer cannot be read."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    for batch in batches:
        said = []
        for content in batch.column(1):
            try:
                rows = pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata.num_rows
                said.append("empty" if rows == 0 else "footer cannot be read by the trip reader")
            except Exception as e:  # whatever the library says is the reason
                said.append(str(e).strip().splitlines()[0][:300] or "unreadable")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], names=["file_path", "reason"])


SMALL_FILE = 1 << 20  # a file without rows is little more than its footer


def file_states(spark: SparkSession, files: list, pages: bool = False,
                column_maps: Mapping[str, Mapping[str, str]] = COLUMN_MAPS) -> tuple[dict[str, int], dict[str, str]]:
    """Rows of each file by its footer, and the reason for each file that cannot be taken.

    ``files`` are rows with ``taxi_type, file_path, file_size``. Each step is one job over all files it
    concerns, whatever their number: the footers; a second try of those without rows, as a store's passing
    trouble is no damage; a closer look at the small ones among them; and with ``pages`` (after a failed
    read) a full decode of every file, again with a second try."""
    paths = [f["file_path"] for f in files]
    if not paths:
        return {}, {}
    rows = {r["file_path"]: r["rows_read"] for r in row_counts(spark, paths).collect()}  # one row a file
    odd = [p for p in paths if p not in rows]
    bad: dict[str, str] = {}
    if odd:
        rows.update({r["file_path"]: r["rows_read"] for r in row_counts(spark, odd).collect()})
        odd = [p for p in odd if p not in rows]
    if odd:
        size = {f["file_path"]: f["file_size"] for f in files}
        small = [p for p in odd if size[p] <= SMALL_FILE]
        bad = {p: "footer cannot be read" for p in odd}
        if small:
            looked = (spark.read.format("binaryFile").load(small).select(plain_path(F.col("path")).alias("file_path"), "content")
                      .repartition(min(len(small), 1000)).mapInArrow(_footer_state, "file_path string, reason string"))
            bad.update({r["file_path"]: r["reason"] for r in looked.collect()})
    if pages and rows:
        def short(asked: list[str]) -> dict[str, int]:
            by_type: dict[str, list[str]] = {}
            for f in files:
                if f["file_path"] in asked:
                    by_type.setdefault(f["taxi_type"], []).append(f["file_path"])
            got = {r["file_path"]: r["rows_readable"] for r in readable_rows(spark, by_type, column_maps).collect()}
            return {p: got.get(p, 0) for p in asked if got.get(p, 0) < rows[p]}

        found = short(sorted(rows))
        found = short(sorted(found)) if found else found
        bad.update({p: f"only {n} of {rows[p]} rows can be read" for p, n in found.items()})
    return rows, bad


def read_zones(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Zone attribute table (``LocationID``, ``zone``, ``borough``); geometry is not needed."""
    reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path)
    return df.select(F.col("LocationID").cast("int").alias("LocationID"), "zone", "borough")


def read_weather(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Daily weather; a ``time`` column is taken as the date."""
    reader = spark.read.option("header", "true").option("inferSchema", "true") if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path)
    if "time" in df.columns and "date" not in df.columns:
        df = df.withColumnRenamed("time", "date")
    return df.withColumn("date", F.to_date("date"))
