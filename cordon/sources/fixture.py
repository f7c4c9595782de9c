"""Projection of the driver tables onto trip, zone and weather shapes (FIXTURES.md).

One lineitem row is one trip; ``l_linestatus`` 'O' is a yellow trip and 'F' a green one. The raw
frames carry the raw column names of each taxi type so that unification starts from two schemas.
All joins are plain equi-joins: Spark sizes them at run time (AQE) and broadcasts a side only when
its measured size is under the threshold; otherwise they shuffle on the key. Orders meet their customers
first, on two columns, so the trip rows, which are most of the bytes, shuffle once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cordon.config import COLUMN_MAPS, TRIP_FILE_FORMAT, UNIFIED_COLUMNS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _seconds(ts: Column, n: Column) -> Column:
    return F.timestamp_add("SECOND", n, ts)


def trips(spark: SparkSession, sf_dir: str, taxi_type: str | None = None) -> DataFrame:
    """Trips in unified names plus ``taxi_type``; restricted to one type when given."""
    li = _table(spark, sf_dir, "lineitem")
    if taxi_type is not None:
        li = li.filter(F.col("l_linestatus") == ("O" if taxi_type == "yellow" else "F"))
    start = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101) % 86400
    lasts = (F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber") * 53) % 3600 - 20
    fare = F.col("l_extendedprice") / 1000
    # These come out of a generator: of plain columns the optimizer copies the arithmetic into every use by the
    # filters that it pushes below the joins, until the generated method is too long for the JVM to compile.
    li = li.select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
        F.inline(F.array(F.struct(
            F.when(F.col("l_linestatus") == "O", F.lit("yellow")).otherwise(F.lit("green")).alias("taxi_type"),
            _seconds(F.col("l_shipdate"), start).alias("pickup_time"),
            _seconds(F.col("l_shipdate"), start + lasts).alias("dropoff_time"),
            F.when(F.col("l_orderkey") % 25 == 0, -fare).otherwise(fare).alias("fare")))),
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    joined = (
        li.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.select(
        "taxi_type",
        "pickup_time",
        "dropoff_time",
        F.col("s_nationkey").cast("int").alias("pickup_loc"),
        F.col("c_nationkey").cast("int").alias("dropoff_loc"),
        ((F.col("l_quantity") - 1) / 4).alias("trip_distance"),
        "fare",
        (F.col("fare") * (1 + F.col("l_tax"))).alias("total_amount"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("double"))
        .when(F.col("l_tax") == 0, F.lit(0.0))
        .otherwise(F.lit(2.5))
        .alias("congestion_surcharge"),
    )


def source_file_name(taxi_type: Column, ts: Column) -> Column:
    """Lineage label in the naming of monthly trip files, e.g. ``yellow_tripdata_2000-01.parquet``."""
    return F.format_string(TRIP_FILE_FORMAT, taxi_type, F.year(ts), F.month(ts))


def raw_trips(spark: SparkSession, sf_dir: str, taxi_type: str) -> DataFrame:
    """Raw frame of one taxi type: raw column names and a ``source_file`` lineage column."""
    t = trips(spark, sf_dir, taxi_type)
    inverse = {dst: src for src, dst in COLUMN_MAPS[taxi_type].items()}
    return t.select(
        *[F.col(c).alias(inverse[c]) for c in UNIFIED_COLUMNS],
        source_file_name(F.col("taxi_type"), F.col("pickup_time")).alias("source_file"),
    )


def raw_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of all types in one frame (one read of the trip table): the raw columns of every type, of
    which a row fills its own type's, ``taxi_type`` and the lineage column."""
    t = trips(spark, sf_dir)
    cols = {}
    for kind, column_map in COLUMN_MAPS.items():
        for raw_name, unified in column_map.items():
            cols.setdefault(raw_name, []).append((kind, unified))
    out = []
    for raw_name, uses in cols.items():
        if len(uses) == len(COLUMN_MAPS):
            out.append(F.col(uses[0][1]).alias(raw_name))
        else:
            kind, unified = uses[0]
            out.append(F.when(F.col("taxi_type") == kind, F.col(unified)).alias(raw_name))
    return t.select(*out, "taxi_type", source_file_name(F.col("taxi_type"), F.col("pickup_time")).alias("source_file"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: ``LocationID``, ``zone``, ``borough``."""
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("int").alias("LocationID"),
        F.col("n_name").alias("zone"),
        F.col("r_name").alias("borough"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather: ``date``, ``prcp`` (mm, nullable), ``tavg``."""
    orders = _table(spark, sf_dir, "orders")
    daily = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.min("o_orderkey").alias("_first_key"),
        F.count_if(F.col("o_orderpriority").like("1%")).alias("_urgent"),
        F.count(F.lit(1)).alias("_n"),
        F.avg("o_totalprice").alias("_avg_price"),
    )
    return daily.select(
        "date",
        F.when(F.col("_first_key") % 10 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(5.0) * F.col("_urgent") / F.col("_n"))
        .alias("prcp"),
        (F.col("_avg_price") / 10000).alias("tavg"),
    )
