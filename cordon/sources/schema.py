"""Unified-schema check (S13) with the row count of the table.

One row per expected column: whether it is present, its type, whether the type is the expected one,
and how many non-null values it holds over the whole table (one aggregation pass).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from cordon.config import COLUMN_MAPS, UNIFIED_COLUMNS, UNIFIED_TYPES

_FAMILY = {"timestamp_ntz": "timestamp", "timestamp": "timestamp", "int": "integer", "integer": "integer", "double": "double"}


def type_family(simple_name: str) -> str:
    return _FAMILY.get(simple_name, simple_name)


def schema_check(df: DataFrame) -> DataFrame:
    actual = set(df.columns)
    return _checked(df, df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[
            (F.count(F.col(c)) if c in actual else F.lit(0).cast("long")).alias(f"nn_{i}")
            for i, c in enumerate(UNIFIED_COLUMNS)
        ],
    ))


def schema_check_from_files(stored: DataFrame, files: DataFrame) -> DataFrame:
    """The same for a stored trip table whose file hub is known: the schema is the table's, the counts are the
    hub's (a stored trip has all required columns)."""
    n = {"trip_distance": "distance_n", "fare": "fare_n", "total_amount": "total_n", "congestion_surcharge": "surcharge_n"}
    none = F.lit(0).cast("long")
    return _checked(stored, files.agg(
        F.coalesce(F.sum("trip_count"), none).alias("row_count"),
        *[F.coalesce(F.sum(n.get(c, "trip_count")), none).alias(f"nn_{i}") for i, c in enumerate(UNIFIED_COLUMNS)]))


def _checked(df: DataFrame, counts: DataFrame) -> DataFrame:
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for i, c in enumerate(UNIFIED_COLUMNS):
        exp = type_family(UNIFIED_TYPES[c].simpleString())
        act = type_family(actual[c]) if c in actual else None
        rows.append(F.struct(
            F.lit(i + 1).alias("ordinal"),
            F.lit(c).alias("column_name"),
            F.lit(exp).alias("expected_type"),
            F.lit(act).cast("string").alias("actual_type"),
            F.lit(c in actual).alias("is_present"),
            F.lit(act == exp).alias("type_ok"),
            F.col(f"nn_{i}").alias("non_null_count"),
        ))
    return counts.select("row_count", F.inline(F.array(*rows))).select(
        "ordinal", "column_name", "expected_type", "actual_type", "is_present", "type_ok", "non_null_count", "row_count"
    )


def raw_schema_check(raw_by_type: Mapping[str, DataFrame],
                     column_maps: Mapping[str, Mapping[str, str]] = COLUMN_MAPS) -> DataFrame:
    """One row per type and mapped raw column, before any cast: is it there, has it the unified type, how
    many values does it hold. A column of another type is cast later; one that is missing becomes NULL."""
    out = None
    for t, df in raw_by_type.items():
        actual = {f.name.lower(): f for f in df.schema.fields}
        names = list(column_maps[t])
        counts = df.agg(F.count(F.lit(1)).alias("row_count"), *[
            (F.count(F.col(f"`{actual[c.lower()].name}`")) if c.lower() in actual else F.lit(0).cast("long")).alias(f"nn_{i}")
            for i, c in enumerate(names)])
        rows = []
        for i, c in enumerate(names):
            exp = type_family(UNIFIED_TYPES[column_maps[t][c]].simpleString())
            act = type_family(actual[c.lower()].dataType.simpleString()) if c.lower() in actual else None
            rows.append(F.struct(F.lit(t).alias("taxi_type"), F.lit(c).alias("column_name"), F.lit(exp).alias("expected_type"),
                                 F.lit(act).cast("string").alias("actual_type"), F.lit(act is not None).alias("is_present"),
                                 F.lit(act == exp).alias("type_ok"), F.col(f"nn_{i}").alias("non_null_count")))
        one = counts.select("row_count", F.inline(F.array(*rows)))
        out = one if out is None else out.unionByName(one)
    return out.select("taxi_type", "column_name", "expected_type", "actual_type", "is_present", "type_ok",
                      "non_null_count", "row_count")
