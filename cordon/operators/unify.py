"""Schema unification.

Each taxi type has its own raw column names; a column map renames and casts them to the unified
schema, and a unified column missing from the map (or from the files) becomes a typed NULL. Rows
without both times and both locations are dropped. The result is a narrow projection, so the scan
reads only the mapped columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from cordon.config import COLUMN_MAPS, REQUIRED_COLUMNS, UNIFIED_COLUMNS, UNIFIED_TYPES

LINEAGE_COLUMNS = ("source_file", "file_path", "file_size", "modified")


def unify(raw: DataFrame, column_map: Mapping[str, str], taxi_type: str,
          keep_lineage: bool = True) -> DataFrame:
    """Rename and cast ``raw`` to the unified schema, add ``taxi_type``, drop incomplete rows."""
    by_target = {dst: src for src, dst in column_map.items()}
    present = set(raw.columns)
    cols = []
    for name in UNIFIED_COLUMNS:
        src = by_target.get(name)
        dtype = UNIFIED_TYPES[name]
        if src is not None and src in present:
            cols.append(F.col(src).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    cols.append(F.lit(taxi_type).alias("taxi_type"))
    if keep_lineage:
        cols += [F.col(c) for c in LINEAGE_COLUMNS if c in present]
    # Filter after the projection: the predicate is on the renamed columns, as in the audited SQL.
    return raw.select(*cols).dropna(how="any", subset=list(REQUIRED_COLUMNS))


def unify_tagged(raw: DataFrame, column_maps: Mapping[str, Mapping[str, str]] = COLUMN_MAPS,
                 type_col: str = "taxi_type") -> DataFrame:
    """Unify one raw table that holds the rows and columns of several types, told apart by ``type_col``:
    each unified column comes from its row's type. One scan instead of one a type."""
    present = set(raw.columns)
    cols = []
    for name in UNIFIED_COLUMNS:
        types_of: dict[str, list[str]] = {}
        for t, column_map in column_maps.items():
            src = {dst: src for src, dst in column_map.items()}.get(name)
            if src in present:
                types_of.setdefault(src, []).append(t)
        value = F.lit(None).cast(UNIFIED_TYPES[name])
        for src, types in types_of.items():  # a raw column is named once, however many types share it
            value = F.when(F.col(type_col).isin(types), F.col(src).cast(UNIFIED_TYPES[name])).otherwise(value)
        cols.append(value.alias(name))
    cols += [F.col(type_col).alias("taxi_type"), *[F.col(c) for c in LINEAGE_COLUMNS if c in present]]
    return raw.select(*cols).dropna(how="any", subset=list(REQUIRED_COLUMNS))


def unify_all(raw_by_type: Mapping[str, DataFrame], column_maps: Mapping[str, Mapping[str, str]] = COLUMN_MAPS,
              keep_lineage: bool = True) -> DataFrame:
    """Unify every taxi type and stack them (a UNION ALL, no shuffle)."""
    frames = [unify(df, column_maps[t], t, keep_lineage) for t, df in raw_by_type.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
