"""Compare a Spark result with the DuckDB oracle: row count, column names, type families,
order-insensitive values."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


_SPARK_KINDS = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "float": "float", "double": "float",
                "boolean": "bool", "string": "text", "date": "date", "timestamp": "time", "timestamp_ntz": "time"}
_DUCK_KINDS = {"TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int", "HUGEINT": "int", "FLOAT": "float",
               "DOUBLE": "float", "BOOLEAN": "bool", "VARCHAR": "text", "DATE": "date", "TIMESTAMP": "time",
               "TIMESTAMP WITH TIME ZONE": "time"}


def _kinds_differ(spark_df, res) -> list:
    duck = {c[0]: _DUCK_KINDS.get(str(c[1]), str(c[1]).lower()) for c in res.description}
    own = {n: _SPARK_KINDS.get(t, t) for n, t in spark_df.dtypes}
    return [(n, own[n], duck[n]) for n in own if n in duck and own[n] != duck[n]]


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols), "types_differ": _kinds_differ(spark_df, res),
    }
    if not out["columns_match"]:
        out["columns_spark"], out["columns_oracle"] = sorted(s_cols), sorted(d_cols)
        out["values_match"] = False
        return out
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["values_match"] = a == b
    if not out["values_match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
    return out
