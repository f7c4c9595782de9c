"""Range buckets from sampled splitters, as Spark expressions.

A key is a pair (text, id); keys are compared as Spark compares strings and numbers. Splitters are
quantiles of a bounded sample, so the buckets hold about as many rows each even if a third of all
rows share one text, which the id then divides.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from cordon.llm.shared import parallelism

BUCKETS_PER_PARTITION = 4
MAX_BUCKETS = 32768
SAMPLE_PER_BUCKET = 12
KEY_CHARS = 64
SPLITTERS = "array<struct<t:string,i:long>>"


def bucket_count(df: DataFrame) -> int:
    return min(MAX_BUCKETS, BUCKETS_PER_PARTITION * parallelism(df.sparkSession))


def sampled_splitters(df: DataFrame, text: Column, ident: Column, rows: int) -> list[tuple[str, int]]:
    """At most ``MAX_BUCKETS - 1`` ascending keys that cut the rows into about equal parts. They decide
    only where a row is worked on. The sample has at most about SAMPLE_PER_BUCKET * MAX_BUCKETS keys."""
    n = bucket_count(df)
    if rows == 0:
        return []
    share = min(1.0, SAMPLE_PER_BUCKET * n / rows)
    drawn = sorted((r["t"], r["i"]) for r in df.select(text.alias("t"), ident.alias("i")).sample(share, seed=7).collect())
    if not drawn:
        return []
    return sorted({drawn[len(drawn) * k // n] for k in range(1, n)})


def splitter_array(splitters: list[tuple[str, int]]) -> Column:
    return F.from_json(F.lit(json.dumps([{"t": t, "i": i} for t, i in splitters])), SPLITTERS)


def bucket_of(text: Column, ident: Column, splitters: list[tuple[str, int]]) -> Column:
    """How many splitters are at or below the key: a binary search in the array."""
    if not splitters:
        return F.lit(0)
    cuts = splitter_array(splitters)
    key = F.struct(text.alias("t"), ident.alias("i"))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splitters)).alias("hi"))

    def step(span: Column, _: Column) -> Column:
        mid = F.floor((span["lo"] + span["hi"]) / 2).cast("int")
        return F.when(span["lo"] >= span["hi"], span) \
            .when(F.get(cuts, mid) <= key, F.struct((mid + 1).alias("lo"), span["hi"].alias("hi"))) \
            .otherwise(F.struct(span["lo"].alias("lo"), mid.alias("hi")))

    steps = F.sequence(F.lit(1), F.lit(len(splitters).bit_length()))
    return F.aggregate(steps, start, step, lambda span: span["lo"])


def meets_bound(text: Column, bucket: Column, splitters: list[tuple[str, int]]) -> Column:
    """Whether the text is that of a splitter next to its bucket: only then rows of the same text may
    lie in other buckets."""
    if not splitters:
        return F.lit(False)
    cuts = splitter_array(splitters)
    return F.coalesce(F.get(cuts, bucket - 1)["t"] == text, F.lit(False)) | \
        F.coalesce(F.get(cuts, bucket)["t"] == text, F.lit(False))
