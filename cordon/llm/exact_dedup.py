"""Exact deduplication by content sort, with Spark expressions only.

Texts are equal if they are identical after lower-casing A-Z. Sampled splitters cut the order of
(normalised text, id) into buckets; Spark shuffles each text once, to its bucket, and sorts there
(spilling to disk), so equal texts lie next to each other. Each row is compared in full with its
neighbour; rows of a run have the same text.

The id is part of the key, so a text that a third of all rows share is cut into several buckets. Only
a text that begins like a splitter (its first ``KEY_CHARS`` characters) can lie in several buckets;
of such texts one row per bucket and run meets again, grouped by the full text.

Of equal texts the row with the largest id stays; of rows that share it too, the one with the largest
hash of all its columns. Edge cases: null text is empty and null ids sort below all others (``keep_id``
is null only if all ids of the group are); repeated rows form a group of which one stays; an empty
table gives no rows; other columns only take part in the last tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cordon.llm.ranges import KEY_CHARS, bucket_of, meets_bound, sampled_splitters
from cordon.llm.shared import cut, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST = -(1 << 63)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def _ordered(docs: DataFrame, text_col: str, carried: list[str] | None = None) -> DataFrame:
    """Rows (``doc``, the carried columns, or all) with their bucket, normalised text, place in the bucket, and whether a new text begins or
    the bucket's last row of a text is reached."""
    norm = ascii_lower(text_or_empty(text_col))
    key = F.substring(norm, 1, KEY_CHARS)
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    splitters = sampled_splitters(docs, key, ident, docs.count())
    tie = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
    dealt = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried or docs.columns]).alias("doc"), tie.alias("_tie"),
                        bucket_of(key, ident, splitters).alias("_bucket")).repartition("_bucket")
    dealt = dealt.withColumn("doc_id", F.col("doc")["doc_id"].cast("long")) \
        .withColumn("_norm", ascii_lower(F.coalesce(F.col("doc")[text_col].cast("string"), F.lit("")))).withColumn(
        "_edge", meets_bound(F.substring("_norm", 1, KEY_CHARS), F.col("_bucket"), splitters))
    order = Window.partitionBy("_bucket").orderBy("_norm", F.col("doc_id").asc_nulls_first(), "_tie")
    before, after = F.lag("_norm").over(order), F.lead("_norm").over(order)
    return (dealt.withColumn("_first", before.isNull() | (before != F.col("_norm")))
            .withColumn("_last", after.isNull() | (after != F.col("_norm")))
            .withColumn("_row", F.row_number().over(order)))


def exact_groups(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = cut(_ordered(docs, text_col, ["doc_id", text_col]).select(
        "doc_id", "_bucket", "_row", "_first", "_last", "_tie",
        F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"), "_edge",
        F.when(F.col("_edge") & F.col("_first"), F.col("_norm")).alias("_norm")), "sorted")
    run = F.max(F.when(F.col("_first"), F.col("_row"))).over(Window.partitionBy("_bucket").orderBy("_row"))
    in_run = Window.partitionBy("_bucket", "_run")
    runs = (rows.withColumn("_run", run)
            .withColumn("_max", F.max("doc_id").over(in_run)).withColumn("_n", F.count(F.lit(1)).over(in_run))
            .withColumn("_max_tie", F.max(F.when(F.col("_last"), F.col("_tie"))).over(in_run)))
    same = Window.partitionBy("_text")
    best = F.struct(F.coalesce("_max", F.lit(LEAST)), "_max_tie", "_b")
    across = (runs.filter(F.col("_edge") & F.col("_first"))
              .select(F.col("_bucket").alias("_b"), F.col("_run").alias("_r"), F.col("_norm").alias("_text"), "_max",
                      "_max_tie", "_n")
              .select("_b", "_r", F.max("_max").over(same).alias("_all_max"), F.sum("_n").over(same).alias("_all_n"),
                      (F.max(best).over(same)["_b"] == F.col("_b")).alias("_here")))
    return (runs.join(across, (F.col("_bucket") == F.col("_b")) & (F.col("_run") == F.col("_r")), "left")
            .select("doc_id",
                    F.when(F.col("_b").isNotNull(), F.col("_all_max")).otherwise(F.col("_max")).alias("keep_id"),
                    F.coalesce("_all_n", "_n").cast("long").alias("group_size"),
                    (F.col("_last") & F.coalesce("_here", F.lit(True))).alias("kept"), "text_sha256"))


def keep_one(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    left = cut(_ordered(docs, text_col).filter("_last").select("doc", "doc_id", "_tie", "_edge"), "last-of-bucket")
    norm = ascii_lower(F.coalesce(F.col("doc")[text_col].cast("string"), F.lit("")))
    rank = F.struct(F.coalesce("doc_id", F.lit(LEAST)), F.col("_tie"))
    across = left.filter("_edge").groupBy(norm.alias("norm")).agg(F.max_by("doc", rank).alias("doc")).select("doc")
    kept = left.filter(~F.col("_edge")).select("doc").unionByName(across)
    return kept.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
