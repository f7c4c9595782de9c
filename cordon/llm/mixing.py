"""Mixing sources to target weights with hash-threshold histograms.

Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share the corpus's words in
that proportion. A target stops at ``MAX_EPOCHS`` times its source's size and the excess is shared
again by weight among the others until none is above (``targets``; one row a source).

A source whose target is q times its size and some words more takes every document q times, and once
more the documents whose hash lies under the source's threshold. Thresholds are nested: a smaller
budget takes a subset of what a larger one takes. No document is sorted to find them. The hash has
60 bits, read as five digits of 12 bits; a histogram of words by (source, first digit) shows the
digit in which the budget runs out, and only that boundary bucket is refined by its next digit. At
the last digit a bucket is one hash value, that is one document id; it is taken too if that brings
the source nearer to its target.

Edge cases: null text has size 0; rows that share an id have one hash and are taken alike; documents
without words have ``taken`` 0 and are repeated like any other of their source; an empty table gives
no rows; a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cordon.llm.shared import cut

WEIGHTS = (1.0, 2.0, 3.0)
MAX_EPOCHS = 3
DIGITS = 5
DIGIT_BITS = 12
BROADCAST_SOURCES = 100_000


def word_count(col: Column) -> Column:
    return F.coalesce(F.regexp_count(col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit_hash(col: Column) -> Column:
    """60 bits of the id's MD5 as a whole number; null counts as empty."""
    digest = F.md5(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> list[float]:
    """Words to take of each source (given in order): shares by weight, capped, the excess reshared."""
    share = {i: weights[i % len(weights)] for i in range(len(sizes))}
    out: dict[int, float] = {}
    budget = float(sum(n for _, n in sizes))
    while len(out) < len(sizes):
        free = [i for i in share if i not in out]
        per_weight = budget / sum(share[i] for i in free)
        over = [i for i in free if share[i] * per_weight > max_epochs * sizes[i][1]]
        if not over:
            return [out[i] if i in out else share[i] * per_weight for i in range(len(sizes))]
        for i in over:
            out[i] = float(max_epochs * sizes[i][1])
            budget -= out[i]
    return [out[i] for i in range(len(sizes))]


def _digit(hash_col: Column, k: int) -> Column:
    return F.shiftright(hash_col, DIGIT_BITS * (DIGITS - 1 - k)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def mix_plan(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, text_col: str = "text",
             ) -> tuple[DataFrame, DataFrame]:
    """Sizes of the documents (a written table) and the plan: one row a source with its size, target,
    whole epochs and hash threshold."""
    spark = docs.sparkSession
    sized = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                            word_count(F.col(text_col).cast("string")).alias("size"),
                            unit_hash(F.col("doc_id")).alias("hash")), "sized")
    totals = [(r["source"], int(r["n"])) for r in  # one row a source
              sized.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    totals.sort(key=lambda s: (s[0] is None, (s[0] or "").encode()))
    plan, left = [], []
    for (source, n), target in zip(totals, targets(totals, weights, max_epochs)):
        epochs = min(max_epochs, int(target // n)) if n else 0
        plan.append((source, n, target, epochs))
        left.append((source, target - epochs * n, 0))

    def frame(rows, schema):
        df = spark.createDataFrame(rows, schema)
        return F.broadcast(df) if len(rows) <= BROADCAST_SOURCES else df

    for k in range(DIGITS):
        bounds = frame(left, "s string, budget double, prefix long")
        inside = sized.join(bounds, F.col("source").eqNullSafe(F.col("s")))
        if k:
            inside = inside.filter(F.shiftright("hash", DIGIT_BITS * (DIGITS - k)) == F.col("prefix"))
        buckets = (inside.groupBy("source", "budget", "prefix", _digit(F.col("hash"), k).alias("digit"))
                   .agg(F.sum("size").alias("n")))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("digit"))
        # the first bucket in which the budget runs out; a source without one takes all that is there
        found = {r["source"]: r for r in
                 buckets.withColumn("upto", upto).filter(F.col("upto") > F.col("budget"))
                 .groupBy("source").agg(F.min_by(F.struct("digit", "upto", "n"), "digit").alias("b"))
                 .select("source", "b.*").collect()}  # one row a source
        step = []
        for source, budget, prefix in left:
            r = found.get(source)
            if r is None:
                step.append((source, float("inf"), (prefix << DIGIT_BITS) | ((1 << DIGIT_BITS) - 1)))
            else:
                step.append((source, budget - (r["upto"] - r["n"]), (prefix << DIGIT_BITS) | r["digit"]))
        left = step
    # left: the hash value in which each source's budget runs out, and the words that are left for it
    bounds = frame(left, "s string, budget double, prefix long")
    last = {r["source"]: r["n"] for r in
            sized.join(bounds, F.col("source").eqNullSafe(F.col("s")) & (F.col("hash") == F.col("prefix")))
            .groupBy("source").agg(F.sum("size").alias("n")).collect()}  # one row a source
    ends = {source: (value if budget >= last.get(source, 0) / 2 else value - 1) for source, budget, value in left}
    return sized, frame([(*p, ends[p[0]]) for p in plan],
                        "s string, source_size long, target double, epochs long, threshold long")


def _copies(hash_col: Column, max_epochs: int) -> Column:
    again = (hash_col <= F.col("threshold")) & (F.col("epochs") < max_epochs)
    return (F.col("epochs") + F.when(again, 1).otherwise(0)).cast("long")


def mix_rows(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``."""
    sized, plan = mix_plan(docs, weights, max_epochs, text_col)
    return (sized.join(plan, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("copies", _copies(F.col("hash"), max_epochs))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def take_mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, text_col: str = "text") -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, with its columns. The plan and a
    document's own id decide, so the texts are not shuffled."""
    plan = mix_plan(docs, weights, max_epochs, text_col)[1]
    rows = docs.select(F.col("source").cast("string").alias("of"), unit_hash(F.col("doc_id").cast("long")).alias("hash"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    copies = F.array_repeat(F.lit(1), _copies(F.col("hash"), max_epochs).cast("int"))
    return (rows.join(plan, F.col("of").eqNullSafe(F.col("s"))).select("doc", F.explode(copies).alias("copy"))
            .select(*[F.col("doc")[c].alias(c) for c in docs.columns]))
