"""Connected components of a graph given as edges, by minimum labels with pointer jumping.

Every node starts with its own label. In a round a node takes the smallest label among its
neighbours' and its own, and then the label of that label's node, so paths shorten by half. Rounds
are written tables (no lineage grows) and end when no label changes; labels are aggregated before the
shuffle, so a hub with a third of all edges is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cordon.llm.shared import cut

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (columns ``a`` and ``b``); the label is the smallest
    node of the component. An empty table gives no rows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) \
        .filter(F.col("a") != F.col("b")).distinct()
    both = cut(both, "edges")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                 .select("node", F.least("node", "m").alias("label")), "labels")
    for _ in range(MAX_ROUNDS):
        near = (both.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("node"))
                .agg(F.min("label").alias("m")))
        step = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        step = cut(step.join(jump, F.col("label") == F.col("at"), "left")
                   .select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = step.select("node", "label")
        if step.filter(F.col("was") != F.col("label")).isEmpty():
            return labels
    raise RuntimeError(f"no fixed labels after {MAX_ROUNDS} rounds")
