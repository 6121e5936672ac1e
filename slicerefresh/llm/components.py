"""Connected components of an edge table, by label propagation and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicerefresh.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` (the smallest node of its component) for all nodes of ``edges(a, b)``.

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label.  Labels only fall, and a round without a change
    ends it; rounds grow with the logarithm of the length of chains of falling
    labels.  All steps are joins and partial aggregates.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "cc-labels")
    while True:
        near = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "comp").unionByName(labels)
        lower = near.groupBy("node").agg(F.min("comp").alias("comp"))
        jump = labels.select(F.col("node").alias("j_node"), F.col("comp").alias("j_comp"))
        stepped = lower.join(jump, F.col("comp") == F.col("j_node")).select("node", F.least("comp", "j_comp").alias("comp"))
        new = written(stepped, "cc-labels")
        old = labels.withColumnRenamed("comp", "old")
        changed = new.join(old, "node").filter("comp <> old").isEmpty()
        labels = new
        if changed:
            return labels
