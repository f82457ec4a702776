"""Connected components of an edge table, by least label and pointer jumping; nothing leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of `edges` (a, b); label is the least node that is reachable.

    Each turn every node takes the least label among its own and its neighbours', then the label of that label. A
    star settles in two turns, a chain in about the logarithm of its length.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where("a <> b").distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
                .withColumnRenamed("a", "node"))
        step = labels.join(near, "node").select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        # Labels are nodes themselves, so the label of a label is found in the same table.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = staged(step.join(jump, "label").select("node", F.least("label", "further").alias("label"), "old"), "labels")
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return labels
