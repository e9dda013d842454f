"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import discard, join_groups, materialise


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, label), written: the smallest node of each node's component.

    A round gives each node the least label around it and then its label's label, so paths
    shorten by half a round.  Labels are written each round; no label or edge leaves Spark.
    Hubs (of edges or of labels) are joined apart, as in ``join_groups``."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(both.distinct(), "edges")
    n = edges.count()
    # edges are symmetric: as many with b = node as with a = node
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("label"), F.count(F.lit(1)).alias("degree")), "labels")
    while True:
        near = (join_groups(edges, labels.withColumnRenamed("node", "b"), "b", "degree", n)
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = materialise(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"),
                                                            "degree"), "step")
        heads = step.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
        jump = materialise(heads.join(step.select(F.col("node").alias("label"), F.col("label").alias("next")), "label"), "jump")
        moved = materialise(join_groups(step, jump, "label", "size", n)
                            .select("node", "old", F.col("next").alias("label"), "degree"), "moved")
        discard(labels, step, jump)
        labels = moved
        if moved.filter(F.col("old") != F.col("label")).limit(1).count() == 0:
            discard(edges)
            return moved.select("node", "label")
