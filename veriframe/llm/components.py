"""Connected components of an edge table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.session import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it is linked to.

    Each round takes the smallest label among a node's neighbours and then the label of that
    label, so labels cross a component in about as many rounds as its diameter has binary
    digits. Rounds are written to the shared folder; no label reaches the driver. Null ends
    and loops are left out.
    """
    kept = edges.filter(F.col("a") != F.col("b")).select("a", "b")
    both = durable(kept.unionByName(kept.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_near"))
        )
        pulled = labels.join(near, "node").select(
            "node", F.col("root").alias("_old"), F.least("root", "_near").alias("_new")
        )
        jump = labels.select(F.col("node").alias("_new"), F.col("root").alias("_beyond"))
        moved = pulled.join(jump, "_new").select(
            "node", F.least("_new", "_beyond").alias("root"), (F.least("_new", "_beyond") != F.col("_old")).alias("_moved")
        )
        moved = durable(moved, "labels")
        labels = moved.select("node", "root")
        if moved.filter("_moved").isEmpty():
            return labels
