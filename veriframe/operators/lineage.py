"""Which containers a computed container reads, directly and through others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.session import durable


def lineage_edges(containers: DataFrame) -> DataFrame:
    """``child, parent`` from source, left, right and the SQL-mode sources."""
    single = [c for c in ("source_name", "left_name", "right_name") if c in containers.columns]
    refs = F.array(*[F.col(c) for c in single]).cast("array<string>")
    if "sources" in containers.columns:
        named = F.transform(F.coalesce("sources", F.array()), lambda s: s["container"])
        refs = F.concat(refs, named)
    return (
        containers.select(F.col("name").alias("child"), F.explode(refs).alias("parent"))
        .filter(F.col("parent").isNotNull())
        .distinct()
    )


def lineage_closure(edges: DataFrame) -> DataFrame:
    """``child, ancestor, depth`` for all reachable ancestors, shortest depth.

    A round doubles the length that is known: a shortest path of up to twice 2 ** k steps is one of exactly 2 ** k, followed by one
    that is known, so the pairs at that depth are joined with all pairs. Rounds grow with the logarithm of the
    depth, the pairs they make with the result. Each is written to reliable storage. Cycles end by themselves, as no
    new pair is at the next power of two. A container that very many others read is a hot key of the step: both inputs of
    that join are plain shuffles, so adaptive execution splits it.
    """
    closed = durable(edges.select("child", "parent").distinct().withColumn("depth", F.lit(1)), "lineage")
    step = 1
    while True:
        first = closed.filter(F.col("depth") == step).select("child", F.col("parent").alias("_via"))
        if first.isEmpty():
            return closed.withColumnRenamed("parent", "ancestor")
        then = closed.select(F.col("child").alias("_from"), "parent", F.col("depth").alias("_more"))
        longer = first.join(then, first["_via"] == then["_from"]).groupBy("child", "parent").agg((F.min("_more") + step).alias("depth"))
        known = closed.select(F.col("child").alias("_c"), F.col("parent").alias("_p"))
        fresh = longer.join(known, (longer["child"] == known["_c"]) & (longer["parent"] == known["_p"]), "left_anti")
        closed = closed.unionByName(durable(fresh, "lineage"))
        step *= 2
