"""Sync: which containers a store has, and how that differs from the registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _excluded(name: Column, exact: Sequence[str], prefixes: Sequence[str]) -> Column:
    hit = name.isin(list(exact)) if exact else F.lit(False)
    for prefix in prefixes:
        hit = hit | name.startswith(prefix)
    return hit


def discover_files(
    spark: SparkSession,
    root: str,
    include: Sequence[str] = ("table", "view", "file"),
    exclude: Sequence[str] = (),
    exclude_prefixes: Sequence[str] = (),
    suffix: str = ".parquet",
) -> DataFrame:
    """File containers below ``root``: name, files, bytes and last modification.

    The listing runs as a Spark source; no file content is read. A container is
    one file or one folder of part files, named by the first step below root.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "modificationTime", "length")
    )
    base = F.lit(root.rstrip("/").split("://")[-1] + "/")
    step = F.substring_index(F.split_part(F.col("path"), base, F.lit(-1)), "/", 1)
    found = files.withColumn("entry", step).filter(F.col("entry").endswith(suffix))
    name = F.substring(F.col("entry"), F.lit(1), F.length("entry") - len(suffix))
    out = (
        found.withColumn("name", name)
        .filter(~_excluded(F.col("name"), exclude, exclude_prefixes))
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("last_modified"),
        )
        .withColumn("container_type", F.lit("file"))
    )
    return out.filter(F.col("container_type").isin(list(include)))


def discover_tables(
    spark: SparkSession,
    namespace: str,
    include: Sequence[str] = ("table", "view", "file"),
    exclude: Sequence[str] = (),
    exclude_prefixes: Sequence[str] = (),
) -> DataFrame:
    """Tables and views of a catalog namespace, system namespaces left out."""
    tables = spark.sql(f"SHOW TABLES IN {namespace}").select(
        F.col("namespace"), F.col("tableName").alias("name")
    )
    views = spark.sql(f"SHOW VIEWS IN {namespace}").select(
        F.col("viewName").alias("name"), F.lit("view").alias("kind")
    ).distinct()
    out = (
        tables.join(views, "name", "left")
        .withColumn("container_type", F.coalesce("kind", F.lit("table")))
        .drop("kind")
    )
    return out.filter(
        ~_excluded(F.col("namespace"), exclude, exclude_prefixes)
        & F.col("container_type").isin(list(include))
    )


def sync_diff(
    discovered: DataFrame, registry: DataFrame, prune: bool = False, recreate: bool = False
) -> DataFrame:
    """``name, state, action`` per container name of either side.

    Missing containers stay registered unless ``prune``; ``recreate`` drops every
    registered container and creates every discovered one.
    """
    found = discovered.select("name").distinct().withColumn("_found", F.lit(True))
    known = registry.select("name").distinct().withColumn("_known", F.lit(True))
    both = found.join(known, "name", "full")
    state = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("_found").isNull(), "missing")
        .otherwise("kept")
    )
    if recreate:
        action = (
            F.when(F.col("state") == "new", "create")
            .when(F.col("state") == "missing", "drop")
            .otherwise("recreate")
        )
    else:
        action = (
            F.when(F.col("state") == "new", "create")
            .when(F.col("state") == "missing", F.lit("drop" if prune else "keep"))
            .otherwise("keep")
        )
    return both.select("name", state.alias("state")).withColumn("action", action)
