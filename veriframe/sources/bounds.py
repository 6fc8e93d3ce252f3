"""Row counts, partition bounds and schema inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def partition_bounds(df: DataFrame, col: str, n: int = 3) -> DataFrame:
    """``n`` equal-width ranges of a numeric or time column, with their row counts.

    The width is ``(max - min) / n``; for times it is taken in whole seconds.
    Ranges are half open but for the last; nulls belong to none.
    """
    kind = df.schema[col].dataType.typeName()
    value = F.col(f"`{col}`")
    if kind.startswith("timestamp") or kind == "date":
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        value = F.timestamp_diff("SECOND", epoch, value.cast("timestamp_ntz"))
    else:
        value = value.cast("double")
    values = df.select(value.alias("v")).filter(F.col("v").isNotNull())
    span = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    if kind.startswith("timestamp") or kind == "date":
        step = F.floor((F.col("hi") - F.col("lo")) / n)
    else:
        step = (F.col("hi") - F.col("lo")) / n
    edges = span.withColumn("step", step)
    # One pass for the span and one for the counts; the span is a single row.
    lo, width = edges.select("lo").scalar(), edges.select("step").scalar()
    slot = F.when(width > 0, F.least(F.floor((F.col("v") - lo) / width), F.lit(n - 1))).otherwise(0)
    counts = values.select(slot.cast("int").alias("part")).groupBy("part").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    parts = edges.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part"))
    return (
        parts.join(counts, "part", "left")
        .select(
            "part",
            (F.col("lo") + F.col("step") * F.col("part")).alias("lower"),
            F.when(F.col("part") == n - 1, F.col("hi"))
            .otherwise(F.col("lo") + F.col("step") * (F.col("part") + 1))
            .alias("upper"),
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        )
    )


def schema_only(df: DataFrame) -> DataFrame:
    """The container with no rows, for schema inspection."""
    return df.limit(0)


def schema_rows(df: DataFrame) -> DataFrame:
    """``ordinal, field, type, nullable`` of a container; analysis only, no job."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, field string, type string, nullable boolean"
    )
