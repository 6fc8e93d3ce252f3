"""Reading containers: tables, delimited files and relational sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_scan(spark: SparkSession, store: str, name: str) -> DataFrame:
    """A table or view: ``store`` is a folder of Parquet tables or a catalog namespace."""
    if "/" in store:
        return spark.read.parquet(f"{store.rstrip('/')}/{name}.parquet")
    return spark.table(f"{store}.`{name}`")


def file_scan(
    spark: SparkSession,
    path: str,
    has_header: bool = True,
    escape: str | None = None,
    infer: bool = False,
    empty_as_null: bool = True,
    delimiter: str = ",",
    multi_line: bool = False,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A delimited file. Inference reads the data once more; a schema avoids that.

    ``multi_line`` is off by default because such files cannot be split.
    """
    reader = (
        spark.read.option("header", has_header)
        .option("sep", delimiter)
        .option("multiLine", multi_line)
        .option("emptyValue", "")
        .option("escape", escape or '"')
    )
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    # Spark reads a bare empty cell as null and a quoted one as "".
    empty = F.lit("")
    df = df.select(
        *[
            (F.nullif if empty_as_null else F.coalesce)(F.col(f"`{c}`"), empty).alias(c)
            if c in texts else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
    if infer and schema is None:
        from veriframe.operators.profile import cast_inferred

        df = cast_inferred(df, texts)
    return df


def jdbc_options(
    table: str,
    bounds: Mapping[str, object] | None = None,
    partition_field: str | None = None,
    fetch_size: int | None = None,
    max_parallel: int = 1,
) -> dict[str, str]:
    """Spark JDBC options for a parallel read split on ``partition_field``."""
    options = {"dbtable": table}
    if fetch_size:
        options["fetchsize"] = str(fetch_size)
    if partition_field and max_parallel > 1:
        if not bounds or bounds.get("lower") is None:
            raise ValueError("a partitioned read needs the bounds of its partition field")
        options.update(
            partitionColumn=partition_field,
            lowerBound=str(bounds["lower"]),
            upperBound=str(bounds["upper"]),
            numPartitions=str(max_parallel),
        )
    return options


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    partition_field: str | None = None,
    fetch_size: int | None = None,
    max_parallel: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A relational table; the source itself computes the one-row min/max bounds."""

    def reader(options: Mapping[str, str]) -> DataFrame:
        settings = {"url": url, **(properties or {}), **options}
        return spark.read.format("jdbc").options(**settings).load()

    bounds = None
    if partition_field and max_parallel > 1:
        query = f"(SELECT MIN({partition_field}) AS lower, MAX({partition_field}) AS upper FROM {table}) b"
        row = reader({"dbtable": query}).first()
        bounds = {k.lower(): v for k, v in row.asDict().items()}
        if bounds["lower"] is None:
            partition_field = None
    return reader(jdbc_options(table, bounds, partition_field, fetch_size, max_parallel))


def incremental_filter(
    df: DataFrame,
    field: str,
    greater_than_time: str | None = None,
    greater_than_batch: float | str | None = None,
) -> DataFrame:
    """Rows past a time or batch value. A plain comparison, so it reaches the scan.

    A batch value given as text is compared in the type of the field.
    """
    col = F.col(f"`{field}`")
    if greater_than_time is not None:
        kind = df.schema[field].dataType
        df = df.filter(col > F.lit(greater_than_time).cast(kind))
    if greater_than_batch is not None:
        value = F.lit(greater_than_batch)
        if isinstance(greater_than_batch, str):
            value = as_mark(value, df.schema[field].dataType.simpleString())
        df = df.filter(col > value)
    return df


CHECKPOINT_SCHEMA = "container string, field string, kind string, high_water string"


def as_mark(text: Column, kind: str) -> Column:
    """A stored mark in the type of its field; a whole number may be written with a decimal point."""
    return F.coalesce(text.try_cast(kind), text.try_cast("decimal(38,10)").cast(kind) if kind in WHOLE else F.lit(None).cast(kind))


WHOLE = ("tinyint", "smallint", "int", "bigint")


def next_checkpoint(
    df: DataFrame,
    container: str,
    field: str,
    kind: str = "last-modified",
    previous: DataFrame | None = None,
) -> DataFrame:
    """High-water mark of a container after reading ``df``; never moves back.

    ``kind`` is ``last-modified`` (time) or ``batch`` (number). The mark is kept as
    text; times are compared as such, numbers in the type of the field, so that no
    digit is lost.
    """
    as_kind = {"last-modified": "timestamp_ntz", "batch": df.schema[field].dataType.simpleString()}[kind]
    seen = df.agg(F.max(F.col(f"`{field}`")).cast(as_kind).alias("v"))
    if previous is not None:
        mine = previous.filter((F.col("container") == container) & (F.col("field") == field))
        seen = seen.unionByName(mine.select(as_mark(F.col("high_water"), as_kind).alias("v")))
    return seen.agg(F.max("v").alias("v")).select(
        F.lit(container).alias("container"),
        F.lit(field).alias("field"),
        F.lit(kind).alias("kind"),
        F.col("v").cast("string").alias("high_water"),
    )


def read_past_checkpoint(df: DataFrame, field: str, checkpoint: DataFrame) -> DataFrame:
    """Rows of ``df`` past the one-row ``checkpoint``; everything when it is null.

    The mark is a scalar subquery, so the scan still sees a simple comparison.
    """
    kind = df.schema[field].dataType
    mark = checkpoint.select(F.max(as_mark(F.col("high_water"), kind.simpleString()))).scalar()
    return df.filter(mark.isNull() | (F.col(f"`{field}`") > mark))
