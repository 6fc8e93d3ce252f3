"""Bulk definitions: three-column files of error queries turned into checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriframe.functions.skew import attach
from veriframe.functions.text import rule_id, strip_blanks
from veriframe.operators.computed import all_null_expression
from veriframe.operators.registry import Check

DEFINITION_SCHEMA = "c0 string, c1 string, c2 string, uneven string"


def load_definitions(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """``file, row, name, description, query`` from positional 3-column files.

    The header is skipped whatever it says; queries may span lines in quotes.
    Rows of fewer than three columns or with a blank name are dropped, the rest
    numbered from 1 per file. Such files cannot be split, so a file is read by
    one task in any case and numbering inside it adds no bottleneck.
    """
    if delimiter is None:
        delimiter = "\t" if path.endswith(".txt") else ","
    raw = (
        spark.read.schema(DEFINITION_SCHEMA)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("columnNameOfCorruptRecord", "uneven")
        .option("columnPruning", False)
        .csv(path)
    )
    # Spark marks rows of another width; without a third value they are too short.
    short = F.col("uneven").isNotNull() & F.col("c2").isNull()
    rows = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("_at"),
        strip_blanks(F.col("c0")).alias("name"),
        strip_blanks(F.coalesce("c1", F.lit(""))).alias("description"),
        strip_blanks(F.coalesce("c2", F.lit(""))).alias("query"),
        short.alias("_short"),
    ).filter(~F.col("_short") & (F.coalesce("name", F.lit("")) != ""))
    order = Window.partitionBy("file").orderBy("_at")
    return rows.select(
        "file", F.row_number().over(order).cast("bigint").alias("row"), "name", "description", "query"
    )


def validate_definitions(defs: DataFrame) -> DataFrame:
    """Adds ``valid`` and ``reason``: empty name, empty query or repeated name.

    The first row with a query keeps a name; later ones name that row.
    """
    empty_name = F.coalesce(F.col("name"), F.lit("")) == ""
    empty_query = F.coalesce(F.col("query"), F.lit("")) == ""
    first = (
        defs.filter(~empty_name)
        .groupBy("name")
        .agg(F.min(F.when(~empty_query, F.col("row"))).alias("_first"), F.count(F.lit(1)).alias("_n"))
    )
    known = attach(defs.filter(~empty_name), first, ["name"])
    reason = F.when(empty_query, F.lit("empty query")).when(
        F.col("row") > F.col("_first"),
        F.concat(F.lit("duplicate of row "), F.col("_first").cast("string")),
    )
    known = known.withColumn("reason", reason).drop("_first", "_n")
    unnamed = defs.filter(empty_name).withColumn("reason", F.lit("empty name"))
    return known.unionByName(unnamed).withColumn("valid", F.col("reason").isNull())


def plan_definitions(
    defs: DataFrame,
    containers: DataFrame,
    checked: DataFrame | None = None,
    prefix: str = "ct_",
    skip_checks: bool = False,
) -> DataFrame:
    """``table_name, table_action, check_action`` for valid definitions.

    ``containers`` holds existing names, ``checked`` the names that already have
    a check; both keep what is there.
    """
    planned = defs.withColumn("table_name", F.concat(F.lit(prefix), F.col("name")))
    known = containers.select(F.col("name").alias("_known")).distinct()
    planned = planned.join(known, planned["table_name"] == known["_known"], "left")
    planned = planned.withColumn(
        "table_action", F.when(F.col("_known").isNotNull(), "skip").otherwise("create")
    )
    if skip_checks:
        return planned.withColumn("check_action", F.lit("skip")).drop("_known")
    if checked is None:
        return planned.withColumn("check_action", F.lit("create")).drop("_known")
    has = checked.select(F.col("name").alias("_checked")).distinct()
    planned = planned.join(has, planned["table_name"] == has["_checked"], "left")
    skip = F.col("_known").isNotNull() & F.col("_checked").isNotNull()
    return planned.withColumn(
        "check_action", F.when(skip, "skip").otherwise("create")
    ).drop("_known", "_checked")


def error_query_check(
    df: DataFrame,
    container: str,
    description: str | None = None,
    as_draft: bool = True,
    tags: Sequence[str] = (),
    rule_id: str | None = None,
) -> Check:
    """The check of an error query: every returned row is an anomaly.

    Only the analysed schema of the query is needed. The id of the rule the query comes
    from goes into the metadata.
    """
    return Check(
        container=container,
        rule_type="satisfiesExpression",
        fields=tuple(df.columns),
        coverage=1.0,
        properties={"expression": all_null_expression(df)},
        tags=tuple(tags),
        status="Draft" if as_draft else "Active",
        description=description or f"Satisfies expression check for {container}",
        additional_metadata={
            "computed_table_name": container,
            "original_description": description or "",
            **({"rule_id": rule_id} if rule_id else {}),
        },
    )


def with_rule_id(defs: DataFrame) -> DataFrame:
    """The id of a definition's rule, taken from its own name without the prefix."""
    return defs.withColumn("rule_id", rule_id(F.col("name")))
