"""Computed containers: SQL tables, clause files, pairwise and SQL joins."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.functions.skew import fits_broadcast, rows_outside

# The kinds of a pairwise join.
JOIN_TYPES = ("inner", "left", "right", "full")


def computed_table(
    spark: SparkSession, views: Mapping[str, DataFrame], query: str
) -> DataFrame:
    """A container defined by a SQL query over named containers.

    The names are views only while the query is analysed; views of the session that have
    such names, in whatever case, are put back afterwards.
    """
    taken = {t.name for name in views for t in spark.catalog.listTables(pattern=name) if t.isTemporary}
    same = {name.lower() for name in views}
    before = {t: spark.table(f"`{t}`") for t in taken if t.lower() in same}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return spark.sql(query)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)


def computed_join_sql(
    spark: SparkSession, sources: Mapping[str, DataFrame], query: str
) -> DataFrame:
    """SQL-mode join: one query over any number of aliased sources."""
    return computed_table(spark, sources, query)


def _over_view(df: DataFrame, build: Callable[[str], str]) -> DataFrame:
    """Run SQL over ``df`` under a throw-away name; analysis happens right here."""
    spark, view = df.sparkSession, f"vf_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        return spark.sql(build(view))
    finally:
        spark.catalog.dropTempView(view)


def _call_end(clause: str) -> int:
    """Where the call that a lateral view starts with ends: behind the bracket that closes its first one, quotes aside."""
    depth, quote = 0, None
    for i, c in enumerate(clause):
        if quote:
            quote = None if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c in "()":
            depth += 1 if c == "(" else -1
            if depth == 0:
                return i + 1
    raise ValueError(f"no whole call in the lateral view {clause}")


def computed_file(
    src: DataFrame,
    select: str,
    where: str | None = None,
    group_by: str | None = None,
    lateral_views: Sequence[str] = (),
) -> DataFrame:
    """A select clause over one source, with optional where, group-by and lateral views.

    The clauses go to Spark unchanged. A lateral view reads like ``EXPLODE(items) item``,
    ``POSEXPLODE(items) AS pos, item`` or ``OUTER EXPLODE(map) key, value``; without names it has Spark's own.
    """

    def build(view: str) -> str:
        parts = [f"SELECT {select} FROM {view}"]
        for i, clause in enumerate(lateral_views):
            end = _call_end(clause)
            names = re.sub(r"^\s*AS\s+", "", clause[end:], flags=re.IGNORECASE).strip()
            parts.append(f"LATERAL VIEW {clause[:end]} lv_{i}" + (f" AS {names}" if names else ""))
        if where:
            parts.append(f"WHERE {where}")
        if group_by:
            parts.append(f"GROUP BY {group_by}")
        return " ".join(parts)

    return _over_view(src, build)


def _prefixed(df: DataFrame, prefix: str | None) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix or ''}{c}") for c in df.columns])


def key_join(left: DataFrame, right: DataFrame, lk: str, rk: str, how: str) -> DataFrame:
    """Key-equality join that keeps hot and null keys spread.

    Adaptive execution splits hot partitions of an inner join on both sides, but
    of an outer join only on one side (or neither). An outer join Spark cannot
    broadcast is therefore the inner join plus the unmatched rows; rows with a
    null key never match and are not shuffled.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"join type must be one of {', '.join(JOIN_TYPES)}")
    condition = left[f"`{lk}`"] == right[f"`{rk}`"]
    if how == "inner" or (how == "left" and fits_broadcast(right)) or (
        how == "right" and fits_broadcast(left)
    ):
        return left.join(right, condition, how)
    parts = [left.join(right, condition, "inner")]
    if how in ("left", "full"):
        parts.append(rows_outside(left, [lk], right, [rk]))
    if how in ("right", "full"):
        parts.append(rows_outside(right, [rk], left, [lk]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def computed_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    select: str,
    how: str = "inner",
    left_prefix: str | None = None,
    right_prefix: str | None = None,
    where: str | None = None,
    group_by: str | None = None,
) -> DataFrame:
    """Pairwise join of two containers, then the clauses of a computed file."""
    l, r = _prefixed(left, left_prefix), _prefixed(right, right_prefix)
    both = set(l.columns) & set(r.columns)
    if both:
        raise ValueError(f"fields on both sides need a prefix: {', '.join(sorted(both))}")
    joined = key_join(l, r, f"{left_prefix or ''}{left_key}", f"{right_prefix or ''}{right_key}", how)
    return computed_file(joined, select, where, group_by)


def auto_alias(df: DataFrame, known: Sequence[str] = ()) -> DataFrame:
    """Name unnamed result expressions ``expr_1``, ``expr_2``, ... in their order.

    Works on the analysed result: a name that is no plain identifier is the text
    of an expression. Plain columns and ``*`` keep their names; source columns
    with unusual names are passed as ``known``.
    """
    names, n = [], 0
    for name in df.columns:
        if name.isidentifier() or name in known:
            names.append(name)
        else:
            n += 1
            names.append(f"expr_{n}")
    return df.toDF(*names)


# --- validation ------------------------------------------------------------

# The parts each computed kind must have.
REQUIRED_PARTS = {
    "computed_table": ("query",),
    "computed_file": ("source_name", "select_clause"),
    "computed_join": (
        "left_name", "right_name", "left_key_field", "right_key_field", "select_clause",
    ),
}


def validate_definitions_bulk(defs: DataFrame) -> DataFrame:
    """Structural verdict on many container definitions: ``valid, reason``.

    Only computed kinds can be created; each kind has its required parts; a join
    type, where given, is one of the four.
    """
    kind = F.col("container_type")
    reason = F.when(
        ~F.coalesce(kind.isin(list(REQUIRED_PARTS)), F.lit(False)), F.lit("not a computed type")
    )
    for name, parts in REQUIRED_PARTS.items():
        for part in parts:
            reason = reason.when(
                (kind == name) & F.col(part).isNull(), F.lit(f"{part} is required for {name}")
            )
    reason = reason.when(
        (kind == "computed_join")
        & F.col("join_type").isNotNull()
        & ~F.col("join_type").isin(list(JOIN_TYPES)),
        F.concat(F.lit("unknown join type "), F.col("join_type")),
    )
    return defs.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def validate_container(build: Callable[[], DataFrame]) -> tuple[bool, str | None, T.StructType | None]:
    """Dry run of one definition: analysed by Spark, never executed."""
    try:
        return True, None, build().schema
    except (AnalysisException, ValueError) as error:
        return False, str(error).splitlines()[0], None


def field_drop_guard(
    old_fields: DataFrame,
    new_fields: DataFrame,
    checks: DataFrame,
    anomalies: DataFrame,
    force: bool = False,
) -> DataFrame:
    """Fields a redefinition drops although checks or anomalies use them.

    ``old_fields`` and ``new_fields`` are ``(container, field)``; ``checks`` has
    ``container, fields``; ``anomalies`` has ``container, field``. Without
    ``force`` such a field is a ``conflict``, with it ``dropped``.
    """
    on = ["container", "field"]
    dropped = old_fields.select(*on).distinct().join(
        new_fields.select(*on).distinct(), on, "left_anti"
    )
    uses = (
        checks.select("container", F.explode("fields").alias("field"))
        .withColumn("_checks", F.lit(1))
        .withColumn("_anomalies", F.lit(0))
        .unionByName(
            anomalies.select(*on).withColumn("_checks", F.lit(0)).withColumn("_anomalies", F.lit(1))
        )
        .groupBy(*on)
        .agg(F.sum("_checks").alias("checks"), F.sum("_anomalies").alias("anomalies"))
    )
    return dropped.join(uses, on, "inner").withColumn(
        "verdict", F.lit("dropped" if force else "conflict")
    )


def all_null_expression(df: DataFrame) -> str:
    """An expression that fails for every row with any value: bad rows are anomalies."""
    return " AND ".join(f"`{c.replace('`', '``')}` IS NULL" for c in df.columns)
