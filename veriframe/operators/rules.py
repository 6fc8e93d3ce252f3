"""The quality rules.

Row rules are boolean columns that are true for a failing record; a null lets
the record pass. Set and aggregate rules are DataFrames. User expressions reach
Spark unchanged, so simple ones are pushed to the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.functions.skew import attach, key_counts, not_null, rows_by_membership

ROW_RULES = ("notNull", "between", "matchesPattern", "satisfiesExpression", "afterDateTime")
SET_RULES = ("unique", "existsIn", "notExistsIn")
SHAPE_RULES = ("isReplicaOf", "dataDiff", "aggregationComparison", "volumetric")
# The rules that refer to another container.
CROSS_REFERENCE_RULES = ("existsIn", "notExistsIn", "isReplicaOf", "dataDiff")

# --- row rules -------------------------------------------------------------


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def fails_not_null(fields: Sequence[str]) -> Column:
    return _any([F.col(f"`{f}`").isNull() for f in fields])


def bounds_of(properties: Mapping[str, str]) -> tuple[str | None, str | None]:
    """Both spellings of the bounds are accepted."""

    def first(*keys: str) -> str | None:
        return next((properties[k] for k in keys if properties.get(k) is not None), None)

    return first("min_value", "min"), first("max_value", "max")


def _bound(kind: T.DataType, text: str, low: bool) -> Column:
    """A bound in the field's own type where that is exact, so it reaches the scan.

    Whole numbers are as far from a fraction as from the next whole number inside the range.
    """
    if isinstance(kind, T.IntegralType):
        number = Decimal(text)
        if not number.is_finite():
            return F.lit(float(text))
        return F.lit(int(number.to_integral_value(ROUND_CEILING if low else ROUND_FLOOR)))
    if isinstance(kind, T.DecimalType):
        return F.lit(Decimal(text))
    if isinstance(kind, T.NumericType):
        return F.lit(float(text)).cast(kind)
    return F.lit(text).cast(kind)


def fails_between(df: DataFrame, fields: Sequence[str], low: str | None, high: str | None) -> Column:
    """Outside the inclusive range; a missing bound is open."""
    if low is None and high is None:
        raise ValueError("between needs at least one bound")
    conditions = []
    for f in fields:
        kind = df.schema[f].dataType
        if low is not None:
            conditions.append(F.col(f"`{f}`") < _bound(kind, low, True))
        if high is not None:
            conditions.append(F.col(f"`{f}`") > _bound(kind, high, False))
    return _any(conditions)


def fails_pattern(fields: Sequence[str], pattern: str) -> Column:
    """The whole value must match."""
    return _any([~F.col(f"`{f}`").rlike(rf"\A(?:{pattern})\z") for f in fields])


def fails_expression(expression: str) -> Column:
    """Only FALSE fails, as in a SQL CHECK constraint."""
    return ~F.expr(f"({expression})")


def fails_after(df: DataFrame, fields: Sequence[str], instant: str) -> Column:
    return _any(
        [F.col(f"`{f}`") <= F.lit(instant).cast(df.schema[f].dataType) for f in fields]
    )


def row_failure(df: DataFrame, rule: str, fields: Sequence[str], props: Mapping[str, str]) -> Column:
    if rule == "notNull":
        return fails_not_null(fields)
    if rule == "between":
        return fails_between(df, fields, *bounds_of(props))
    if rule == "matchesPattern":
        return fails_pattern(fields, props["pattern"])
    if rule == "satisfiesExpression":
        return fails_expression(props["expression"])
    if rule == "afterDateTime":
        return fails_after(df, fields, props["datetime"])
    raise ValueError(f"{rule} is not a row rule")


# --- set rules -------------------------------------------------------------


def unique_failures(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Every row of a repeated tuple; tuples holding a null are ignored."""
    counts = key_counts(df, fields).withColumn("_repeated", F.col("_n") > 1)
    rows = attach(df.filter(not_null(fields)), counts, fields, keep="_repeated")
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])


def exists_failures(
    df: DataFrame, fields: Sequence[str], ref: DataFrame, ref_fields: Sequence[str]
) -> DataFrame:
    """Rows whose value is missing from the reference."""
    return rows_by_membership(df, fields, ref, ref_fields, present=False)


def not_exists_failures(
    df: DataFrame, fields: Sequence[str], ref: DataFrame, ref_fields: Sequence[str]
) -> DataFrame:
    """Rows whose value does occur in the reference."""
    return rows_by_membership(df, fields, ref, ref_fields, present=True)


# --- whole-container rules -------------------------------------------------


BUCKETS = 4_096  # of a digest table


def _differing(rows: DataFrame, cols: Sequence[Column], by: Sequence[Column]) -> DataFrame:
    """The rows of the buckets whose digests differ between both sides, ``_d`` being 1 on the left and -1 on the right.

    A bucket takes the rows of equal ``by``; its digest is the sum of two 64-bit hashes of its rows. The sums are combined
    map-side, so a task sends BUCKETS rows at most. A difference stays hidden if both hashes of the rows that
    differ add up to the same sums, with a chance of one in 2 ** 128 per bucket.
    """
    # Hashes pass over nulls, so that which values are null is a value of its own.
    nulls = F.array(*[c.isNull() for c in cols])
    low = F.lit((1 << 32) - 1)
    parts = []
    for h in (F.xxhash64(*cols, nulls), F.xxhash64(F.lit("second"), *cols, nulls)):
        parts += [h.bitwiseAND(low), F.shiftrightunsigned(h, 32)]  # halves, whose sums fit a bigint
    bucket = F.pmod(F.xxhash64(*by), F.lit(BUCKETS)).cast("int")
    net = rows.select(bucket.alias("_bucket"), "_d", *[p.alias(f"_h{i}") for i, p in enumerate(parts)]).groupBy("_bucket").agg(
        F.sum("_d").alias("_n"), *[F.sum(F.col("_d") * F.col(f"_h{i}")).alias(f"_h{i}") for i in range(len(parts))]
    )
    unequal = net.filter(_any([F.col(c) != 0 for c in ("_n", *[f"_h{i}" for i in range(len(parts))])])).select("_bucket")
    return rows.withColumn("_bucket", bucket).join(F.broadcast(unequal), "_bucket", "left_semi").drop("_bucket")


def _hashable(df: DataFrame, fields: Sequence[str]) -> bool:
    """Whether hashes tell all values apart; inside nested ones they pass over nulls."""
    return all(isinstance(df.schema[f].dataType, T.AtomicType) for f in fields)


def replica_diff(left: DataFrame, right: DataFrame, fields: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """Rows (with copies) that only one side has: multiset comparison, nulls equal.

    Both directions come from one grouping with partial sums; identical copies
    collapse before the shuffle and a difference is one row with its ``copies``.
    Only buckets of rows whose digests differ are grouped, so equal tables shuffle digests alone, for a second read of both;
    ``exact`` groups all rows. Nested fields are always compared so.
    """
    fields = list(fields or left.columns)
    cols = [F.col(f"`{c}`") for c in fields]
    both = left.select(*cols, F.lit(1).alias("_d")).unionAll(
        right.select(*cols, F.lit(-1).alias("_d"))
    )
    if not exact and _hashable(both, fields):
        both = _differing(both, cols, cols)
    net = both.groupBy(*cols).agg(F.sum("_d").alias("_net")).filter(F.col("_net") != 0)
    return net.select(
        *cols,
        F.when(F.col("_net") > 0, "left_only").otherwise("right_only").alias("_side"),
        F.abs("_net").alias("copies"),
    )


def data_diff(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str] = (), unique_keys: bool = False
) -> DataFrame:
    """Keyed differences: ``diff`` is added, removed, changed or repeated_key.

    ``right`` is the reference. Grouping instead of joining means that repeated
    keys are reported once with their counts, never multiplied.

    Where the keys are known to be unique on both sides (``unique_keys``), only buckets of keys whose rows differ are
    grouped, as in :func:`replica_diff`; a repeated key is then reported only if it lies in such a bucket.
    """
    keys = list(keys)
    fields = [f for f in (fields or left.columns) if f not in keys]
    if unique_keys:
        cols, by = ([F.col(f"`{c}`") for c in names] for names in ([*keys, *fields], keys))
        both = left.select(*cols, F.lit(1).alias("_d")).unionAll(right.select(*cols, F.lit(-1).alias("_d")))
        if _hashable(both, [*keys, *fields]):
            left_over = _differing(both, cols, by)
            left, right = (left_over.filter(F.col("_d") == d).drop("_d") for d in (1, -1))

    def side(df: DataFrame, mark: int) -> DataFrame:
        packed = F.struct(*[F.col(f"`{f}`") for f in fields])
        return df.select(
            *[F.col(f"`{k}`") for k in keys],
            F.when(F.lit(mark) == 0, packed).alias("_l"),
            F.when(F.lit(mark) == 1, packed).alias("_r"),
        )

    grouped = (
        side(left, 0)
        .unionAll(side(right, 1))
        .groupBy(*[F.col(f"`{k}`") for k in keys])
        .agg(
            F.count("_l").alias("left_rows"),
            F.count("_r").alias("right_rows"),
            F.max("_l").alias("_l"),
            F.max("_r").alias("_r"),
        )
    )
    changed = F.array_compact(
        F.array(
            *[
                F.when(~F.col("_l")[f].eqNullSafe(F.col("_r")[f]), F.lit(f)).otherwise(
                    F.lit(None).cast("string")
                )
                for f in fields
            ]
        )
    ) if fields else F.array().cast("array<string>")
    diff = (
        F.when((F.col("left_rows") > 1) | (F.col("right_rows") > 1), "repeated_key")
        .when(F.col("right_rows") == 0, "added")
        .when(F.col("left_rows") == 0, "removed")
        .when(F.size("_changed") > 0, "changed")
    )
    return (
        grouped.withColumn("_changed", changed)
        .withColumn("diff", diff)
        .filter(F.col("diff").isNotNull())
        .select(
            *[F.col(f"`{k}`") for k in keys],
            "diff",
            F.when(F.col("diff") == "changed", F.col("_changed")).alias("changed_fields"),
            "left_rows",
            "right_rows",
        )
    )


COMPARISONS = {
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
    "lt": lambda a, b: a < b,
    "lte": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "gte": lambda a, b: a >= b,
}


def aggregation_comparison(
    df: DataFrame, expression: str, comparison: str, ref: DataFrame, ref_expression: str
) -> DataFrame:
    """One row ``left_value, right_value, passed``; a null aggregate fails."""
    compare = COMPARISONS[comparison]
    left = df.agg(F.expr(expression).alias("left_value"))
    right = ref.agg(F.expr(ref_expression).alias("right_value"))
    both = left.unionByName(right, allowMissingColumns=True).agg(
        F.max("left_value").alias("left_value"), F.max("right_value").alias("right_value")
    )
    passed = F.coalesce(compare(F.col("left_value"), F.col("right_value")), F.lit(False))
    return both.withColumn("passed", passed)


def within_rows(n: Column, min_rows: int | None, max_rows: int | None) -> Column:
    passed = F.lit(True)
    if min_rows is not None:
        passed = passed & (n >= min_rows)
    if max_rows is not None:
        passed = passed & (n <= max_rows)
    return passed


def volumetric(df: DataFrame, min_rows: int | None = None, max_rows: int | None = None) -> DataFrame:
    """One row ``row_count, passed``; a missing bound is open."""
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("passed", within_rows(F.col("row_count"), min_rows, max_rows))
