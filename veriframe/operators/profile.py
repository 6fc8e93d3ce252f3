"""Field profiles: one wide aggregation per container, turned long at the end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.functions.skew import running_total
from veriframe.operators.gram import correlations
from veriframe.sources.readers import incremental_filter
from veriframe.sources.sampling import cap_per_partition

# Keeps one aggregation's generated code small. A pass reads its own columns only,
# so more passes read no more data.
COLUMNS_PER_PASS = 20
PAIRS_PER_PASS = 200
RSD = 0.05  # standard error of distinct sketches; halving it needs four times the buffer


def numeric_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _metrics(df: DataFrame, name: str, rsd: float) -> dict[str, Column]:
    col, kind = F.col(f"`{name}`"), df.schema[name].dataType
    none = F.lit(None)
    out = {"non_null_count": F.count(col), "distinct_count": F.approx_count_distinct(col, rsd)}
    ordered = isinstance(kind, T.AtomicType) and not isinstance(kind, T.BinaryType)
    out["min"] = F.min(col).cast("string") if ordered else none.cast("string")
    out["max"] = F.max(col).cast("string") if ordered else none.cast("string")
    number = isinstance(kind, T.NumericType)
    out["mean"] = F.avg(col).cast("double") if number else none.cast("double")
    out["stddev"] = F.stddev_samp(col).cast("double") if number else none.cast("double")
    text = isinstance(kind, T.StringType)
    out["min_length"] = F.min(F.length(col)) if text else none.cast("int")
    out["max_length"] = F.max(F.length(col)) if text else none.cast("int")
    out["_mask"] = F.min(value_mask(col)) if text else none.cast("string")
    out["_other_mask"] = F.max(value_mask(col)) if text else none.cast("string")
    return out


def exact_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``field, distinct_count`` counted exactly; shuffles every distinct value.

    Kept apart from other figures: only counts of distinct values run as a hash
    aggregation with partial results.
    """
    wide = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(cols)])
    entries = [
        F.struct(F.lit(c).alias("field"), F.col(f"_{i}").alias("distinct_count")) for i, c in enumerate(cols)
    ]
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def value_mask(col: Column) -> Column:
    """A regular expression for the shape of a value: runs of A-Z, a-z and 0-9.

    Any other character stands for itself.
    """
    marked = F.regexp_replace(col, "[A-Z]+", "\u0001")
    marked = F.regexp_replace(marked, "[a-z]+", "\u0002")
    marked = F.regexp_replace(marked, "[0-9]+", "\u0003")
    escaped = F.regexp_replace(marked, r"([\\\[\](){}.*+?^$|])", r"\\$1")
    for mark, cls in (("\u0001", "[A-Z]+"), ("\u0002", "[a-z]+"), ("\u0003", "[0-9]+")):
        escaped = F.replace(escaped, F.lit(mark), F.lit(cls))
    return escaped


def field_profile(
    df: DataFrame,
    container: str,
    fields: Sequence[str] | None = None,
    exact: bool = False,
    rsd: float = RSD,
) -> DataFrame:
    """One row of statistics per field.

    Distinct counts are approximate unless ``exact``, which shuffles every value.
    """
    names = list(fields or df.columns)
    parts = []
    for at in range(0, len(names), COLUMNS_PER_PASS):
        chunk = names[at : at + COLUMNS_PER_PASS]
        metrics = {n: _metrics(df, n, rsd) for n in chunk}
        wide = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[c.alias(f"_{i}_{m}") for i, n in enumerate(chunk) for m, c in metrics[n].items()],
        )
        entries = [
            F.struct(
                F.lit(n).alias("field"),
                F.lit(df.schema[n].dataType.simpleString()).alias("type"),
                *[F.col(f"_{i}_{m}").alias(m) for m in metrics[n]],
            )
            for i, n in enumerate(chunk)
        ]
        parts.append(wide.select("_rows", F.explode(F.array(*entries)).alias("e")))
    long = reduce(DataFrame.unionByName, parts)
    nulls = F.col("_rows") - F.col("e.non_null_count")
    pattern = F.when(F.col("e._mask") == F.col("e._other_mask"), F.col("e._mask"))
    rest = ("distinct_count", "min", "max", "mean", "stddev", "min_length", "max_length")
    out = long.select(
        F.lit(container).alias("container"),
        "e.field",
        "e.type",
        F.col("_rows").alias("row_count"),
        nulls.alias("null_count"),
        F.when(F.col("_rows") > 0, F.col("e.non_null_count") / F.col("_rows")).alias("completeness"),
        *[f"e.{m}" for m in rest],
        pattern.alias("pattern"),
    )
    if not exact:
        return out
    counted = exact_distinct(df, names).select(
        F.col("field").alias("_field"), F.col("distinct_count").alias("_exact")
    )
    # One row per column on both sides.
    both = out.join(F.broadcast(counted), F.col("field") == F.col("_field"))
    return both.withColumn("distinct_count", F.col("_exact")).drop("_field", "_exact")


def with_exact_keys(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Replace the sketched counts of fields that look unique by exact ones.

    Only such fields can be keys, and only their names come to the driver.
    """
    # Six standard errors: a unique field that falls below is one in a thousand million.
    near = F.col("distinct_count") >= (1 - 6 * RSD) * F.col("row_count")
    whole = (F.col("null_count") == 0) & (F.col("row_count") > 0)
    names = [r["field"] for r in profiles.filter(near & whole).select("field").collect()]
    if not names:
        return profiles
    counted = exact_distinct(df, names).select(
        F.col("field").alias("_field"), F.col("distinct_count").alias("_exact")
    )
    # At most one row per column.
    both = profiles.join(F.broadcast(counted), F.col("field") == F.col("_field"), "left")
    exact = F.coalesce("_exact", "distinct_count")
    return both.withColumn("distinct_count", exact).drop("_field", "_exact")


def profile_incremental(
    df: DataFrame,
    container: str,
    incremental_field: str | None = None,
    greater_than_time: str | None = None,
    greater_than_batch: float | None = None,
    max_records_per_partition: int | None = None,
    partition_cols: Sequence[str] = (),
    order_cols: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Profile of the rows past a time or batch, capped per partition (see ``cap_per_partition``)."""
    if incremental_field:
        df = incremental_filter(df, incremental_field, greater_than_time, greater_than_batch)
    df = cap_per_partition(df, max_records_per_partition, partition_cols, order_cols)
    return field_profile(df, container, exact=exact)


def approx_distinct(df: DataFrame, cols: Sequence[str], rsd: float = RSD) -> DataFrame:
    """``field, distinct_count`` from sketches, in one pass."""
    wide = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), rsd).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "field", "distinct_count")


def _long_values(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """``field, value`` rows, one per cell; a generator, no shuffle."""
    cells = [
        F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast(kind).alias("value")) for c in cols
    ]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.field", "cell.value")


def quantile_profile(
    df: DataFrame,
    cols: Sequence[str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    exact: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """``field, probability, value`` of numeric fields.

    The default merges sketches in one pass. ``exact`` counts each distinct value
    and numbers the counts in order over all tasks, then interpolates between the
    two neighbouring ranks; no task ever holds a whole column.
    """
    if not exact:
        wide = df.agg(
            *[
                F.percentile_approx(F.col(f"`{c}`").cast("double"), list(probabilities), accuracy).alias(c)
                for c in cols
            ]
        )
        long = wide.unpivot([], list(cols), "field", "values")
        probs = F.array(*[F.lit(float(p)) for p in probabilities])
        pairs = F.explode(F.arrays_zip(probs.alias("probability"), F.col("values").alias("value")))
        return long.select("field", pairs.alias("p")).select("field", "p.probability", "p.value")
    counts = (
        _long_values(df, cols, "double")
        .filter(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = running_total(counts, ["field"], "value", "n", "upto")
    totals = upto.groupBy("field").agg(F.max("upto").alias("total"))
    wanted = totals.select(
        F.col("field").alias("_field"),
        F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability"),
        "total",
    ).withColumn("at", F.col("probability") * (F.col("total") - 1))
    # ``wanted`` has one row per field and probability, whatever the data.
    low, high = F.floor("at"), F.ceil("at")
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    hits = upto.join(
        F.broadcast(wanted),
        (F.col("field") == F.col("_field"))
        & (low.between(first, last) | high.between(first, last)),
    )
    ends = hits.groupBy("field", "probability").agg(
        F.max(F.when(low.between(first, last), F.col("value"))).alias("lo"),
        F.max(F.when(high.between(first, last), F.col("value"))).alias("hi"),
        F.max(F.col("at") - low).alias("part"),
    )
    return ends.select(
        "field", "probability", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value")
    )


# Kinds of text values, as bits of a set.
BOOLEAN, WHOLE, DECIMAL, DAY, TIME, TEXT = 1, 2, 4, 8, 16, 32


def value_kind(text: Column) -> Column:
    """The kind of one text value; null for null.

    Patterns go first: they are cheap to fail, a failing cast is not.
    """
    whole = text.rlike(r"^[+-]?[0-9]+$")
    decimal = text.rlike(r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$")
    day = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    time = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]")
    return (
        F.when(text.isNull(), F.lit(None).cast("int"))
        .when(whole, F.when(text.try_cast("bigint").isNotNull(), WHOLE).otherwise(DECIMAL))
        .when(decimal, DECIMAL)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .when(day & text.try_cast("date").isNotNull(), DAY)
        .when(time & text.try_cast("timestamp_ntz").isNotNull(), TIME)
        .otherwise(TEXT)
    )


def infer_types(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``field, inferred_type``: the first type that every non-null value has.

    The kinds that occur in a column are one bit set; whole numbers are numbers
    too, and dates are times.
    """
    wide = df.agg(
        *[F.bit_or(value_kind(F.col(f"`{c}`").cast("string"))).alias(f"_{i}") for i, c in enumerate(cols)]
    )
    entries = []
    for i, c in enumerate(cols):
        seen = F.col(f"_{i}")
        choice = (
            F.when(seen == BOOLEAN, "boolean")
            .when(seen == WHOLE, "bigint")
            .when(seen.isin(DECIMAL, DECIMAL | WHOLE), "double")
            .when(seen == DAY, "date")
            .when(seen.isin(TIME, TIME | DAY), "timestamp_ntz")
            .otherwise("string")
        )
        entries.append(F.struct(F.lit(c).alias("field"), choice.alias("inferred_type")))
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def cast_inferred(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast text columns to their inferred types; one metadata row per column is fetched."""
    kinds = {r["field"]: r["inferred_type"] for r in infer_types(df, cols).collect()}
    return df.withColumns(
        {c: F.col(f"`{c}`").try_cast(k) for c, k in kinds.items() if k != "string"}
    ) if kinds else df


def value_histogram(df: DataFrame, cols: Sequence[str], max_distinct: int) -> DataFrame:
    """Value counts of the fields with at most ``max_distinct`` different values.

    Fields with clearly more values are left out by their sketch before anything
    is shuffled; the exact counts decide among the rest. All per-field tables are
    at most one row per column of the container.
    """
    # Twice the limit is twenty standard errors of the sketch away.
    likely = approx_distinct(df, cols).filter(F.col("distinct_count") <= 2 * max_distinct + 16)
    likely = likely.select(F.col("field").alias("_likely"))
    cells = _long_values(df, cols, "string").filter(F.col("value").isNotNull())
    counts = (
        cells.join(F.broadcast(likely), F.col("field") == F.col("_likely"), "left_semi")
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    small = (
        counts.groupBy("field")
        .agg(F.count(F.lit(1)).alias("_distinct"))
        .filter(F.col("_distinct") <= max_distinct)
        .select(F.col("field").alias("_field"))
    )
    return counts.join(F.broadcast(small), F.col("field") == F.col("_field"), "left_semi")


def _correlation(a: str, b: str) -> Column:
    """Pearson correlation over rows with both values; null when one is constant."""
    x, y = F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlation_profile(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """``field_a, field_b, correlation`` of pairs with at least ``threshold`` in size.

    The pairs of some twenty columns are one aggregation; more are taken from a Gram matrix.
    """
    pairs = list(combinations(cols, 2))
    if len(pairs) > PAIRS_PER_PASS:
        return correlations(df, cols, threshold)
    wide = df.agg(*[_correlation(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(
            F.lit(a).alias("field_a"), F.lit(b).alias("field_b"),
            F.round(F.col(f"_{i}"), 6).alias("correlation"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    long = wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return long.filter(F.abs("correlation") >= threshold)


def inclusion_dependencies(
    containers: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """Which ``(container, field, ref_container, ref_field)`` pairs hold on the data.

    A pair holds when no distinct value is missing from the reference. Only
    distinct values meet in the join.
    """
    parts = []
    for container, name, ref, ref_field in pairs:
        values = containers[container].select(F.col(name).alias("v")).filter("v IS NOT NULL").distinct()
        members = containers[ref].select(F.col(ref_field).alias("m")).distinct()
        missing = values.join(members, values["v"] == members["m"], "left_anti")
        parts.append(
            missing.agg(F.count(F.lit(1)).alias("missing")).select(
                F.lit(container).alias("container"), F.lit(name).alias("field"),
                F.lit(ref).alias("ref_container"), F.lit(ref_field).alias("ref_field"),
                "missing",
            )
        )
    return reduce(DataFrame.unionByName, parts).filter("missing = 0").drop("missing")


def _comparable(col: Column, kind: T.DataType) -> Column | None:
    """A value as text that is equal for equal values of its family, the family in front; None for nested types."""
    if isinstance(kind, T.NumericType):
        exact = col.try_cast("decimal(38,18)")
        return F.concat(F.lit("n"), F.coalesce(exact.cast("string"), col.cast("double").cast("string")))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit("x"), F.hex(col))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.lit("t"), col.cast("timestamp").cast("string"))
    if isinstance(kind, (T.StringType, T.BooleanType)):
        return F.concat(F.lit(kind.typeName()[0]), col.cast("string"))
    return None


def all_inclusions(containers: Mapping[str, DataFrame]) -> DataFrame:
    """All pairs of fields where each value of the one is among those of the other, as ``inclusion_dependencies`` names them.

    Fields that hold no value are left out; numbers are compared across their types, as are times. Values
    are shuffled once, to the set of fields that hold them, whatever the number of pairs: one row per value, field and
    task at most. Equal sets are counted; a field lies in another if all its values are in sets that hold both.
    """
    fields = [(c, f.name) for c, df in containers.items() for f in df.schema.fields if _comparable(F.lit(None), f.dataType) is not None]
    cells = []
    for name, df in containers.items():
        mine = [(i, f) for i, (c, f) in enumerate(fields) if c == name]
        if mine:
            held = [F.struct(F.lit(i).alias("i"), _comparable(F.col(f"`{f}`"), df.schema[f].dataType).alias("v")) for i, f in mine]
            cells.append(df.select(F.explode(F.array(*held)).alias("e")).select("e.i", "e.v").filter("v IS NOT NULL"))
    # A set holds each field once, so it is as long as there are fields at most.
    sets = reduce(DataFrame.unionAll, cells).groupBy("v").agg(F.sort_array(F.collect_set("i")).alias("s"))
    counted = sets.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    pairs = counted.select("s", "n", F.explode("s").alias("i")).select("i", "n", F.explode("s").alias("j"))
    shared = pairs.groupBy("i", "j").agg(F.sum("n").alias("n"))
    whole = shared.filter("i = j").select(F.col("i").alias("_i"), F.col("n").alias("_n"))
    found = shared.join(whole, (F.col("i") == F.col("_i")) & (F.col("n") == F.col("_n"))).filter("i <> j")
    names = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(f).alias("f")) for c, f in fields])
    return found.select(
        names[F.col("i")]["c"].alias("container"), names[F.col("i")]["f"].alias("field"),
        names[F.col("j")]["c"].alias("ref_container"), names[F.col("j")]["f"].alias("ref_field"),
    )
