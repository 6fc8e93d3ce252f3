"""Joins and numbering that stay balanced when one key holds much of the data.

Adaptive execution splits hot keys only in joins whose two inputs are plain
shuffles, so not in a join against rows that are already grouped by the key; and
a window over a hot key runs in one task. The helpers below either give a join
the shape that is split at run time, or use per-key counts, which partial
aggregation makes cheap, to spread exactly the hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriframe.session import durable

# A key is hot above total/SLOTS rows, so there are fewer than SLOTS hot keys
# whatever the data: that is the proven bound of the broadcast below.
SLOTS = 4_000
MIN_HOT_ROWS = 100_000


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``; plan statistics only, no job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int | None:
    """Size of the tables ``df`` reads; None where one of them does not know it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(s >= UNKNOWN_BYTES for s in sizes) else sum(sizes)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst itself would broadcast ``df`` under the session's limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= estimated_bytes(df) <= limit


def _same(left: DataFrame, right: DataFrame, on: Sequence[str], names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(on, names):
        condition = condition & (left[f"`{a}`"] == right[f"`{b}`"])
    return condition


def attach(
    df: DataFrame,
    per_key: DataFrame,
    on: Sequence[str],
    n: str = "_n",
    keep: str | None = None,
) -> DataFrame:
    """Inner join of ``df`` with one row per key, spreading hot keys.

    ``per_key`` holds every non-null key of ``df`` once, with the number of its
    rows in ``n``. Rows of hot keys get a salt taken from the partition they are
    read in, which a re-run task computes again alike; the single ``per_key``
    row is repeated once per salt (at most 2 * SLOTS rows more in total). With
    ``keep`` (a boolean column of ``per_key``) the other keys are dropped, hot
    ones before any row is shuffled.
    """
    on = list(on)
    keys = [f"_k{i}" for i in range(len(on))]
    share = F.greatest(per_key.agg(F.sum(n)).scalar() / SLOTS, F.lit(MIN_HOT_ROWS))
    sized = per_key.withColumn("_copies", F.ceil(F.col(f"`{n}`") / share).cast("int"))
    hot = sized.filter(F.col("_copies") > 1).select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)],
        F.col("_copies").alias("_hot"),
        (F.col(keep) if keep else F.lit(True)).alias("_hot_keep"),
    )
    rows = df.join(F.broadcast(hot), _same(df, hot, on, keys), "left")
    if keep:
        rows = rows.filter(F.coalesce(F.col("_hot_keep"), F.lit(True)))
        sized = sized.filter(F.col(keep))
    rows = rows.withColumn(
        "_salt", F.coalesce(F.pmod(F.spark_partition_id(), F.col("_hot")), F.lit(0))
    ).drop("_hot", "_hot_keep", *keys)
    spread = sized.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    extra = [c for c in per_key.columns if c not in on]
    spread = spread.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)],
        F.col("_salt").alias("_spread"),
        *[F.col(f"`{c}`") for c in extra],
    )
    joined = rows.join(
        spread, _same(rows, spread, on, keys) & (rows["_salt"] == spread["_spread"]), "inner"
    )
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"`{c}`") for c in extra])


def not_null(on: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(f"`{c}`").isNotNull()
    return condition


def key_counts(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows per non-null key; combined map-side, so hot keys cost nothing."""
    return df.filter(not_null(on)).groupBy(*[F.col(f"`{c}`") for c in on]).agg(
        F.count(F.lit(1)).alias("_n")
    )


def adaptive_skew(df: DataFrame) -> bool:
    """Whether the session splits skewed joins at run time."""
    conf = df.sparkSession.conf
    return all(
        conf.get(key, "true") == "true"
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


THIN = 16  # copies of a reference key that may remain


def rows_by_membership(
    df: DataFrame,
    on: Sequence[str],
    ref: DataFrame,
    ref_on: Sequence[str],
    present: bool,
) -> DataFrame:
    """Rows whose non-null key is (not) among the keys of ``ref``.

    A reference Catalyst can broadcast needs no shuffle at all. Beyond that a hot
    key of ``df`` is split at run time, which needs a plain shuffle on the other
    side: so the reference is thinned out per key and slice, not grouped by key,
    which also cuts its own hot keys to THIN rows. In a session that does not
    split joins the keys are matched first and hot ones salted.
    """
    names = [f"_r{i}" for i in range(len(ref_on))]
    members = (
        ref.filter(not_null(ref_on))
        .select(*[F.col(f"`{c}`").alias(k) for c, k in zip(ref_on, names)])
    )
    rows = df.filter(not_null(on))
    how = "left_semi" if present else "left_anti"
    if fits_broadcast(members):
        return rows.join(members, _same(rows, members, on, names), how)
    if adaptive_skew(df):
        slice_ = F.pmod(F.spark_partition_id(), F.lit(THIN))
        thin = members.withColumn("_slice", slice_).distinct().drop("_slice")
        return rows.join(thin, _same(rows, thin, on, names), how)
    counts = key_counts(df, on)
    members = members.distinct().withColumn("_member", F.lit(True))
    flagged = counts.join(members, _same(counts, members, on, names), "left")
    found = F.coalesce(F.col("_member"), F.lit(False))
    flagged = flagged.select(
        *[F.col(f"`{c}`") for c in on], "_n", (found if present else ~found).alias("_keep")
    )
    return attach(rows, flagged, on, keep="_keep").select(*[F.col(f"`{c}`") for c in df.columns])


def _apart(on: Sequence[str]) -> Column:
    """0 for rows with a whole key; rows with a null in it get a number from the partition they are read in.

    As a further join key it spreads rows that match nothing over the tasks, so that they can
    stay in the same pass as the others.
    """
    spread = F.pmod(F.spark_partition_id(), F.lit(SLOTS)) + 1
    return F.when(not_null(on), F.lit(0)).otherwise(spread)


def _zero(name: str) -> Column:
    """0, computed from the key so that the optimiser keeps it as a join key."""
    return F.hash(F.col(name)).bitwiseAND(F.lit(0))


def rows_outside(df: DataFrame, on: Sequence[str], ref: DataFrame, ref_on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``ref``, rows with a null key included (an anti join); ``df`` is read once.

    In a session that does not split joins at run time, it is read once more for the counts
    of its keys and once for its null keys.
    """
    names = [f"_r{i}" for i in range(len(ref_on))]
    members = (
        ref.filter(not_null(ref_on)).select(*[F.col(f"`{c}`").alias(k) for c, k in zip(ref_on, names)])
    )
    if fits_broadcast(members):
        return df.join(members, _same(df, members, on, names), "left_anti")
    if adaptive_skew(df):
        slice_ = F.pmod(F.spark_partition_id(), F.lit(THIN))
        thin = members.withColumn("_slice", slice_).distinct().drop("_slice").withColumn("_zero", _zero(names[0]))
        rows = df.withColumn("_apart", _apart(on))
        same = _same(rows, thin, on, names) & (rows["_apart"] == thin["_zero"])
        return rows.join(thin, same, "left_anti").drop("_apart")
    known = rows_by_membership(df, on, ref, ref_on, present=False)
    return known.unionByName(df.filter(~not_null(on)))


def lookup(df: DataFrame, on: Sequence[str], ref: DataFrame, ref_on: Sequence[str]) -> DataFrame:
    """Left join of ``df`` with the other columns of ``ref``, unique on ``ref_on``; ``df`` is read once.

    A reference Catalyst can broadcast is joined directly. Beyond that rows with
    a null key, which match nothing, are spread over the tasks, and hot keys are split at
    run time: the reference is rebalanced first, so that it too is a plain
    shuffle. In a session that does not split joins hot keys are salted, which takes
    further reads for the counts of the keys and for the null keys.
    """
    names = [f"_r{i}" for i in range(len(ref_on))]
    extra = [c for c in ref.columns if c not in ref_on]
    side = ref.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(ref_on, names)], *[F.col(f"`{c}`") for c in extra]
    )
    if fits_broadcast(side):
        return df.join(side, _same(df, side, on, names), "left").drop(*names)
    if adaptive_skew(df):
        side = side.withColumn("_zero", _zero(names[0])).hint("rebalance")
        rows = df.withColumn("_apart", _apart(on))
        same = _same(rows, side, on, names) & (rows["_apart"] == side["_zero"])
        return rows.join(side, same, "left").drop(*names, "_apart", "_zero")
    keyed = df.filter(not_null(on))
    counts = key_counts(df, on)
    found = counts.join(side, _same(counts, side, on, names), "left").drop(*names)
    known = attach(keyed, found, on).drop("_n")
    return known.unionByName(df.filter(~not_null(on)), allowMissingColumns=True)


RANGE_BYTES = 256 << 20
MAX_RANGES = 50_000


def _ranged(df: DataFrame, *order: str) -> DataFrame:
    """``df`` in range partitions with their number in ``_part``, pinned in a table.

    Small or unknown data is left to adaptive execution; above that there is a
    partition per RANGE_BYTES read.
    """
    wanted = min((input_bytes(df) or 0) // RANGE_BYTES, MAX_RANGES)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = df.repartitionByRange(wanted, *order) if wanted > usual else df.repartitionByRange(*order)
    return durable(parts.withColumn("_part", F.spark_partition_id()), "ranges")


def group_index(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """1-based position of each row in its group, no group held by one task.

    Rows are range-partitioned on group and order, so a large group spans many
    partitions; positions are counted per partition and shifted by the sizes of
    the group's earlier partitions. The ranges are pinned in reliable storage,
    as both passes must see the same ones. ``order`` must be unique in a group
    and ``by`` must not hold nulls.
    """
    ranged = _ranged(df, *by, *order)
    sizes = ranged.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_m"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per group and partition it touches: few per group, never its rows.
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_m").over(earlier), F.lit(0)))
    local = Window.partitionBy(*by, "_part").orderBy(*order)
    numbered = ranged.withColumn(name, F.row_number().over(local).cast("bigint"))
    return (
        numbered.join(offsets.drop("_m"), [*by, "_part"])
        .withColumn(name, F.col(name) + F.col("_before"))
        .select(*df.columns, name)
    )


def first_in_group(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, no group held by one task.

    Rows are range-partitioned on group and order, as in :func:`group_index`; the sizes of a group's
    ranges tell which of them are taken whole, which is cut and which are left out. Only the rows
    of the cut ranges, one per group, are ranked.
    """
    ranged = _ranged(df, *by, *order)
    sizes = ranged.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_m"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(n) - F.coalesce(F.sum("_m").over(earlier), F.lit(0))
    # One row per group and range it touches.
    wanted = durable(sizes.withColumn("_left", left).filter("_left > 0"), "wanted_ranges")
    whole = ranged.join(wanted.filter("_m <= _left").select(*by, "_part"), [*by, "_part"], "left_semi")
    cut = ranged.join(wanted.filter("_m > _left").select(*by, "_part", "_left"), [*by, "_part"])
    rank = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order))
    ranked = cut.withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_left"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return whole.select(*columns).unionByName(ranked.select(*columns))


# Above this many rows a top-n is first cut down by a histogram, as every task
# would otherwise send its own n rows to the last one.
DIRECT_TOP = 1_000
HASH_DIGITS = 5


def first_by_hash(df: DataFrame, digest: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest value of ``digest``, a hexadecimal hash.

    For a larger ``n`` the rows are counted by their first hash digits, a table
    of at most 16 ** HASH_DIGITS rows, which tells how far to read.
    """
    rows = df
    if n > DIRECT_TOP:
        head = F.substring(F.col(digest), 1, HASH_DIGITS)
        sizes = df.groupBy(head.alias("_head")).agg(F.count(F.lit(1)).alias("_m"))
        upto = sizes.withColumn("_upto", F.sum("_m").over(Window.orderBy("_head")))
        last = upto.filter(F.col("_upto") >= n).agg(F.min("_head")).scalar()
        rows = df.filter(last.isNull() | (head <= last))
    return rows.orderBy(digest).limit(n)


def running_total(
    df: DataFrame, by: Sequence[str], order: str, amount: str, name: str
) -> DataFrame:
    """Sum of ``amount`` over the earlier and the current row of the group.

    Built like :func:`group_index`.
    """
    ranged = _ranged(df, *by, order)
    sizes = ranged.groupBy(*by, "_part").agg(F.sum(amount).alias("_m"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_m").over(earlier), F.lit(0)))
    local = (
        Window.partitionBy(*by, "_part")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ranged.withColumn(name, F.sum(amount).over(local))
        .join(offsets.drop("_m"), [*by, "_part"])
        .withColumn(name, F.col(name) + F.col("_before"))
        .select(*df.columns, name)
    )
