"""Sampling operators and the per-partition record cap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriframe.functions.keys import COVERAGE_STEPS, hash_slot, record_key
from veriframe.functions.skew import first_by_hash, first_in_group, rows_by_membership
from veriframe.session import durable


def table_sample(
    df: DataFrame, pct: float, seed: int = 0, key: Sequence[str] | None = None
) -> DataFrame:
    """``pct`` percent of the rows, each drawn on its own.

    With ``key`` the draw depends on the record key only, so the same records
    are drawn from any layout of the data.
    """
    if key is None:
        return df.sample(fraction=pct / 100, seed=seed)
    salted = F.concat_ws("|", F.lit(str(seed)), record_key(df, key))
    return df.filter(hash_slot(salted) < F.lit(round(pct / 100 * COVERAGE_STEPS)).cast("bigint"))


def view_sample(df: DataFrame, n: int, key: Sequence[str] = ()) -> DataFrame:
    """``n`` rows drawn at random but repeatably: those with the smallest key hash."""
    drawn = df.withColumn("_draw", F.md5(record_key(df, key)))
    return first_by_hash(drawn, "_draw", n).drop("_draw")


SPLIT = 32  # parts of a container that names no partition columns
DIRECT = 1_000  # records per partition that a task may send to the one that ranks them


def cap_per_partition(
    df: DataFrame,
    n: int | None,
    partition_cols: Sequence[str] = (),
    order_cols: Sequence[str] = (),
    keys: Sequence[str] = (),
    split: int = SPLIT,
) -> DataFrame:
    """At most ``n`` records per partition value, the first by ``order_cols``; None or -1 means all.

    Without partition columns the records are dealt to ``split`` parts by a hash of their key, without order columns they are
    drawn by it, so the same records stay whatever the layout of the data. Nulls are a partition value of their own.

    A small ``n`` is written as ``row_number() <= n``, which Spark prunes before the shuffle. Beyond that partitions
    that are small enough pass as they are, and the others are cut by ranges, so that no task sorts a
    whole partition value (see ``first_in_group``).
    """
    if n is None or n == -1:
        return df
    if n < -1:
        raise ValueError("records per partition must be -1 (unlimited) or more")
    rows, by, order = df, [f"`{c}`" for c in partition_cols], [f"`{c}`" for c in order_cols]
    if not by or not order:
        key = record_key(df, keys)
        if not by:
            rows, by = rows.withColumn("_dealt", hash_slot(key) % split), ["_dealt"]
        if not order:
            rows, order = rows.withColumn("_draw", F.md5(key)), ["_draw"]
    if n <= DIRECT:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        kept = rows.withColumn("_rn", rank).filter(F.col("_rn") <= n)
    else:
        group = F.to_json(F.struct(*[F.col(c) for c in by]), {"ignoreNullFields": "false"})
        named = rows.withColumn("_group", group)
        large = named.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > n).select("_group")
        # Few groups hold more than n records: their rows alone are dealt out and ranked.
        large = durable(large, "large_groups")
        passed = rows_by_membership(named, ["_group"], large, ["_group"], present=False)
        cut = rows_by_membership(named, ["_group"], large, ["_group"], present=True)
        columns = [c.strip("`") for c in order]
        # Ranges are cut on copies of the order columns, whose names need no quotes.
        copies = [f"_order{i}" for i in range(len(columns))]
        cut = cut.withColumns({a: F.col(f"`{c}`") for a, c in zip(copies, columns)})
        kept = passed.unionByName(first_in_group(cut, ["_group"], copies, n).drop(*copies))
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
