"""All set rules of a container in one pass over it and one shuffle of its keys.

``unique``, ``existsIn`` and ``notExistsIn`` ask the same kind of question: is a key repeated, or is it among
those of a reference? Checks that ask it of the same fields, brought to the same types, form a group, whatever
their references and whichever records they look at; only ``unique`` of some of the records counts by itself.
Every record is read once and becomes its key, the texts its messages need and per group one hash with a bit per check
that looks at it; these rows are written down. Exploded to (group, hash) and counted with map-side combining, they meet the
references' keys, a bit per reference, in one shuffle, which leaves the failing keys with a bit per check. The rows are then matched against those:
by broadcast where the failing keys are few, else spread by :func:`veriframe.functions.skew.attach`.

A hot key is one row per task in the shuffle, whatever the number of its records.

Keys are compared by two 64-bit hashes of their values, brought to one type. Two of n different keys of a group
would share both with a chance below n * n / 2 ** 129: one in 10 ** 14 for a million million keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.functions.skew import attach, not_null
from veriframe.session import durable


@dataclass(frozen=True)
class SetCheck:
    """A check on the keys of a container; ``scope`` says which records it looks at (None: all)."""

    uid: str
    rule_type: str
    fields: tuple[str, ...]
    message: Column
    scope: Column | None = None
    scope_name: object = None  # equal for checks of equal scope
    ref: DataFrame | None = None
    ref_fields: tuple[str, ...] = ()


BITS = 62  # checks of a group at most; further ones start another


def common_type(df: DataFrame, field: str, ref: DataFrame, ref_field: str) -> T.DataType:
    """The type Spark compares two fields in."""
    left, right = df.schema[field].dataType, ref.schema[ref_field].dataType
    if left == right:
        return left
    nulls = df.sparkSession.range(0).select(
        F.coalesce(F.lit(None).cast(left), F.lit(None).cast(right)).alias("v")
    )
    return nulls.schema["v"].dataType


def _hashes(fields: Sequence[str], kinds: Sequence[T.DataType | None]) -> list[Column]:
    """Two hashes of a key; trailing blanks, signed zeros and the like are as in a comparison of the values."""
    values = [F.col(f"`{f}`") if k is None else F.col(f"`{f}`").cast(k) for f, k in zip(fields, kinds)]
    return [F.xxhash64(*values).alias("a"), F.xxhash64(F.lit("second"), *values).alias("b")]


def _bits(conditions: Sequence[Column]) -> Column:
    """A bit per condition that holds."""
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(conditions)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def set_failures(df: DataFrame, key: Column, checks: Sequence[SetCheck]) -> DataFrame:
    """(check_uid, rule_type, record_key, message) of every record that fails one of ``checks``.

    Keys that hold a null are passed over. The pass over ``df`` and the shuffle are run here.
    """
    groups: dict[tuple, int] = {}
    members: list[list[SetCheck]] = []
    kinds: list[list[T.DataType | None]] = []
    place: list[tuple[int, int]] = []  # of each check: its group and its bit there
    for c in checks:
        own: list[T.DataType | None] = [None] * len(c.fields)
        if c.ref is not None:
            shared = [common_type(df, f, c.ref, r) for f, r in zip(c.fields, c.ref_fields, strict=True)]
            own = [None if k == df.schema[f].dataType else k for f, k in zip(c.fields, shared)]
        alone = c.scope_name if c.ref is None and c.scope is not None else None
        name = (c.fields, tuple(k and k.simpleString() for k in own), alone)
        g = groups.get(name)
        if g is None or len(members[g]) == BITS:
            g = groups[name] = len(members)
            members.append([])
            kinds.append(own)
        place.append((g, len(members[g])))
        members[g].append(c)

    keys = []
    for g, mine in enumerate(members):
        fields, asked = mine[0].fields, _bits([F.lit(True) if c.scope is None else c.scope for c in mine])
        key_of = F.struct(F.lit(g).alias("g"), *_hashes(fields, kinds[g]), asked.alias("c"))
        keys.append(F.when(not_null(fields) & (asked != 0), key_of))
    rows = df.select(
        key.alias("record_key"), F.array_compact(F.array(*keys)).alias("_k"),
        *[c.message.alias(f"_m{i}") for i, c in enumerate(checks)],
    ).filter(F.size("_k") > 0)
    rows = durable(rows, "set_rules")

    none = F.lit(0).cast("bigint")
    sides = [rows.select(F.explode("_k").alias("k")).select("k.g", "k.a", "k.b", F.lit(1).alias("_own"), none.alias("_there"))]
    bad = F.lit(None).cast("bigint")
    for g, mine in enumerate(members):
        refs: dict[tuple, int] = {}
        fails = []
        for c in mine:
            if c.ref is None:
                fails.append(F.col("_n") > 1)
                continue
            name = (id(c.ref), c.ref_fields)
            if name not in refs:
                refs[name] = 1 << len(refs)
                # Of other types than the records' own: those that both are compared in.
                types = [k or df.schema[f].dataType for f, k in zip(c.fields, kinds[g])]
                there = c.ref.filter(not_null(c.ref_fields))
                mark = F.lit(refs[name]).cast("bigint")
                sides.append(there.select(F.lit(g).alias("g"), *_hashes(c.ref_fields, types), F.lit(0).alias("_own"), mark.alias("_there")))
            met = F.col("_there").bitwiseAND(F.lit(refs[name])) != 0
            fails.append(met if c.rule_type == "notExistsIn" else ~met)
        bad = F.when(F.col("g") == g, _bits(fails)).otherwise(bad)
    judged = reduce(DataFrame.unionAll, sides).groupBy("g", "a", "b").agg(F.sum("_own").alias("_n"), F.bit_or("_there").alias("_there"))
    judged = judged.select("g", "a", "b", "_n", bad.alias("_bad"))
    failing = durable(judged.filter((F.col("_n") > 0) & (F.col("_bad") != 0)), "failing_keys")

    messages = [f"_m{i}" for i in range(len(checks))]
    exploded = rows.select("*", F.explode("_k").alias("k")).select("k.g", "k.a", "k.b", "k.c", "record_key", *messages)
    found = attach(exploded, failing, ["g", "a", "b"], n="_n")
    hit = F.col("c").bitwiseAND(F.col("_bad"))
    # Numbers of checks, so that messages nobody asks for are not shuffled.
    entries = [F.when((F.col("g") == g) & (hit.bitwiseAND(F.lit(1 << bit)) != 0), F.lit(i)) for i, (g, bit) in enumerate(place)]
    found = found.select("record_key", F.explode(F.array_compact(F.array(*entries))).alias("_i"), *messages)

    def of_check(values: Sequence[Column]) -> Column:
        return F.array(*values)[F.col("_i")]

    return found.select(
        of_check([F.lit(c.uid) for c in checks]).alias("check_uid"), of_check([F.lit(c.rule_type) for c in checks]).alias("rule_type"),
        "record_key", of_check([F.col(m) for m in messages]).alias("message"),
    )
