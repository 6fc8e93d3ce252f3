"""Record keys, failure fingerprints and the coverage draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COVERAGE_STEPS = 1 << 32


def in_order(df: DataFrame, name: str) -> Column:
    """A column whose maps have their entries in order of the keys, so that equal maps hash alike."""
    return _ordered(F.col(f"`{name}`"), df.schema[name].dataType).alias(name)


def _ordered(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.MapType):
        inner = F.transform_values(value, lambda k, v: _ordered(v, kind.valueType))
        return F.map_from_entries(F.array_sort(F.map_entries(inner), lambda a, b: F.when(
            a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)))
    if isinstance(kind, T.ArrayType) and _holds_map(kind):
        return F.transform(value, lambda v: _ordered(v, kind.elementType))
    if isinstance(kind, T.StructType) and _holds_map(kind):
        parts = [_ordered(value[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def record_key(df: DataFrame, keys: Sequence[str] = ()) -> Column:
    """Text key of a record: declared key columns, else a hash of the whole row.

    Identical rows without declared keys share one key; callers keep a count.
    """
    if not keys:
        return F.sha2(F.to_json(F.struct(*[in_order(df, c) for c in df.columns])), 256)
    parts = [F.col(f"`{k}`").cast("string") for k in keys]
    # Backslashes are doubled first, so that neither a bar nor the mark of a null can be spelled.
    parts = [F.replace(p, F.lit("\\"), F.lit("\\\\")) for p in parts]
    if len(parts) > 1:
        parts = [F.replace(p, F.lit("|"), F.lit("\\|")) for p in parts]
    return F.concat_ws("|", *[F.coalesce(p, F.lit("\\N")) for p in parts])


def fingerprint(check_uid: Column, key: Column) -> Column:
    """Stable identity of a failure."""
    return F.sha2(F.concat_ws("|", check_uid, F.coalesce(key, F.lit(""))), 256)


def hash_slot(key: Column) -> Column:
    """A draw in [0, 2**32) that depends on the key only, not on partitioning."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint")


def is_covered(key: Column, coverage: float | None) -> Column | None:
    """Condition for "this record is checked"; None means every record is."""
    if coverage is None or coverage >= 1.0:
        return None
    return hash_slot(key) < F.lit(round(coverage * COVERAGE_STEPS)).cast("bigint")
