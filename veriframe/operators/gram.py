"""Correlations of very many columns from one pass: a block-partitioned Gram matrix.

Every task adds up, for all pairs of columns at once and over the rows that hold both values, their number, the sums of both
values and their squares, and the sum of products, as matrix products of its rows. The matrices are cut into
blocks of pairs of columns, which are summed in a tree of tasks; correlations are worked out block by block.
A task holds seven matrices of the number of columns squared (14 MB for 500), whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.session import durable, importable

BLOCK = 64  # columns on either side of a block
ROWS = 2_048  # rows multiplied at once
FAN_IN = 64  # blocks of one pair of columns' blocks that a task adds up
ENTRIES = 7  # per pair: rows, products, sum and square sum of either side, rows with a NaN
CONSTANT = 1e-18  # what a variance may be of the mean square by rounding alone


def _blocks(n: int, block: int) -> list[tuple[int, int]]:
    k = -(-n // block)
    return [(a, b) for a in range(k) for b in range(a, k)]


def _cut(m: np.ndarray, a: int, b: int, block: int) -> np.ndarray:
    return m[a * block : (a + 1) * block, b * block : (b + 1) * block]


def _summed(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of ``values`` per key, read as a stream."""
    dealt = parts.select(*keys, "values").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int32()) for k in current), pa.array([total.tobytes()], pa.binary())], names=[*keys, "values"])

        for batch in batches:
            for *key, values in zip(*(c.to_pylist() for c in batch.columns)):
                if key != current:
                    if current is not None:
                        yield row()
                    current, total = key, np.zeros(len(values) // 8)
                total += np.frombuffer(values)
        if current is not None:
            yield row()

    return dealt.mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", values binary")


def correlations(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """``field_a, field_b, correlation`` of pairs with at least ``threshold`` in size, over the rows that hold both values.

    A pair of which one is constant there has none; one that meets a NaN has NaN. Values are taken from about their
    column's mean, so that sums of squares keep their digits; the means, one number per column, reach the driver.
    """
    importable(df.sparkSession)
    names, n, block, chunk = list(cols), len(cols), BLOCK, ROWS
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    means = numbers.agg(*[F.avg(F.when(~F.isnan(f"c{i}"), F.col(f"c{i}"))) for i in range(n)]).first()
    center = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, products, sums, squares, odd = (np.zeros((n, n)) for _ in range(5))
        seen = False
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                seen = True
                part = batch.slice(at, chunk)
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns]).astype(float) - center
                there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in part.columns])
                bad = there & np.isnan(x)
                x[np.isnan(x)] = 0
                m = there.astype(float)
                rows += m.T @ m
                products += x.T @ x
                sums += x.T @ m
                squares += (x * x).T @ m
                if bad.any():
                    odd += bad.astype(float).T @ m
        if not seen:
            return
        odd = odd + odd.T
        task, made = TaskContext.get().partitionId(), []
        pairs = _blocks(n, block)
        for a, b in pairs:
            held = [_cut(m, a, b, block) for m in (rows, products, sums, sums.T, squares, squares.T, odd)]
            made.append(np.stack(held).tobytes())
        index = [pa.array(v, pa.int32()) for v in (*zip(*pairs), [task] * len(made))]
        yield pa.RecordBatch.from_arrays([*index, pa.array(made, pa.binary())], names=["a", "b", "task", "values"])

    parts = durable(numbers.mapInArrow(run, "a int, b int, task int, values binary"), "gram")
    widest = parts.agg(F.max("task")).first()[0]
    while widest is not None and widest >= FAN_IN:
        parts = _summed(parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")), ["a", "b", "task"])
        widest //= FAN_IN

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, values in zip(*(c.to_pylist() for c in batch.columns)):
                wide, high = (min(block, n - block * k) for k in (b, a))
                rows, products, sum_a, sum_b, square_a, square_b, odd = np.frombuffer(values).reshape(ENTRIES, high, wide)
                with np.errstate(divide="ignore", invalid="ignore"):
                    own_a, own_b = square_a - sum_a * sum_a / rows, square_b - sum_b * sum_b / rows
                    at_a, at_b = center[a * block : a * block + high, None], center[None, b * block : b * block + wide]
                    flat = (own_a <= CONSTANT * (square_a + rows * at_a**2)) | (own_b <= CONSTANT * (square_b + rows * at_b**2)) | (rows == 0)
                    value = (products - sum_a * sum_b / rows) / np.sqrt(own_a * own_b)
                value[odd > 0] = np.nan
                keep = (~flat | (odd > 0)) & ~(np.abs(value) < threshold - 1e-5)
                i, j = np.nonzero(keep)
                later = i + a * block < j + b * block
                i, j = i[later], j[later]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i + a * block, pa.int32()), pa.array(j + b * block, pa.int32()), pa.array(value[i, j], pa.float64())], names=["i", "j", "value"]
                )

    found = _summed(parts, ["a", "b"]).mapInArrow(finish, "i int, j int, value double")
    fields = F.array(*[F.lit(c) for c in names])
    out = found.select(fields[F.col("i")].alias("field_a"), fields[F.col("j")].alias("field_b"), F.round("value", 6).alias("correlation"))
    return out.filter(F.abs("correlation") >= threshold)
