"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import pyarrow.fs  # noqa: F401  (pa.fs)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from a checkout that is not installed.

    They get its folder on their path. A cluster whose workers cannot see the folder has
    the package installed or shipped (``--py-files``), and then the path does no harm.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until ``df`` has no such column (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, as ``_id`` and ``_text``; other columns stay behind."""
    return df.select(col(id_col).alias("_id"), col(text_col).cast("string").alias("_text"))


def per_batch(fn: Callable[[list, list], dict], schema: pa.Schema, max_bytes: int = 2 << 20):
    """A mapInArrow function calling ``fn(ids, texts)`` on slices of about ``max_bytes`` of text.

    A slice holds one row at least, so its size is bounded by ``max_bytes`` plus the longest
    text. ``fn`` returns a dict of column values for the rows of its slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", max_bytes):
                out = fn(part.column("_id"), part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        v if isinstance(v, pa.Array) else pa.array(v, f.type)
                        for f, v in ((f, out[f.name]) for f in schema)
                    ],
                    schema=schema,
                )

    return run


def slices(batch: pa.RecordBatch, name: str | int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose values in column ``name`` sum to about ``max_bytes``."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(name)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield batch.slice(start)


def opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path of the shared folder, and the path within it."""
    if "://" not in path and not path.startswith("file:"):
        return pa.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(path)
