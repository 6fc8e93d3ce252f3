"""Session settings and the shared folder used for durable intermediate data."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def session(app: str = "veriframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on (AQE, UTC)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from a checkout that is not installed, by its folder on their path.

    A cluster whose workers cannot see the folder has the package installed or shipped (``--py-files``).
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder; a cluster without the setting is refused,
    since a folder on one machine would lose data with that machine.
    """
    known = spark.conf.get(CHECKPOINT_KEY, None)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="veriframe-")
    return _local_dirs[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, never deleted here."""
    return f"{shared_dir(spark).rstrip('/')}/veriframe/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str = "durable") -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    Used where a later step must see exactly the same rows again, also after an
    executor is lost, or where a result is used more than once. Unlike an RDD
    checkpoint the table is compressed, can be pruned, and its size is known to
    Catalyst.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
