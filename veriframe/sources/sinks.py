"""Writing results: materialised containers, enrichment stores, exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.functions.skew import rows_by_membership
from veriframe.sources.sampling import cap_per_partition

REMEDIATION = ("none", "append", "overwrite")


def materialize(
    df: DataFrame,
    path: str,
    max_records: int | None = None,
    partition_cols: Sequence[str] = (),
    order_cols: Sequence[str] = (),
) -> DataFrame:
    """Run a computed container, keep its rows at ``path`` and read them back."""
    rows = cap_per_partition(df, max_records, partition_cols, order_cols)
    rows.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def enrichment_write(
    failures: DataFrame,
    root: str,
    prefix: str,
    strategy: str = "none",
    source_records: DataFrame | None = None,
    run_id: str | None = None,
) -> dict[str, str]:
    """Add anomalies to the enrichment store; source rows as ``strategy`` says.

    ``none`` writes no source rows, ``append`` adds them, ``overwrite`` replaces
    the earlier ones. Returns the paths by table.

    With ``run_id`` the rows of a run are a partition of their own, ``run_id``, which is replaced when the run
    writes again: a run that is repeated leaves the store as one run does.
    """
    if strategy not in REMEDIATION:
        raise ValueError(f"remediation must be one of {', '.join(REMEDIATION)}")
    base = root.rstrip("/")
    paths = {
        "anomalies": f"{base}/{prefix}anomalies",
        "source_records": f"{base}/{prefix}source_records",
    }
    if run_id is None:
        failures.write.mode("append").parquet(paths["anomalies"])
        if strategy != "none" and source_records is not None:
            source_records.write.mode(strategy).parquet(paths["source_records"])
        return paths
    part = f"run_id={quote(run_id, safe='')}"
    failures.write.mode("overwrite").parquet(f"{paths['anomalies']}/{part}")
    if strategy == "append" and source_records is not None:
        source_records.write.mode("overwrite").parquet(f"{paths['source_records']}/{part}")
    elif strategy == "overwrite" and source_records is not None:
        # The whole table, so that no earlier run's rows stay.
        whole = source_records.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").partitionBy("run_id")
        whole.option("partitionOverwriteMode", "static").parquet(paths["source_records"])
    return paths


def select_containers(
    containers: DataFrame, names: Sequence[str] | None = None, tags: Sequence[str] | None = None
) -> DataFrame:
    """Containers with one of the names and one of the tags; an absent filter passes all."""
    if names:
        containers = containers.filter(F.col("name").isin(list(names)))
    if tags:
        wanted = F.array(*[F.lit(t) for t in tags])
        containers = containers.filter(F.arrays_overlap(F.coalesce("tags", F.array()), wanted))
    return containers


def _deleted(df: DataFrame) -> Column:
    return F.coalesce(F.col("archived"), F.lit(False)) if "archived" in df.columns else F.lit(False)


def export_assets(
    assets: Mapping[str, DataFrame],
    containers: DataFrame,
    asset_type: str,
    container_names: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
    include_deleted: bool = False,
) -> DataFrame:
    """Anomalies, checks or profiles of the selected containers."""
    if asset_type not in ("anomalies", "checks", "profiles"):
        raise ValueError("asset type must be anomalies, checks or profiles")
    out = assets[asset_type]
    if not include_deleted:
        out = out.filter(~_deleted(out))
    if container_names or tags:
        chosen = select_containers(containers, container_names, tags).select("name")
        out = rows_by_membership(out, ["container"], chosen, ["name"], present=True)
    return out
