"""The five operations end to end: sync, profile, scan, materialise, export.

Each takes and returns tables of the registry. Results an operation uses more than
once are first written to reliable storage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veriframe.operators import anomalies as an
from veriframe.operators import profile as pr
from veriframe.operators.inference import MAX_TEST_SAMPLE, infer_checks, test_inferred
from veriframe.operators.registry import active_checks
from veriframe.operators.scan import Container, ScanOptions, scan, scan_summary, scanned_rows
from veriframe.session import durable
from veriframe.sources.discover import sync_diff
from veriframe.sources.readers import CHECKPOINT_SCHEMA, next_checkpoint
from veriframe.sources.sinks import enrichment_write, export_assets, materialize, select_containers

RUN_COLUMNS = (
    "id string, datastore string, type string, result string, created timestamp_ntz, "
    "end_time timestamp_ntz, containers_total bigint, containers_analyzed bigint, "
    "records_processed bigint, anomalies_identified bigint"
)


def run_row(
    spark: SparkSession, run_id: str, datastore: str, kind: str, created: str, end_time: str | None,
    result: str = "success", **counters: int,
) -> DataFrame:
    """One row of the ``runs`` table."""
    names = ("containers_total", "containers_analyzed", "records_processed", "anomalies_identified")
    values = [(run_id, datastore, kind, result, created, end_time, *[counters.get(n) for n in names])]
    texts = RUN_COLUMNS.replace("timestamp_ntz", "string")
    return spark.createDataFrame(values, texts).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("created", "end_time")}
    )


def chosen(
    containers: Mapping[str, Container], registry: DataFrame, names: Sequence[str] | None, tags: Sequence[str] | None
) -> dict[str, Container]:
    """The given containers that the names and tags select; only names are fetched."""
    known = registry.filter(F.col("name").isin(list(containers)))
    rows = select_containers(known, names, tags).select("name").distinct().collect()
    return {r["name"]: containers[r["name"]] for r in rows}


def run_sync(discovered: DataFrame, registry: DataFrame, prune: bool = False, recreate: bool = False) -> DataFrame:
    """The registry after a sync: new containers added, kept ones untouched.

    Missing ones go only with ``prune``; ``recreate`` takes every row anew.
    """
    actions = sync_diff(discovered, registry, prune, recreate)
    made = actions.filter(F.col("action").isin("create", "recreate")).select(F.col("name").alias("_n"))
    kept = actions.filter(F.col("action") == "keep").select(F.col("name").alias("_n"))
    new = discovered.join(made, discovered["name"] == made["_n"], "left_semi")
    old = registry.join(kept, registry["name"] == kept["_n"], "left_semi")
    return old.unionByName(new, allowMissingColumns=True)


@dataclass(frozen=True)
class ScanRun:
    """What a scan leaves behind."""

    failures: DataFrame
    anomalies: DataFrame
    checkpoints: DataFrame
    run: DataFrame


def run_scan(
    spark: SparkSession,
    containers: Mapping[str, Container],
    registry: DataFrame,
    checks: DataFrame,
    anomalies: DataFrame,
    run_id: str,
    created: str,
    datastore: str = "default",
    names: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
    incremental: bool = False,
    incremental_fields: Mapping[str, str] | None = None,
    checkpoints: DataFrame | None = None,
    greater_than_time: Mapping[str, str] | None = None,
    greater_than_batch: Mapping[str, float | str] | None = None,
    auto_resolve_passed_anomalies: bool = True,
    max_records_analyzed_per_partition: int | None = None,
    enrichment_source_record_limit: int | None = None,
    high_count_rollup_threshold: int | None = None,
    enrichment_root: str | None = None,
    enrichment_prefix: str = "",
    remediation_strategy: str = "none",
) -> ScanRun:
    """Scan the selected containers and fold the result into the anomaly table.

    Incremental scans first take the new marks, then read past the stored marks (or the
    given ``greater_than`` values) and up to the new ones, so rows that arrive meanwhile are
    left to the next run; rows without a value are read every time. References are always
    read whole. Under a record cap nothing is resolved and no mark moves, as records
    were left out. What still fails is not resolved, rolled up or not.

    With ``enrichment_root`` the failures are written to the enrichment store there, and the source rows of new anomalies
    (as many as ``enrichment_source_record_limit``) as ``remediation_strategy`` says; a run that is repeated replaces its own rows.
    """
    if remediation_strategy != "none" and (enrichment_root is None or enrichment_source_record_limit is None):
        raise ValueError("source rows are written below an enrichment root, and up to a source record limit")
    capped = max_records_analyzed_per_partition not in (None, -1)
    mine = chosen(containers, registry, names, tags)
    fields = {n: f for n, f in (incremental_fields or {}).items() if n in mine}
    times: dict[str, str] = {}
    batches: dict[str, float | str] = {}
    if incremental and checkpoints is not None:
        stored = checkpoints.filter(F.col("container").isin(list(fields)) & F.col("high_water").isNotNull())
        for mark in stored.collect():
            if mark["field"] == fields[mark["container"]]:
                if mark["kind"] == "batch":
                    batches[mark["container"]] = mark["high_water"]
                else:
                    times[mark["container"]] = mark["high_water"]
    times.update(greater_than_time or {})
    batches.update(greater_than_batch or {})
    kept = checkpoints if checkpoints is not None else spark.createDataFrame([], CHECKPOINT_SCHEMA)
    moved, up_to = [], {}
    if incremental and not capped:
        for n, f in fields.items():
            moved.append(next_checkpoint(containers[n].df, n, f, _kind(containers[n].df, f), kept))
        if moved:
            marks = durable(reduce(DataFrame.unionByName, moved), "marks")
            up_to = {r["container"]: r["high_water"] for r in marks.collect() if r["high_water"] is not None}
            kept = marks.unionByName(kept.filter(~F.col("container").isin(list(fields))))
    options = ScanOptions(
        incremental_fields=fields if incremental or greater_than_time or greater_than_batch else {},
        up_to=up_to,
        greater_than_time=times,
        greater_than_batch=batches,
        max_records_per_partition=max_records_analyzed_per_partition,
    )
    ours = checks.filter(F.col("container").isin(list(mine)))
    counts: dict[str, Observation] = {}
    found = durable(scan(spark, containers, ours, options, counts))
    folded = found
    if high_count_rollup_threshold is not None:
        folded = durable(an.high_count_rollup(found, high_count_rollup_threshold))
    scanned = active_checks(ours).select("check_uid")
    # Both as found and as rolled up: an anomaly of either form still fails.
    failing = found.select("fingerprint").unionByName(folded.select("fingerprint"))
    partly = incremental or capped or bool(greater_than_time or greater_than_batch)
    after = an.auto_resolve(anomalies, failing, scanned, partly, auto_resolve_passed_anomalies)
    after = an.merge_failures(after, folded, run_id, created)
    if enrichment_source_record_limit is not None:
        fresh = F.col("scan_id") == run_id
        sources = {n: (scanned_rows(n, c, options), c.keys) for n, c in mine.items()}
        enriched = an.enrich_source_records(after.filter(fresh), sources, enrichment_source_record_limit)
        after = after.filter(~fresh).unionByName(enriched)
    after = durable(after, "anomalies")
    if enrichment_root is not None:
        rows = after.filter((F.col("scan_id") == run_id) & F.col("source_enriched"))
        rows = rows.select("fingerprint", "check_uid", "container", "record_key", "source_record")
        enrichment_write(folded, enrichment_root, enrichment_prefix, remediation_strategy, rows, run_id)
    totals = scan_summary(mine, ours, found, options, counts).agg(
        F.sum("records_processed").alias("records"), F.sum("failures").alias("failures")
    ).first()
    run = run_row(
        spark, run_id, datastore, "scan", created, created,
        containers_total=len(containers), containers_analyzed=len(mine),
        records_processed=totals["records"], anomalies_identified=totals["failures"],
    )
    return ScanRun(found, after, kept, run)


def _kind(df: DataFrame, name: str) -> str:
    timed = df.schema[name].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")
    return "last-modified" if timed else "batch"


@dataclass(frozen=True)
class ProfileRun:
    """What a profile operation leaves behind."""

    profiles: DataFrame
    quantiles: DataFrame
    histograms: DataFrame
    correlations: DataFrame
    checks: DataFrame


def run_profile(
    spark: SparkSession,
    containers: Mapping[str, Container],
    registry: DataFrame,
    names: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
    level: str | int = "medium",
    infer_as_draft: bool = False,
    options: ScanOptions = ScanOptions(),
    max_count_testing_sample: int | None = MAX_TEST_SAMPLE,
    percent_testing_threshold: float = 100.0,
    high_correlation_threshold: float = 0.9,
    histogram_max_distinct_values: int = 100,
    inclusions: DataFrame | None = None,
) -> ProfileRun:
    """Profile the selected containers and keep the inferred checks that pass a trial."""
    mine = chosen(containers, registry, names, tags)
    if not mine:
        raise ValueError("no container is selected")
    parts: dict[str, list[DataFrame]] = {"p": [], "q": [], "h": [], "c": []}
    for name, container in mine.items():
        df, label = scanned_rows(name, container, options), F.lit(name).alias("container")
        fields = pr.with_exact_keys(df, durable(pr.field_profile(df, name)))
        parts["p"].append(fields)
        numbers = pr.numeric_fields(df)
        if numbers:
            parts["q"].append(pr.quantile_profile(df, numbers).select(label, "*"))
        if len(numbers) > 1:
            parts["c"].append(pr.correlation_profile(df, numbers, high_correlation_threshold).select(label, "*"))
        parts["h"].append(pr.value_histogram(df, df.columns, histogram_max_distinct_values).select(label, "*"))

    def joined(key: str, schema: str) -> DataFrame:
        empty = spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, parts[key]) if parts[key] else empty

    profiles = durable(reduce(DataFrame.unionByName, parts["p"]))
    candidates = infer_checks(profiles, level, infer_as_draft, inclusions)
    kept = test_inferred(spark, mine, candidates, max_count_testing_sample, percent_testing_threshold)
    return ProfileRun(
        profiles,
        joined("q", "container string, field string, probability double, value double"),
        joined("h", "container string, field string, value string, row_count bigint"),
        joined("c", "container string, field_a string, field_b string, correlation double"),
        kept.drop("pass_percent"),
    )


def run_materialize(
    computed: Mapping[str, DataFrame], root: str, names: Sequence[str] | None = None,
    max_records_per_partition: int | None = None,
    partition_cols: Mapping[str, Sequence[str]] | None = None,
    order_cols: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Persist computed containers below ``root`` and return them as stored."""
    out = {}
    for name, df in computed.items():
        if names and name not in names:
            continue
        by = list((partition_cols or {}).get(name, ()))
        order = list((order_cols or {}).get(name, ()))
        out[name] = materialize(df, f"{root.rstrip('/')}/{name}", max_records_per_partition, by, order)
    return out


def run_export(
    assets: Mapping[str, DataFrame], containers: DataFrame, asset_type: str, path: str,
    container_names: Sequence[str] | None = None, tags: Sequence[str] | None = None,
    include_deleted: bool = False,
) -> str:
    """Write the selected assets to ``path``, replacing an earlier export."""
    out = export_assets(assets, containers, asset_type, container_names, tags, include_deleted)
    out.write.mode("overwrite").parquet(path)
    return path
