"""Anomalies: merging scans, resolving, rolling up, enriching, maintaining."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.functions.keys import fingerprint, record_key
from veriframe.functions.skew import attach, first_by_hash, lookup

# The statuses of an anomaly.
OPEN_STATUSES = ("Active", "Acknowledged")
ARCHIVE_STATUSES = ("Resolved", "Invalid", "Duplicate", "Discarded")

ANOMALY_COLUMNS = (
    "id string, check_uid string, container string, rule_type string, anomaly_type string, "
    "record_key string, message string, fingerprint string, failing_rows bigint, status string, "
    "scan_id string, created timestamp_ntz, weight int, description string, tags array<string>, "
    "assignee_ids array<int>, source_enriched boolean, source_record string, archived boolean"
)


def is_open() -> Column:
    return F.col("status").isin(list(OPEN_STATUSES)) & ~F.coalesce("archived", F.lit(False))


def new_anomalies(failures: DataFrame, scan_id: str, created: str, weight: int = 1) -> DataFrame:
    """Active anomalies of a scan, one per fingerprint.

    ``failing_rows`` of the failures, where they have it, says how many rows each stands for.
    """
    by = ["check_uid", "container", "rule_type", "anomaly_type", "record_key", "fingerprint"]
    stands_for = F.count(F.lit(1))
    if "failing_rows" in failures.columns:
        stands_for = F.sum(F.coalesce("failing_rows", F.lit(1).cast("bigint")))
    one = failures.groupBy(*by).agg(F.min("message").alias("message"), stands_for.alias("failing_rows"))
    return one.select(
        F.sha2(F.concat_ws("|", "fingerprint", F.lit(scan_id)), 256).alias("id"),
        "check_uid", "container", "rule_type", "anomaly_type", "record_key", "message",
        "fingerprint", "failing_rows",
        F.lit("Active").alias("status"),
        F.lit(scan_id).alias("scan_id"),
        F.lit(created).cast("timestamp_ntz").alias("created"),
        F.lit(weight).alias("weight"),
        F.lit(None).cast("string").alias("description"),
        F.array().cast("array<string>").alias("tags"),
        F.array().cast("array<int>").alias("assignee_ids"),
        F.lit(False).alias("source_enriched"),
        F.lit(None).cast("string").alias("source_record"),
        F.lit(False).alias("archived"),
    )


def merge_failures(
    anomalies: DataFrame, failures: DataFrame, scan_id: str, created: str
) -> DataFrame:
    """Keep what is known, append failures without an open anomaly as Active.

    Archived anomalies stay; a fingerprint that fails again opens a new row.
    Fingerprints are unique on both sides of the join, so none is hot.
    """
    fresh = new_anomalies(failures, scan_id, created)
    known = anomalies.filter(is_open()).select(F.col("fingerprint").alias("_known")).distinct()
    added = fresh.join(known, fresh["fingerprint"] == known["_known"], "left_anti")
    return anomalies.unionByName(added)


def _flag(df: DataFrame, on: str, members: DataFrame, name: str) -> DataFrame:
    """Adds a boolean: is ``on`` among the values of the one-column ``members``?"""
    keys = members.toDF("_m").filter(F.col("_m").isNotNull()).distinct().withColumn(name, F.lit(True))
    return lookup(df, [on], keys, ["_m"]).withColumn(name, F.coalesce(name, F.lit(False)))


def auto_resolve(
    anomalies: DataFrame,
    failures: DataFrame,
    scanned_checks: DataFrame,
    incremental: bool = False,
    enabled: bool = True,
) -> DataFrame:
    """Resolve open anomalies of scanned checks whose fingerprint no longer fails.

    Off for incremental scans whatever the flag, as those do not see old records.
    """
    if incremental or not enabled:
        return anomalies
    failing = _flag(anomalies, "fingerprint", failures.select("fingerprint"), "_fails")
    seen = _flag(failing, "check_uid", scanned_checks.select("check_uid"), "_scanned")
    passed = is_open() & F.col("_scanned") & ~F.col("_fails")
    return seen.withColumns(
        {
            "status": F.when(passed, "Resolved").otherwise(F.col("status")),
            "archived": passed | F.coalesce("archived", F.lit(False)),
        }
    ).select(*anomalies.columns)


def high_count_rollup(failures: DataFrame, threshold: int) -> DataFrame:
    """Record failures of a check above ``threshold`` become one shape failure.

    ``failing_rows`` counts what a row stands for.
    """
    records = failures.filter(F.col("anomaly_type") == "record")
    others = failures.filter(F.col("anomaly_type") != "record")
    sizes = records.groupBy("check_uid").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("container").alias("container"),
        F.min("rule_type").alias("rule_type"),
    )
    few = sizes.select("check_uid", "_n", (F.col("_n") <= threshold).alias("_few"))
    single = attach(records, few, ["check_uid"], keep="_few").drop("_n", "_few")
    many = sizes.filter(F.col("_n") > threshold).select(
        "check_uid", "container", "rule_type",
        F.lit("shape").alias("anomaly_type"),
        F.lit(None).cast("string").alias("record_key"),
        F.concat(F.col("_n").cast("string"), F.lit(" records failed")).alias("message"),
        fingerprint(F.col("check_uid"), F.lit(None).cast("string")).alias("fingerprint"),
        F.col("_n").alias("failing_rows"),
    )
    one = F.lit(1).cast("bigint")
    return (
        single.withColumn("failing_rows", one)
        .unionByName(others.withColumn("failing_rows", one))
        .unionByName(many)
    )


def enrich_source_records(
    anomalies: DataFrame, sources: Mapping[str, tuple[DataFrame, Sequence[str]]], limit: int
) -> DataFrame:
    """Attach the source row to at most ``limit`` record anomalies, by fingerprint order.

    ``sources`` gives each container's rows and key columns.
    """
    if limit < 1:
        raise ValueError("the source record limit must be at least 1")
    records = anomalies.filter(
        (F.col("anomaly_type") == "record") & F.col("container").isin(list(sources))
    ).select("fingerprint", "container", "record_key")
    chosen = first_by_hash(records.distinct(), "fingerprint", limit)
    found = []
    for name, (df, keys) in sources.items():
        wanted = chosen.filter(F.col("container") == name)
        members = wanted.select(F.col("record_key").alias("_key")).distinct()
        packed = df.select(record_key(df, keys).alias("_rk"), F.struct(*df.columns).alias("_row"))
        # At most ``limit`` keys; copies of a row collapse before the shuffle.
        source = (
            packed.join(members, packed["_rk"] == members["_key"], "left_semi")
            .groupBy("_rk")
            .agg(F.min(F.to_json("_row")).alias("_source"))
        )
        found.append(
            wanted.join(source, wanted["record_key"] == source["_rk"], "inner").select(
                F.col("fingerprint").alias("_f"), "_source"
            )
        )
    rows = reduce(DataFrame.unionByName, found)
    keep = [c for c in anomalies.columns if c not in ("source_enriched", "source_record")]
    enriched, record = F.col("_source").isNotNull(), F.col("_source")
    if "source_enriched" in anomalies.columns:
        enriched = enriched | F.coalesce("source_enriched", F.lit(False))
        record = F.coalesce("_source", "source_record")
    return anomalies.join(rows, anomalies["fingerprint"] == rows["_f"], "left").select(
        *keep, enriched.alias("source_enriched"), record.alias("source_record")
    )


def anomaly_list(
    anomalies: DataFrame,
    container: str | None = None,
    check_uid: str | None = None,
    statuses: Sequence[str] | None = None,
    anomaly_type: str | None = None,
    tags: Sequence[str] | None = None,
    rule_types: Sequence[str] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    timeframe_days: int | None = None,
    as_of: str | None = None,
    source_enriched: bool | None = None,
    archived: str | None = None,
    sort_created: str | None = None,
    sort_weight: str | None = None,
) -> DataFrame:
    """Filtered anomalies.

    Asking only for archived statuses shows archived ones only, a mix shows both,
    anything else the open ones. Dates include the whole end day.
    """
    out = anomalies
    if statuses and archived is None:
        done = [s for s in statuses if s in ARCHIVE_STATUSES]
        live = [s for s in statuses if s in OPEN_STATUSES]
        archived = ("include" if live else "only") if done else None
    is_archived = F.coalesce("archived", F.lit(False))
    if archived == "only":
        out = out.filter(is_archived)
    elif archived != "include":
        out = out.filter(~is_archived)
    for name, value in (
        ("container", container), ("check_uid", check_uid), ("anomaly_type", anomaly_type),
        ("source_enriched", source_enriched),
    ):
        if value is not None:
            out = out.filter(F.col(name) == F.lit(value))
    if statuses:
        out = out.filter(F.col("status").isin(list(statuses)))
    if rule_types:
        out = out.filter(F.col("rule_type").isin(list(rule_types)))
    if tags:
        out = out.filter(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])))
    if start_date:
        out = out.filter(F.col("created") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date:
        after = F.date_add(F.lit(end_date).cast("date"), 1)
        out = out.filter(F.col("created") < after.cast("timestamp_ntz"))
    if timeframe_days is not None:
        since = F.date_sub(F.lit(as_of).cast("date"), timeframe_days)
        out = out.filter(F.col("created") >= since.cast("timestamp_ntz"))
    order = [
        F.col(c).desc() if way == "desc" else F.col(c).asc()
        for c, way in (("created", sort_created), ("weight", sort_weight))
        if way
    ]
    return out.orderBy(*order) if order else out


def anomaly_update(anomalies: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply ``id, status, description, tags, assignee_ids``; null keeps, [] clears.

    Only open statuses can be set; an update with another status is not applied
    (see :func:`rejected_updates`). Of several updates of an id the greatest counts.
    """
    valid = updates.filter(F.col("status").isin(list(OPEN_STATUSES)))
    names = ["status", "description", "tags", "assignee_ids"]
    new = valid.groupBy(F.col("id").alias("_id")).agg(F.max(F.struct(*names)).alias("_new"))
    new = new.select("_id", *[F.col("_new")[c].alias(f"_{c}") for c in names])
    joined = anomalies.join(new, anomalies["id"] == new["_id"], "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in names else F.col(c)
            for c in anomalies.columns
        ]
    )


def rejected_updates(updates: DataFrame) -> DataFrame:
    bad = ~F.coalesce(F.col("status").isin(list(OPEN_STATUSES)), F.lit(False))
    return updates.filter(bad)


def anomaly_archive(anomalies: DataFrame, ids: DataFrame, status: str = "Resolved") -> DataFrame:
    """Soft delete with an archive status."""
    if status not in ARCHIVE_STATUSES:
        raise ValueError(f"archive status must be one of {', '.join(ARCHIVE_STATUSES)}")
    chosen = ids.select(F.col("id").alias("_id")).distinct()
    joined = anomalies.join(chosen, anomalies["id"] == chosen["_id"], "left")
    hit = F.col("_id").isNotNull()
    return joined.withColumns(
        {
            "status": F.when(hit, F.lit(status)).otherwise(F.col("status")),
            "archived": hit | F.coalesce("archived", F.lit(False)),
        }
    ).select(*anomalies.columns)


def anomaly_delete(anomalies: DataFrame, ids: DataFrame) -> DataFrame:
    """Hard delete."""
    return anomalies.join(ids.select("id").distinct(), "id", "left_anti")


def run_history(
    runs: DataFrame,
    datastores: Sequence[str] | None = None,
    operation_type: str | None = None,
    results: Sequence[str] | None = None,
    finished: bool | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """Operations, newest first; dates include the whole end day."""
    out = runs
    if datastores:
        out = out.filter(F.col("datastore").isin(list(datastores)))
    if operation_type:
        out = out.filter(F.col("type") == operation_type)
    if results:
        out = out.filter(F.col("result").isin(list(results)))
    if finished is not None:
        done = F.col("end_time").isNotNull()
        out = out.filter(done if finished else ~done)
    if start_date:
        out = out.filter(F.col("created") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date:
        after = F.date_add(F.lit(end_date).cast("date"), 1)
        out = out.filter(F.col("created") < after.cast("timestamp_ntz"))
    return out.orderBy(F.col("created").desc(), F.col("id").desc())
