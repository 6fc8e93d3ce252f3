"""Scan: run the checks of many containers and emit failures.

The checks (metadata, a row each) come to the driver because they become the
plan; data never does. All row rules of a container are evaluated in one pass
over it, as are its row counts and, where there are several, all its set rules; every
comparison with another container reads it again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.keys import fingerprint, is_covered, record_key
from veriframe.operators import rules
from veriframe.operators.registry import active_checks
from veriframe.operators.set_rules import SetCheck, set_failures
from veriframe.sources.readers import as_mark, incremental_filter
from veriframe.sources.sampling import cap_per_partition

FAILURE_SCHEMA = (
    "check_uid string, container string, rule_type string, anomaly_type string, "
    "record_key string, message string, fingerprint string"
)
FUSE = 100  # row rules per pass; keeps generated code within JVM limits


@dataclass(frozen=True)
class Container:
    """A DataFrame under test, its key columns and its partition field."""

    df: DataFrame
    keys: Sequence[str] = ()
    partition_cols: Sequence[str] = ()
    order_cols: Sequence[str] = ()
    # Read from files as they are: the footers give the row count, and rules that reach the reader may skip row groups.
    stored: bool = False


@dataclass(frozen=True)
class ScanOptions:
    """How much of a container a scan looks at."""

    greater_than_time: Mapping[str, str] = field(default_factory=dict)
    greater_than_batch: Mapping[str, float | str] = field(default_factory=dict)
    incremental_fields: Mapping[str, str] = field(default_factory=dict)
    # Highest value of the incremental field that is looked at, as text; rows without a value are always.
    up_to: Mapping[str, str] = field(default_factory=dict)
    max_records_per_partition: int | None = None


def scanned_rows(name: str, container: Container, options: ScanOptions) -> DataFrame:
    """The rows a scan looks at: incremental first, then the per-partition cap."""
    df = container.df
    if name in options.incremental_fields:
        by = options.incremental_fields[name]
        after = (options.greater_than_time.get(name), options.greater_than_batch.get(name))
        if name in options.up_to:
            df = _between_marks(df, by, *after, options.up_to[name])
        else:
            df = incremental_filter(df, by, *after)
    return cap_per_partition(
        df, options.max_records_per_partition, container.partition_cols, container.order_cols or container.keys, container.keys
    )


def _whole(name: str, container: Container, options: ScanOptions) -> bool:
    """Whether a scan looks at all rows of a container as they are stored."""
    return container.stored and name not in options.incremental_fields and options.max_records_per_partition in (None, -1)


def _between_marks(df: DataFrame, by: str, time: str | None, batch: float | str | None, last: str) -> DataFrame:
    """Rows past the old marks and up to the new one, and rows that have no value at all."""
    kind, value = df.schema[by].dataType.simpleString(), F.col(f"`{by}`")
    inside = value <= as_mark(F.lit(last), kind)
    for mark in (time, batch):
        if mark is not None:
            inside = inside & (value > as_mark(F.lit(str(mark)), kind))
    return df.filter(inside | value.isNull())


def reference(containers: Mapping[str, Container], check: Row) -> Container:
    """The container a check refers to.

    ``ref_container``, or ``_name`` or ``_id`` behind it, names it; with ``ref_datastore`` (the
    same endings) the key ``datastore.container`` comes first, so that stores may hold
    containers of equal names. Stored checks carry ids: key the containers by them then.
    """
    props = check["properties"] or {}
    endings = ("", "_name", "_id")
    name, store = (
        next((props[f"{stem}{e}"] for e in endings if props.get(f"{stem}{e}")), None)
        for stem in ("ref_container", "ref_datastore")
    )
    for key in (f"{store}.{name}", name) if store else (name,):
        if key in containers:
            return containers[key]
    if name is None:
        raise ValueError(f"{check['check_uid']} names no reference container")
    raise ValueError(f"{check['check_uid']} refers to {store + '.' if store else ''}{name}, which is not among the containers")


def default_message(check: Row) -> str:
    fields = ", ".join(check["fields"] or ())
    return f"{check['rule_type']} failed" + (f" on {fields}" if fields else "")


def message(check: Row) -> Column:
    """Text of the failing record's message field, else of the check itself."""
    text = F.lit(check["description"] or default_message(check))
    if check["anomaly_message_field"]:
        own = F.col(f"`{check['anomaly_message_field']}`").cast("string")
        return F.coalesce(own, text)
    return text


def _scope(check: Row, key: Column) -> Column | None:
    """Filter and coverage of a check as one condition."""
    parts = [F.expr(f"({check['filter']})")] if check["filter"] else []
    covered = is_covered(key, check["coverage"])
    if covered is not None:
        parts.append(covered)
    return reduce(lambda a, b: a & b, parts) if parts else None


def _in_scope(df: DataFrame, check: Row, key: Column) -> DataFrame:
    scope = _scope(check, key)
    return df if scope is None else df.filter(scope)


def row_rule_failures(
    name: str, df: DataFrame, keys: Sequence[str], checks: Sequence[Row], rows: Observation | None = None
) -> DataFrame:
    """One failure per record and failing row rule, from a single pass, in which ``rows`` counts all records as ``n``."""
    key = record_key(df, keys)
    failing, entries = [], []
    if rows is not None:
        df = df.observe(rows, F.count(F.lit(1)).alias("n"))
        # Never true, but unknown to the optimizer: rules that cannot fail would take the count away with their pass.
        failing.append(F.spark_partition_id() < 0)
    for check in checks:
        bad = rules.row_failure(df, check["rule_type"], check["fields"] or (), check["properties"] or {})
        scope = _scope(check, key)
        bad = bad if scope is None else scope & bad
        failing.append(bad)
        entries.append(
            F.when(
                bad,
                F.struct(
                    F.lit(check["check_uid"]).alias("check_uid"),
                    F.lit(check["rule_type"]).alias("rule_type"),
                    message(check).alias("message"),
                ),
            )
        )
    # The plain OR lets Catalyst push comparisons to the scan and keeps key
    # hashing to failing rows.
    bad_rows = df.filter(reduce(lambda a, b: a | b, failing))
    found = F.explode(F.array_compact(F.array(*entries)))
    return bad_rows.select(key.alias("record_key"), found.alias("f")).select(
        F.col("f.check_uid"), F.lit(name).alias("container"), F.col("f.rule_type"),
        F.lit("record").alias("anomaly_type"), "record_key", F.col("f.message"),
    )


def _reference_fields(check: Row) -> list[str]:
    text = (check["properties"] or {}).get("field_name")
    return [f.strip() for f in text.split(",")] if text else list(check["fields"])


def set_rule_failures(
    name: str, df: DataFrame, keys: Sequence[str], checks: Sequence[Row], containers: Mapping[str, Container]
) -> DataFrame:
    """Set rules of a container: several share one pass and one shuffle, a single one needs no table of its own."""
    found = _one_set_rule(df, keys, checks[0], containers) if len(checks) == 1 else _set_rules(df, keys, checks, containers)
    return found.select(
        "check_uid", F.lit(name).alias("container"), "rule_type", F.lit("record").alias("anomaly_type"), "record_key", "message"
    )


def _set_rules(df: DataFrame, keys: Sequence[str], checks: Sequence[Row], containers: Mapping[str, Container]) -> DataFrame:
    key, prepared = record_key(df, keys), []
    for check in checks:
        ref = None if check["rule_type"] == "unique" else reference(containers, check).df
        prepared.append(
            SetCheck(
                check["check_uid"], check["rule_type"], tuple(check["fields"]), message(check), _scope(check, key),
                (check["filter"], check["coverage"]), ref, () if ref is None else tuple(_reference_fields(check)),
            )
        )
    return set_failures(df, key, prepared)


def _one_set_rule(df: DataFrame, keys: Sequence[str], check: Row, containers: Mapping[str, Container]) -> DataFrame:
    fields = list(check["fields"])
    rows = _in_scope(df, check, record_key(df, keys))
    # Key and text are made from failing rows only; with declared keys Catalyst
    # prunes everything else before a shuffle.
    if check["rule_type"] == "unique":
        bad = rules.unique_failures(rows, fields)
    else:
        ref = reference(containers, check).df
        test = rules.exists_failures if check["rule_type"] == "existsIn" else rules.not_exists_failures
        bad = test(rows, fields, ref, _reference_fields(check))
    return bad.select(
        F.lit(check["check_uid"]).alias("check_uid"), F.lit(check["rule_type"]).alias("rule_type"),
        record_key(bad, keys).alias("record_key"), message(check).alias("message"),
    )


def volumetric_failures(name: str, df: DataFrame, keys: Sequence[str], checks: Sequence[Row]) -> DataFrame:
    """All row-count checks of a container from one aggregation over it."""
    key = record_key(df, keys)
    counts, entries = [], []
    for i, check in enumerate(checks):
        scope, props = _scope(check, key), check["properties"] or {}
        n = F.count(F.lit(1)) if scope is None else F.count_if(scope)
        counts.append(n.alias(f"_{i}"))
        low, high = props.get("min_rows"), props.get("max_rows")
        passed = rules.within_rows(F.col(f"_{i}"), int(low) if low else None, int(high) if high else None)
        entries.append(
            F.when(
                ~passed,
                F.struct(
                    F.lit(check["check_uid"]).alias("check_uid"),
                    F.concat(F.lit("row count "), F.col(f"_{i}").cast("string")).alias("message"),
                ),
            )
        )
    return _shape_rows(name, "volumetric", df.agg(*counts), entries)


def aggregation_failures(
    name: str, df: DataFrame, keys: Sequence[str], checks: Sequence[Row], ref: DataFrame
) -> DataFrame:
    """Aggregate comparisons that share scope and reference: one pass over each side."""
    rows = _in_scope(df, checks[0], record_key(df, keys))
    props = [c["properties"] for c in checks]
    left = rows.agg(*[F.expr(p["expression"]).alias(f"_l{i}") for i, p in enumerate(props)])
    right = ref.agg(*[F.expr(p["ref_expression"]).alias(f"_r{i}") for i, p in enumerate(props)])
    both = left.unionByName(right, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    entries = []
    for i, check in enumerate(checks):
        a, b, how = F.col(f"_l{i}"), F.col(f"_r{i}"), props[i]["comparison"]
        passed = F.coalesce(rules.COMPARISONS[how](a, b), F.lit(False))
        text = F.concat_ws(
            " ", F.coalesce(a.cast("string"), F.lit("null")), F.lit(how),
            F.coalesce(b.cast("string"), F.lit("null")), F.lit("is false"),
        )
        found = F.struct(F.lit(check["check_uid"]).alias("check_uid"), text.alias("message"))
        entries.append(F.when(~passed, found))
    return _shape_rows(name, "aggregationComparison", both, entries)


def _shape_rows(name: str, rule: str, df: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Failures from the one-row ``df``; null entries are checks that passed."""
    found = F.explode(F.array_compact(F.array(*entries)))
    return df.select(found.alias("f")).select(
        F.col("f.check_uid"), F.lit(name).alias("container"), F.lit(rule).alias("rule_type"),
        F.lit("shape").alias("anomaly_type"), F.lit(None).cast("string").alias("record_key"),
        F.col("f.message"),
    )


def difference_failure(
    name: str, df: DataFrame, keys: Sequence[str], check: Row, ref: DataFrame
) -> DataFrame:
    """At most one failure of a replica or keyed difference, with the row count."""
    props, fields = check["properties"], list(check["fields"] or ())
    rows = _in_scope(df, check, record_key(df, keys))
    if check["rule_type"] == "isReplicaOf":
        counted = rules.replica_diff(rows, ref, fields).agg(F.sum("copies").alias("n"))
    else:
        by = [k.strip() for k in props["key_fields"].split(",")]
        counted = rules.data_diff(rows, ref, by, fields).agg(F.count(F.lit(1)).alias("n"))
    text = F.concat(F.col("n").cast("string"), F.lit(" rows differ"))
    found = F.struct(F.lit(check["check_uid"]).alias("check_uid"), text.alias("message"))
    return _shape_rows(name, check["rule_type"], counted, [F.when(F.col("n") > 0, found)])


def _chunks(checks: Sequence[Row]) -> list[Sequence[Row]]:
    return [checks[i : i + FUSE] for i in range(0, len(checks), FUSE)]


def scan(
    spark: SparkSession,
    containers: Mapping[str, Container],
    checks: DataFrame,
    options: ScanOptions = ScanOptions(),
    counts: dict[str, Observation] | None = None,
) -> DataFrame:
    """Failures of all active checks on the given containers.

    With ``counts`` the records of containers that are computed, capped or read in part are counted by the pass of their row rules; the
    observations, by container, hold ``n`` once the failures have been written. Stored containers are cheaper to count by footers.
    """
    wanted = active_checks(checks).filter(F.col("container").isin(list(containers)))
    by_container: dict[str, list[Row]] = {}
    for check in sorted(wanted.collect(), key=lambda c: (c["container"], c["check_uid"])):
        by_container.setdefault(check["container"], []).append(check)
    parts: list[DataFrame] = []
    for name, mine in by_container.items():
        keys = containers[name].keys
        df = scanned_rows(name, containers[name], options)
        by_rule: dict[str, list[Row]] = {}
        for check in mine:
            rule = check["rule_type"]
            if rule not in rules.ROW_RULES + rules.SET_RULES + rules.SHAPE_RULES:
                raise ValueError(f"unknown rule type {rule}")
            kind = "row" if rule in rules.ROW_RULES else "set" if rule in rules.SET_RULES else rule
            by_rule.setdefault(kind, []).append(check)
        for i, some in enumerate(_chunks(by_rule.get("row", []))):
            observed = None
            if counts is not None and i == 0 and not _whole(name, containers[name], options):
                observed = counts[name] = Observation()
            parts.append(row_rule_failures(name, df, keys, some, observed))
        parts += [volumetric_failures(name, df, keys, c) for c in _chunks(by_rule.get("volumetric", []))]
        same_scope: dict[tuple, list[Row]] = {}
        for check in by_rule.get("aggregationComparison", []):
            scope = (check["filter"], check["coverage"], id(reference(containers, check)))
            same_scope.setdefault(scope, []).append(check)
        for group in same_scope.values():
            ref = reference(containers, group[0]).df
            parts += [aggregation_failures(name, df, keys, c, ref) for c in _chunks(group)]
        parts += [set_rule_failures(name, df, keys, c, containers) for c in _chunks(by_rule.get("set", []))]
        for rule in ("isReplicaOf", "dataDiff"):
            for check in by_rule.get(rule, []):
                ref = reference(containers, check).df
                parts.append(difference_failure(name, df, keys, check, ref))
    if not parts:
        return spark.createDataFrame([], FAILURE_SCHEMA)
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("fingerprint", fingerprint(F.col("check_uid"), F.col("record_key")))


def incremental_scan(
    spark: SparkSession,
    containers: Mapping[str, Container],
    checks: DataFrame,
    fields: Mapping[str, str],
    marks: Mapping[str, str],
) -> DataFrame:
    """Scan of the records past each container's last high-water mark."""
    options = ScanOptions(incremental_fields=fields, greater_than_time=marks)
    return scan(spark, containers, checks, options)


def record_anomalies(failures: DataFrame) -> DataFrame:
    """One row per failing record and check; identical records are counted."""
    return _grouped(failures.filter(F.col("anomaly_type") == "record"))


def shape_anomalies(failures: DataFrame) -> DataFrame:
    """One row per failing container-level check."""
    return _grouped(failures.filter(F.col("anomaly_type") == "shape"))


def _grouped(failures: DataFrame) -> DataFrame:
    by = ["fingerprint", "check_uid", "container", "rule_type", "anomaly_type", "record_key"]
    return failures.groupBy(*by).agg(
        F.min("message").alias("message"), F.count(F.lit(1)).alias("failing_rows")
    )


def scan_summary(
    containers: Mapping[str, Container],
    checks: DataFrame,
    failures: DataFrame,
    options: ScanOptions = ScanOptions(),
    counts: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """Per container: records processed, checks run, checks failing, failures.

    ``counts`` are the observations of the :func:`scan` whose failures were written before this is called; containers without one are counted here.
    """
    observed, counted = counts or {}, []
    for name, c in containers.items():
        if name in observed:
            n = failures.sparkSession.createDataFrame([(observed[name].get["n"],)], "records_processed bigint")
        else:
            n = scanned_rows(name, c, options).agg(F.count(F.lit(1)).alias("records_processed"))
        counted.append(n.withColumn("container", F.lit(name)))
    counted = reduce(DataFrame.unionByName, counted)
    run = active_checks(checks).groupBy("container").agg(F.count(F.lit(1)).alias("checks_run"))
    failed = (
        failures.groupBy("container", "check_uid").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("container")
        .agg(F.count(F.lit(1)).alias("checks_failing"), F.sum("n").alias("failures"))
    )
    out = counted.join(run, "container", "left").join(failed, "container", "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "container", "records_processed",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("checks_run", "checks_failing", "failures")],
    )
