"""Observability measurements and quality scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Which dimension a rule speaks for.
DIMENSION_OF_RULE = {
    "notNull": "completeness",
    "matchesPattern": "conformity",
    "existsIn": "consistency",
    "notExistsIn": "consistency",
    "isReplicaOf": "consistency",
    "dataDiff": "consistency",
    "between": "precision",
    "afterDateTime": "timeliness",
    "volumetric": "volume",
    "satisfiesExpression": "accuracy",
    "aggregationComparison": "accuracy",
    "unique": "uniqueness",
}
DIMENSIONS = (
    "completeness", "conformity", "consistency", "precision",
    "timeliness", "volume", "accuracy", "uniqueness",
)


def volume(df: DataFrame, ts: str, bucket: str = "day") -> DataFrame:
    """Rows per time bucket (``hour``, ``day``, ``week``, ``month``, ...)."""
    start = F.date_trunc(bucket, F.col(f"`{ts}`")).cast("timestamp_ntz")
    return df.groupBy(start.alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"))


def freshness(df: DataFrame, ts: str, as_of: str) -> DataFrame:
    """Latest timestamp and its lag in seconds behind ``as_of``."""
    latest = df.agg(F.max(F.col(f"`{ts}`")).alias("latest"))
    now = F.lit(as_of).cast("timestamp_ntz")
    lag = F.timestamp_diff("SECOND", F.col("latest").cast("timestamp_ntz"), now)
    return latest.select("latest", lag.alias("lag_seconds"))


def null_check(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Null count per field; one pass, then wide to long on a single row."""
    fields = list(fields or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{f}`").isNull()).alias(f"_n{i}") for i, f in enumerate(fields)],
    )
    entries = [
        F.struct(F.lit(f).alias("field"), F.col(f"_n{i}").alias("null_count"))
        for i, f in enumerate(fields)
    ]
    long = wide.select(F.col("_rows").alias("row_count"), F.explode(F.array(*entries)).alias("e"))
    return long.select("e.field", "row_count", "e.null_count")


def latest_measurement(measurements: DataFrame, by: str = "container", ts: str = "measured_at") -> DataFrame:
    """The newest measurement per container, combined map-side."""
    rest = [c for c in measurements.columns if c != by]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(ts), *[c for c in rest if c != ts]))
    return measurements.groupBy(by).agg(newest.alias("m")).select(by, *[f"m.{c}" for c in rest])


def quality_scores(summary: DataFrame, by: Sequence[str] = ("container",)) -> DataFrame:
    """Overall and eight dimension scores from ``rule_type, checked, failed`` rows.

    A score is ``100 * (1 - failed / checked)``; overall is the mean of the
    dimensions that have one.
    """
    pairs = [F.lit(x) for rule, dim in DIMENSION_OF_RULE.items() for x in (rule, dim)]
    dimension = F.try_element_at(F.create_map(*pairs), F.col("rule_type"))
    score = 100.0 * (1 - F.sum("failed") / F.sum("checked"))
    wide = (
        summary.withColumn("dimension", dimension)
        .groupBy(*by)
        .pivot("dimension", list(DIMENSIONS))
        .agg(score)
    )
    present = F.array_compact(F.array(*[F.col(d) for d in DIMENSIONS]))
    total = F.aggregate(present, F.lit(0.0), lambda a, x: a + x)
    return wide.withColumn("overall", F.when(F.size(present) > 0, total / F.size(present)))


def datastore_counts(
    containers: DataFrame, profiles: DataFrame, checks: DataFrame, anomalies: DataFrame
) -> DataFrame:
    """Containers, fields, records, checks and open anomalies per datastore.

    Every side is summed per container before it meets the others, so a
    container with very many checks or anomalies is one row in each join.
    """
    base = containers.select("datastore", F.col("name").alias("container"))
    fields = profiles.groupBy("container").agg(
        F.count(F.lit(1)).alias("fields"), F.max("row_count").alias("records")
    )
    n_checks = checks.groupBy("container").agg(F.count(F.lit(1)).alias("checks"))
    n_anomalies = (
        anomalies.filter(~F.coalesce("archived", F.lit(False)))
        .groupBy("container")
        .agg(F.count(F.lit(1)).alias("anomalies"))
    )
    joined = base
    for part in (fields, n_checks, n_anomalies):
        joined = joined.join(part, "container", "left")
    names = {
        "fields": "field_count", "records": "record_count",
        "checks": "check_count", "anomalies": "anomaly_count",
    }
    sums = [
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name) for c, name in names.items()
    ]
    return joined.groupBy("datastore").agg(F.count(F.lit(1)).alias("container_count"), *sums)
