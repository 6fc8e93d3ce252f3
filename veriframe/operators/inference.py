"""Checks inferred from statistics, and their trial on a sample."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.text import check_uid
from veriframe.operators.scan import Container, scan
from veriframe.sources.bounds import row_count
from veriframe.sources.sampling import view_sample

LEVELS = ("off", "low", "medium", "high", "xhigh", "max")
MAX_TEST_SAMPLE = None  # records tried per container; None is all of them


def level_name(level: str | int) -> str:
    """Level label; the older numbers 0 to 5 stand for the labels in order."""
    text = str(level)
    name = LEVELS[int(text)] if text.isdigit() and int(text) < len(LEVELS) else text
    if name not in LEVELS:
        raise ValueError(f"level must be one of {', '.join(LEVELS)}")
    return name


def _candidate(rule: str, when: Column, properties: Column | None = None) -> Column:
    empty = F.create_map().cast("map<string,string>")
    return F.when(
        when,
        F.struct(
            F.lit(rule).alias("rule_type"),
            (empty if properties is None else properties).alias("properties"),
        ),
    )


def _as_checks(rows: DataFrame, candidates: list[Column], status: str) -> DataFrame:
    """All candidates of a row at once, so the profile is computed once."""
    found = rows.withColumn("c", F.explode(F.array_compact(F.array(*candidates))))
    return found.select(
        "container",
        "c.rule_type",
        F.concat(F.col("c.rule_type"), F.lit(" inferred for "), F.col("field")).alias("description"),
        F.array("field").alias("fields"),
        F.lit(1.0).alias("coverage"),
        F.lit(None).cast("string").alias("filter"),
        "c.properties",
        F.array(F.lit("inferred")).alias("tags"),
        F.lit(status).alias("status"),
        F.lit(None).cast("string").alias("anomaly_message_field"),
        F.create_map().cast("map<string,string>").alias("additional_metadata"),
        F.lit(False).alias("archived"),
        check_uid(F.col("container"), F.col("c.rule_type"), F.array("field")).alias("check_uid"),
    )


def infer_checks(
    profiles: DataFrame,
    level: str | int = "medium",
    as_draft: bool = False,
    inclusions: DataFrame | None = None,
) -> DataFrame:
    """Checks that the profiled data itself satisfies.

    low: notNull; medium adds unique; high adds between and afterDateTime; xhigh
    adds matchesPattern; max adds existsIn for the given inclusion dependencies.
    unique needs exact counts: ``field_profile(exact=True)`` or, at scale,
    ``with_exact_keys`` on the sketched profile.
    """
    depth = LEVELS.index(level_name(level))
    status = "Draft" if as_draft else "Active"
    filled = (F.col("row_count") > 0) & (F.col("null_count") == 0)
    number = F.col("type").rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")
    time = F.col("type").isin("date", "timestamp", "timestamp_ntz")
    before = F.col("min").try_cast("timestamp_ntz") - F.expr("INTERVAL 1 SECOND")
    has_range = F.col("min").isNotNull()
    candidates = [_candidate("notNull", filled & F.lit(depth >= 1))]
    if depth >= 2:
        once = filled & (F.col("distinct_count") == F.col("row_count"))
        candidates.append(_candidate("unique", once))
    if depth >= 3:
        bounds = F.create_map(F.lit("min_value"), F.col("min"), F.lit("max_value"), F.col("max"))
        candidates.append(_candidate("between", number & has_range, bounds))
        after = F.create_map(F.lit("datetime"), before.cast("string"))
        candidates.append(_candidate("afterDateTime", time & has_range, after))
    if depth >= 4:
        pattern = F.create_map(F.lit("pattern"), F.col("pattern"))
        candidates.append(_candidate("matchesPattern", F.col("pattern").isNotNull(), pattern))
    out = _as_checks(profiles, candidates, status)
    if depth >= 5 and inclusions is not None:
        ref = F.create_map(
            F.lit("ref_container"), F.col("ref_container"), F.lit("field_name"), F.col("ref_field")
        )
        out = out.unionByName(_as_checks(inclusions, [_candidate("existsIn", F.lit(True), ref)], status))
    return out


def test_inferred(
    spark: SparkSession,
    containers: Mapping[str, Container],
    checks: DataFrame,
    max_count_testing_sample: int | None = MAX_TEST_SAMPLE,
    percent_testing_threshold: float = 100.0,
) -> DataFrame:
    """Candidates that pass on a sample, with ``pass_percent``.

    The sample is a repeatable random draw per container of at most the given
    number of records, or the whole container. References stay whole. A check of a
    whole container passes at 100 or fails at 0.
    """
    if max_count_testing_sample is not None and max_count_testing_sample < 1:
        raise ValueError("the testing sample needs at least one record")
    samples = {
        name: Container(
            c.df if max_count_testing_sample is None else view_sample(c.df, max_count_testing_sample, c.keys), c.keys
        )
        for name, c in containers.items()
    }
    refs = {f"{name} (all)": c for name, c in containers.items()}
    props = F.transform_values(
        "properties", lambda k, v: F.when(k == "ref_container", F.concat(v, F.lit(" (all)"))).otherwise(v)
    )
    # Draft candidates are tried like active ones.
    trial = checks.withColumn("status", F.lit("Active")).withColumn("properties", props)
    failures = scan(spark, {**samples, **refs}, trial)
    failed = failures.groupBy("check_uid").agg(
        F.count(F.lit(1)).alias("_failed"), F.bool_or(F.col("anomaly_type") == "shape").alias("_shape")
    )
    sizes = reduce(
        DataFrame.unionByName,
        [row_count(c.df).withColumn("_name", F.lit(name)) for name, c in samples.items()],
    )
    out = checks.join(sizes, checks["container"] == sizes["_name"], "inner").join(failed, "check_uid", "left")
    share = F.when(F.col("_shape"), 0.0).when(F.col("row_count") == 0, 100.0).otherwise(
        100.0 * (1 - F.coalesce("_failed", F.lit(0)) / F.col("row_count"))
    )
    return out.withColumn("pass_percent", share).filter(
        F.col("pass_percent") >= percent_testing_threshold
    ).select(*checks.columns, "pass_percent")


test_inferred.__test__ = False  # not a pytest case
