"""URL filters by host-suffix and path-prefix expressions.

Every URL is expanded into the expressions a rule may have: each suffix of its host
together with each prefix of its path. Expressions and rules meet in an equi-join
on the first hex digits of their SHA-256; the full digests are compared after it,
and of the rules that fit, the one of highest precedence gives the verdict. All of
it is built-in functions; no rule is ever compared with every URL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.skew import lookup
from veriframe.llm.common import col

ALLOW, BLOCK = "allow", "block"
SHORT = 8  # hex digits of the digest that the join is made on
#: (action, host, path), as the contract of the query fixes them.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as a table of action, host and path."""
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def host_of(url: Column) -> Column:
    """Lower-cased host; empty for null and for text without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty where there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(
    df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's. Of those
    that fit the longest wins (host and path together, then the longer host); where one host
    and path is both allowed and blocked, it is blocked. ``rule`` is host and path of the
    winner, null without one, and then ``verdict`` is ``default``. Rules without a host or
    path (null) are left out; repeated rules count once.

    A null URL, or one without ``://``, has empty host and path and fits no rule. Repeated rows
    stay repeated. A column of ``df`` named like a result is replaced by it; other extra
    columns are kept. Empty tables are fine on both sides.

    Only expressions of the lengths that rules have are made: a URL of h host labels and a
    path of p characters gives at most h times min(p + 1, number of path lengths) of them.
    Equal URLs are judged once; the verdicts are joined back by URL, hot URLs split.
    """
    results = ("host", "path", "rule", "verdict")
    kept = df.drop(*[c for c in df.columns if c.lower() in results])
    if url_col not in kept.columns:
        raise ValueError(f"{url_col} is a result's name; rename the column")
    own = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull()).groupBy("host", "path").agg(
        F.max("action").alias("action")  # block sorts after allow
    )
    own = own.select(
        F.col("host").alias("_rule_host"), F.col("path").alias("_rule_path"), "action",
        _digest(F.col("host"), F.col("path")).alias("_full"),
    ).withColumn("_short", F.substring("_full", 1, SHORT))
    # Scalar subqueries: the distinct lengths, fewer than the longest rule has characters.
    path_lengths = own.agg(F.collect_set(F.length("_rule_path"))).scalar()
    host_labels = own.agg(F.collect_set(F.size(F.split("_rule_host", r"\.")))).scalar()
    urls = kept.select(col(url_col).alias("_url")).filter(F.col("_url").contains("://")).distinct()
    urls = urls.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    expressions = (
        urls.withColumns({"_path_lengths": path_lengths, "_host_labels": host_labels})
        .withColumn("_labels", F.split("_host", r"\."))
        .withColumn("_suffixes", F.expr(
            "transform(filter(_host_labels, n -> n <= size(_labels)), n -> array_join(slice(_labels, -n, n), '.'))"
        ))
        .withColumn("_prefixes", F.expr(
            "transform(filter(_path_lengths, n -> n <= length(_path)), n -> substring(_path, 1, n))"
        ))
        .select("_url", F.explode(F.expr(
            "flatten(transform(_suffixes, h -> transform(_prefixes, p -> sha2(concat(h, '\\n', p), 256))))"
        )).alias("_full"))
        .withColumn("_short", F.substring("_full", 1, SHORT))
    )
    found = (
        expressions.join(own.withColumnRenamed("_full", "_rule_full"), "_short")
        .filter(F.col("_full") == F.col("_rule_full"))
        .groupBy("_url")
        .agg(F.max(F.struct(
            (F.length("_rule_host") + F.length("_rule_path")).alias("n"), F.length("_rule_host").alias("h"),
            F.concat("_rule_host", "_rule_path").alias("rule"), "action",
        )).alias("_won"))
        .select("_url", F.col("_won.rule").alias("rule"), F.col("_won.action").alias("verdict"))
    )
    judged = lookup(kept, [url_col], found, ["_url"])
    return judged.select(
        *[col(c) for c in kept.columns],
        host_of(col(url_col)).alias("host"),
        path_of(col(url_col)).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
