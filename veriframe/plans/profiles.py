"""Queries P and O: profiles, inference, observability and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.skew import rows_by_membership
from veriframe.operators import inference, observe, profile, sketches
from veriframe.operators.registry import Check, checks_frame
from veriframe.operators.scan import Container
from veriframe.plans.common import ANOMALIES, CHECKS, CONTAINERS, duck, frame, table
from veriframe.plans.rules import HOLED
from veriframe.session import durable
from veriframe.sources.sinks import select_containers


def map_text(col: Column) -> Column:
    """A map as ``key=value`` pairs in key order."""
    pairs = F.transform(
        F.map_entries(col), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))
    )
    return F.array_join(F.array_sort(pairs), ";")


def _readable(df: DataFrame) -> DataFrame:
    """Rounded figures; lengths as text because they are null for numbers."""
    return df.withColumns(
        {
            "completeness": F.round("completeness", 6),
            "mean": F.round("mean", 4),
            "stddev": F.round("stddev", 4),
            "min_length": F.col("min_length").cast("string"),
            "max_length": F.col("max_length").cast("string"),
        }
    )


def q_field_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(profile.field_profile(frame(spark, sf, HOLED), "orders", exact=True))


APPROX_FIELDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag"]


def q_approx_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """The sketch against the exact count: within five standard errors."""
    lines = table(spark, sf, "lineitem")
    approx = profile.approx_distinct(lines, APPROX_FIELDS, 0.02)
    exact = lines.agg(*[F.count_distinct(c).alias(c) for c in APPROX_FIELDS]).unpivot(
        [], APPROX_FIELDS, "field", "exact_count"
    )
    near = F.abs(F.col("distinct_count") - F.col("exact_count")) <= 0.1 * F.col("exact_count")
    return approx.join(exact, "field").select("field", "exact_count", near.alias("within"))


QUANTILE_FIELDS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_quantile_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.quantile_profile(
        table(spark, sf, "lineitem"), QUANTILE_FIELDS, [0.0, 0.25, 0.5, 0.75, 0.99], exact=True
    )
    return out.withColumn("value", F.round("value", 6))


UNTYPED = """
SELECT CAST(o_orderkey AS STRING) AS a_key, CAST(o_totalprice AS STRING) AS b_price,
       substr(CAST(o_orderdate AS STRING), 1, 10) AS c_date, CAST(o_orderdate AS STRING) AS d_time,
       CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'FALSE' END AS e_flag, o_orderpriority AS f_text,
       CASE WHEN o_totalprice > 490000 THEN CAST(o_totalprice AS STRING) ELSE CAST(o_custkey AS STRING) END AS g_mixed,
       CASE WHEN o_totalprice > 490000 THEN CAST(o_custkey AS STRING) END AS h_sparse
FROM {orders}
"""
UNTYPED_FIELDS = ["a_key", "b_price", "c_date", "d_time", "e_flag", "f_text", "g_mixed", "h_sparse"]


def q_type_inference(spark: SparkSession, sf: str) -> DataFrame:
    return profile.infer_types(frame(spark, sf, UNTYPED), UNTYPED_FIELDS)


HISTOGRAM_FIELDS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_partkey"]


def q_value_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_histogram(table(spark, sf, "lineitem"), HISTOGRAM_FIELDS, 10)


PRICED = """
SELECT l_quantity, l_extendedprice, l_discount, l_extendedprice * (1 - l_discount) AS net, 50 - l_quantity AS rest
FROM {lineitem}
"""
PRICED_FIELDS = ["l_quantity", "l_extendedprice", "l_discount", "net", "rest"]


def q_correlation_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.correlation_profile(frame(spark, sf, PRICED), PRICED_FIELDS, 0.5)


INCLUSIONS = [
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("customer", "c_custkey", "supplier", "s_suppkey"),
]


def q_infer_checks(spark: SparkSession, sf: str) -> DataFrame:
    frames = {"orders": frame(spark, sf, HOLED)}
    frames.update({n: table(spark, sf, n) for n in ("customer", "nation", "supplier")})
    profiles = profile.field_profile(frames["orders"], "orders", exact=True).unionByName(
        profile.field_profile(frames["customer"], "customer", exact=True)
    )
    checks = inference.infer_checks(
        profiles, "5", as_draft=True, inclusions=profile.inclusion_dependencies(frames, INCLUSIONS)
    )
    return checks.select("check_uid", "rule_type", "status", map_text(F.col("properties")).alias("properties"))


CANDIDATES = [
    Check("orders", "notNull", ["o_custkey"]),
    Check("orders", "notNull", ["o_orderpriority"]),
    Check("orders", "between", ["o_totalprice"], {"min_value": 10000}, status="Draft"),
    Check("orders", "between", ["o_custkey"], {"max_value": 100}),
    Check("orders", "existsIn", ["o_custkey"], {"ref_container": "customer", "field_name": "c_custkey"}),
    Check("customer", "satisfiesExpression", [], {"expression": "c_acctbal > 0"}),
]


def q_test_inferred_checks(spark: SparkSession, sf: str) -> DataFrame:
    containers = {
        "orders": Container(frame(spark, sf, HOLED), ["o_orderkey"]),
        "customer": Container(table(spark, sf, "customer"), ["c_custkey"]),
    }
    kept = inference.test_inferred(spark, containers, checks_frame(spark, CANDIDATES), 1000, 90.0)
    return kept.select("check_uid", F.round("pass_percent", 4).alias("pass_percent"))


def q_profile_selected(spark: SparkSession, sf: str) -> DataFrame:
    """Row statistics of the selected containers only: orders of some customers."""
    chosen = select_containers(frame(spark, sf, CONTAINERS, "tags"), tags=["machinery", "n7"])
    rows = rows_by_membership(frame(spark, sf, ANOMALIES), ["container"], chosen, ["name"], present=True)
    out = profile.field_profile(rows.select("status", "weight", "created"), "selected", exact=True)
    return _readable(out)


def q_profile_incremental(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.profile_incremental(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
        "orders", "o_orderdate", greater_than_time="1999-12-31 00:00:00",
        max_records_per_partition=2, partition_cols=["o_custkey"], order_cols=["o_orderdate", "o_orderkey"],
        exact=True,
    )
    return _readable(out)


INCLUDED = {
    "region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_regionkey", "n_name"], "customer": ["c_custkey", "c_nationkey", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_nationkey"], "part": ["p_partkey", "p_size"], "orders": ["o_orderkey", "o_custkey", "o_orderstatus"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"],
}


def q_inclusions(spark: SparkSession, sf: str) -> DataFrame:
    """Which key and code fields of seven tables lie in which others: all pairs, from one shuffle of values."""
    return profile.all_inclusions({name: table(spark, sf, name).select(*fields) for name, fields in INCLUDED.items()})


def q_profile_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Orders profiled in three goes, each over the rows past the last one's mark, against their exact figures."""
    orders = frame(spark, sf, HOLED).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    stored, mark = None, "1900-01-01 00:00:00"
    for upto in ("1998-01-01 00:00:00", "2000-06-30 00:00:00", "2900-01-01 00:00:00"):
        part = orders.filter(F.col("o_orderdate") <= F.lit(upto).cast("timestamp_ntz"))
        stored = durable(sketches.profile_update(stored, part, "orders", "o_orderdate", greater_than_time=mark), "states")
        mark = upto
    out = sketches.described(stored)
    exact = profile.exact_distinct(orders, orders.columns).select(F.col("field").alias("_f"), F.col("distinct_count").alias("_d"))
    numbers = profile.numeric_fields(orders)
    middles = profile.quantile_profile(orders, numbers, [0.5 - 2 * sketches.RANK_ERROR, 0.5 + 2 * sketches.RANK_ERROR], exact=True)
    around = middles.groupBy(F.col("field").alias("_g")).agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    both = out.join(exact, F.col("field") == F.col("_f")).join(around, F.col("field") == F.col("_g"), "left")
    return both.select(
        "field", "row_count", "null_count", "min", "max", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"), "pattern",
        (F.abs(F.col("distinct_count") - F.col("_d")) <= 4 * sketches.DISTINCT_ERROR * F.col("_d")).alias("distinct_close"),
        F.coalesce(F.col("quantiles")[1].between(F.col("_low"), F.col("_high")), F.col("quantiles").isNull()).alias("median_close"),
    )


# --- observability ---------------------------------------------------------


def q_volume(spark: SparkSession, sf: str) -> DataFrame:
    days = observe.volume(table(spark, sf, "events"), "ts", "day")
    months = observe.volume(table(spark, sf, "lineitem"), "l_shipdate", "month")
    both = days.withColumn("width", F.lit("day")).unionByName(months.withColumn("width", F.lit("month")))
    return both.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd"))


def q_freshness(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        observe.freshness(table(spark, sf, name), ts, "2024-02-01 00:00:00").withColumn("container", F.lit(name))
        for name, ts in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("latest", F.date_format("latest", "yyyy-MM-dd HH:mm:ss"))


def q_null_check(spark: SparkSession, sf: str) -> DataFrame:
    return observe.null_check(frame(spark, sf, HOLED))


MEASUREMENTS = """
SELECT 'user_' || CAST(user_id AS STRING) AS container, ts AS measured_at, event_id, event_type AS kind, value FROM {events}
"""


def q_latest_measurement(spark: SparkSession, sf: str) -> DataFrame:
    return observe.latest_measurement(frame(spark, sf, MEASUREMENTS)).select(
        "container", "event_id", "kind", "value"
    )


RULE_RESULTS = """
SELECT 'supplier_' || CAST(l_suppkey AS STRING) AS container,
       CASE l_linenumber WHEN 1 THEN 'notNull' WHEN 2 THEN 'unique' WHEN 3 THEN 'matchesPattern' WHEN 4 THEN 'between'
            WHEN 5 THEN 'existsIn' WHEN 6 THEN CASE l_returnflag WHEN 'R' THEN 'dataDiff' ELSE 'satisfiesExpression' END
            ELSE CASE l_returnflag WHEN 'R' THEN 'afterDateTime' ELSE 'volumetric' END END AS rule_type,
       CAST(l_quantity AS BIGINT) AS checked, CAST(floor(l_quantity * l_discount) AS BIGINT) AS failed
FROM {lineitem}
"""


def q_quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = observe.quality_scores(frame(spark, sf, RULE_RESULTS))
    return scores.select(
        "container", *[F.round(c, 6).alias(c) for c in (*observe.DIMENSIONS, "overall")]
    )


PROFILE_ROWS = """
SELECT 'customer_' || CAST(o_custkey AS STRING) AS container, o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS row_count FROM {orders}
"""


def q_datastore_counts(spark: SparkSession, sf: str) -> DataFrame:
    return observe.datastore_counts(
        frame(spark, sf, CONTAINERS), frame(spark, sf, PROFILE_ROWS),
        frame(spark, sf, CHECKS), frame(spark, sf, ANOMALIES),
    )


QUERIES = {
    "field_profile": q_field_profile,
    "approx_distinct": q_approx_distinct,
    "quantile_profile": q_quantile_profile,
    "type_inference": q_type_inference,
    "value_histogram": q_value_histogram,
    "correlation_profile": q_correlation_profile,
    "infer_checks": q_infer_checks,
    "test_inferred_checks": q_test_inferred_checks,
    "profile_selected": q_profile_selected,
    "profile_incremental": q_profile_incremental,
    "profile_sketches": q_profile_sketches,
    "inclusions": q_inclusions,
    "volume": q_volume,
    "freshness": q_freshness,
    "null_check": q_null_check,
    "latest_measurement": q_latest_measurement,
    "quality_scores": q_quality_scores,
    "datastore_counts": q_datastore_counts,
}


def _mask(col: str) -> str:
    out = col
    for cls, mark in (("[A-Z]+", 1), ("[a-z]+", 2), ("[0-9]+", 3)):
        out = f"regexp_replace({out}, '{cls}', chr({mark}), 'g')"
    out = f"regexp_replace({out}, '([\\\\\\[\\](){{}}.*+?^$|])', '\\\\\\1', 'g')"
    for cls, mark in (("[A-Z]+", 1), ("[a-z]+", 2), ("[0-9]+", 3)):
        out = f"replace({out}, chr({mark}), '{cls}')"
    return out


def _profile_sql(container: str, source: str, kinds: dict[str, str]) -> str:
    parts = []
    for name, kind in kinds.items():
        number = kind in ("bigint", "int", "double")
        text = kind == "string"
        mean = f"round(avg({name}), 4), round(stddev_samp({name}), 4)" if number else "NULL::DOUBLE, NULL::DOUBLE"
        lengths = (
            f"CAST(min(length({name})) AS VARCHAR), CAST(max(length({name})) AS VARCHAR), "
            f"CASE WHEN min({_mask(name)}) = max({_mask(name)}) THEN min({_mask(name)}) END"
            if text
            else "NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR"
        )
        parts.append(
            f"SELECT '{container}' AS container, '{name}' AS field, '{kind}' AS type, count(*) AS row_count, "
            f"count(*) - count({name}) AS null_count, round(count({name}) / count(*), 6) AS completeness, "
            f"count(DISTINCT {name}) AS distinct_count, CAST(min({name}) AS VARCHAR) AS min, "
            f"CAST(max({name}) AS VARCHAR) AS max, {mean}, {lengths} FROM {source} s"
        )
    body = " UNION ALL ".join(parts)
    names = (
        "container, field, type, row_count, null_count, completeness, distinct_count, min, max, "
        "mean, stddev, min_length, max_length, pattern"
    )
    return f"SELECT * FROM ({body}) p({names})"


_ORDER_KINDS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderpriority": "string",
    "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
}
_CUSTOMER_KINDS = {
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
    "c_mktsegment": "string",
}
_PROFILES = (
    f"({_profile_sql('orders', duck(HOLED), _ORDER_KINDS)} UNION ALL "
    f"{_profile_sql('customer', 'customer', _CUSTOMER_KINDS)})"
)


def _is(col: str, kind: str) -> str:
    return {
        "boolean": f"lower({col}) IN ('true', 'false')",
        "bigint": f"regexp_full_match({col}, '[+-]?[0-9]+')",
        "double": f"TRY_CAST({col} AS DOUBLE) IS NOT NULL",
        "date": f"regexp_full_match({col}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')",
        "timestamp_ntz": f"TRY_CAST({col} AS TIMESTAMP) IS NOT NULL",
    }[kind]


def _inferred(col: str) -> str:
    cases = " ".join(
        f"WHEN count_if({_is(col, k)}) = count({col}) THEN '{k}'"
        for k in ("boolean", "bigint", "double", "date", "timestamp_ntz")
    )
    return f"SELECT '{col}' AS field, CASE {cases} ELSE 'string' END AS inferred_type FROM {duck(UNTYPED)} u"


def _pairs(names: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]


def _included(c: str, f: str, rc: str, rf: str) -> str:
    source = duck(HOLED) if c == "orders" else c
    return f"""SELECT '{c}__existsin__{f}' AS check_uid, 'existsIn' AS rule_type,
        'field_name={rf};ref_container={rc}' AS properties
        WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {f} IS NOT NULL AND {f} NOT IN (SELECT {rf} FROM {rc}))"""


_SCORES = {
    "completeness": ["notNull"], "conformity": ["matchesPattern"], "consistency": ["existsIn", "dataDiff"],
    "precision": ["between"], "timeliness": ["afterDateTime"], "volume": ["volumetric"],
    "accuracy": ["satisfiesExpression"], "uniqueness": ["unique"],
}


def _score(rules: list[str]) -> str:
    names = ", ".join(f"'{r}'" for r in rules)
    return (
        f"100.0::DOUBLE * (1 - (sum(failed) FILTER (rule_type IN ({names})))::DOUBLE"
        f" / (sum(checked) FILTER (rule_type IN ({names})))::DOUBLE)"
    )


def _inclusions_sql() -> str:
    texts = {"r_name", "n_name", "c_mktsegment", "o_orderstatus", "l_returnflag", "l_linestatus"}
    pairs = [(t, f, u, g) for t, fs in INCLUDED.items() for f in fs for u, gs in INCLUDED.items() for g in gs]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS container, '{f}' AS field, '{u}' AS ref_container, '{g}' AS ref_field "
        f"WHERE EXISTS (SELECT 1 FROM {t} WHERE {f} IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM {t} x ANTI JOIN {u} y ON x.{f} = y.{g} WHERE x.{f} IS NOT NULL)"
        for t, f, u, g in pairs if (t, f) != (u, g) and (f in texts) == (g in texts)
    )


ORACLES = {
    "inclusions": _inclusions_sql(),
    "field_profile": _profile_sql("orders", duck(HOLED), _ORDER_KINDS),
    "approx_distinct": " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(DISTINCT {c}) AS exact_count, true AS within FROM lineitem" for c in APPROX_FIELDS
    ),
    "quantile_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS field, {p}::DOUBLE AS probability, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
        for c in QUANTILE_FIELDS
        for p in (0.0, 0.25, 0.5, 0.75, 0.99)
    ),
    "type_inference": " UNION ALL ".join(_inferred(c) for c in UNTYPED_FIELDS),
    "value_histogram": " UNION ALL ".join(
        f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value, count(*) AS row_count FROM lineitem "
        f"WHERE (SELECT count(DISTINCT {c}) FROM lineitem) <= 10 GROUP BY {c}"
        for c in HISTOGRAM_FIELDS
    ),
    "correlation_profile": "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS field_a, '{b}' AS field_b, round(corr({a}, {b}), 6) AS correlation FROM {duck(PRICED)} p"
        for a, b in _pairs(PRICED_FIELDS)
    )
    + ") WHERE abs(correlation) >= 0.5",
    "infer_checks": f"""
        WITH p AS (SELECT *, container || '__' AS c, '__' || trim(regexp_replace(field, '[^a-z0-9]+', '_', 'g'), '_') AS f FROM {_PROFILES}),
        k AS (
            SELECT c || 'notnull' || f AS check_uid, 'notNull' AS rule_type, '' AS properties FROM p WHERE null_count = 0
            UNION ALL SELECT c || 'unique' || f, 'unique', '' FROM p WHERE null_count = 0 AND distinct_count = row_count
            UNION ALL SELECT c || 'between' || f, 'between', 'max_value=' || max || ';min_value=' || min FROM p
                WHERE type IN ('bigint', 'int', 'double')
            UNION ALL SELECT c || 'afterdatetime' || f, 'afterDateTime',
                'datetime=' || strftime(CAST(min AS TIMESTAMP) - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') FROM p WHERE type = 'timestamp_ntz'
            UNION ALL SELECT c || 'matchespattern' || f, 'matchesPattern', 'pattern=' || pattern FROM p WHERE pattern IS NOT NULL
            UNION ALL {' UNION ALL '.join(_included(*i) for i in INCLUSIONS)})
        SELECT check_uid, rule_type, 'Draft' AS status, properties FROM k""",
    "test_inferred_checks": f"""
        WITH o AS (SELECT * FROM {duck(HOLED)} h ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 1000),
        c AS (SELECT * FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)) LIMIT 1000),
        r AS (SELECT 'orders__notnull__o_custkey' AS check_uid, count_if(o_custkey IS NULL) AS bad, count(*) AS n FROM o
            UNION ALL SELECT 'orders__notnull__o_orderpriority', count_if(o_orderpriority IS NULL), count(*) FROM o
            UNION ALL SELECT 'orders__between__o_totalprice', count_if(o_totalprice < 10000), count(*) FROM o
            UNION ALL SELECT 'orders__between__o_custkey', count_if(o_custkey > 100), count(*) FROM o
            UNION ALL SELECT 'orders__existsin__o_custkey',
                count_if(o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)), count(*) FROM o
            UNION ALL SELECT 'customer__satisfiesexpression', count_if(NOT c_acctbal > 0), count(*) FROM c)
        SELECT check_uid, round(100.0::DOUBLE * (1 - bad / n), 4) AS pass_percent FROM r
        WHERE 100.0::DOUBLE * (1 - bad / n) >= 90""",
    "profile_selected": _profile_sql(
        "selected",
        f"(SELECT * FROM {duck(ANOMALIES)} a WHERE container IN (SELECT name FROM {duck(CONTAINERS)} c "
        "WHERE list_has_any(string_split(tags, ','), ['machinery', 'n7'])))",
        {"status": "string", "weight": "int", "created": "timestamp_ntz"},
    ),
    "profile_sketches": "SELECT field, row_count, null_count, min, max, mean, stddev, pattern, true AS distinct_close, "
    "true AS median_close FROM ("
    + _profile_sql("orders", duck(HOLED), {k: v for k, v in _ORDER_KINDS.items() if k != "o_orderstatus"}) + ")",
    "profile_incremental": _profile_sql(
        "orders",
        "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn "
        "FROM orders WHERE o_orderdate > TIMESTAMP '1999-12-31') WHERE rn <= 2)",
        {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "timestamp_ntz"},
    ),
    "volume": """
        SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS bucket, count(*) AS row_count, 'day' AS width FROM events GROUP BY 1
        UNION ALL SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d'), count(*), 'month' FROM lineitem GROUP BY 1""",
    "freshness": " UNION ALL ".join(
        f"SELECT strftime(max({ts}), '%Y-%m-%d %H:%M:%S') AS latest, "
        f"CAST(floor(epoch(TIMESTAMP '2024-02-01') - epoch(max({ts}))) AS BIGINT) AS lag_seconds, '{t}' AS container FROM {t}"
        for t, ts in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ),
    "null_check": " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) AS row_count, count(*) - count({c}) AS null_count FROM {duck(HOLED)} h"
        for c in _ORDER_KINDS
    ),
    "latest_measurement": f"""
        SELECT container, event_id, kind, value FROM (SELECT *, row_number() OVER (
            PARTITION BY container ORDER BY measured_at DESC, event_id DESC) AS rn FROM {duck(MEASUREMENTS)} m) WHERE rn = 1""",
    "quality_scores": f"""
        WITH s AS (SELECT container, {', '.join(f'{_score(r)} AS {d}' for d, r in _SCORES.items())}
                   FROM {duck(RULE_RESULTS)} x GROUP BY container)
        SELECT container, {', '.join(f'round({d}, 6) AS {d}' for d in _SCORES)},
               round(({' + '.join(f'coalesce({d}, 0)' for d in _SCORES)})
                     / ({' + '.join(f'({d} IS NOT NULL)::INTEGER' for d in _SCORES)}), 6) AS overall FROM s""",
    "datastore_counts": f"""
        WITH p AS (SELECT container, count(*) AS n, max(row_count) AS r FROM {duck(PROFILE_ROWS)} x GROUP BY 1),
        c AS (SELECT container, count(*) AS n FROM {duck(CHECKS)} x GROUP BY 1),
        a AS (SELECT container, count(*) AS n FROM {duck(ANOMALIES)} x WHERE NOT archived GROUP BY 1)
        SELECT datastore, count(*) AS container_count, CAST(coalesce(sum(p.n), 0) AS BIGINT) AS field_count,
               CAST(coalesce(sum(p.r), 0) AS BIGINT) AS record_count, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS check_count,
               CAST(coalesce(sum(a.n), 0) AS BIGINT) AS anomaly_count
        FROM {duck(CONTAINERS)} k LEFT JOIN p ON k.name = p.container LEFT JOIN c ON k.name = c.container
        LEFT JOIN a ON k.name = a.container GROUP BY datastore""",
}
