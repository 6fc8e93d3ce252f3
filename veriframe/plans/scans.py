"""Queries A: scans and the life of anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veriframe.operators import anomalies as an
from veriframe.operators.operations import run_scan
from veriframe.operators.registry import Check, checks_frame, resolve_refs
from veriframe.operators.scan import (
    Container,
    ScanOptions,
    incremental_scan,
    record_anomalies,
    scan,
    scan_summary,
    shape_anomalies,
)
from veriframe.plans.common import ANOMALIES, duck, frame, sql_fingerprint, table
from veriframe.plans.rules import HOLED, failing
from veriframe.session import durable

BUILDING = "SELECT c_custkey FROM {customer} WHERE c_mktsegment <> 'BUILDING'"

SCAN_CHECKS = [
    Check("orders", "notNull", ["o_custkey"]),
    Check("orders", "notNull", ["o_orderpriority"], status="Draft"),
    Check("orders", "between", ["o_totalprice"], {"min_value": 2000, "max_value": 450000}),
    Check("orders", "unique", ["o_custkey", "o_orderdate"]),
    Check("orders", "existsIn", ["o_custkey"], {"ref_container": "customer", "field_name": "c_custkey"}),
    Check("orders", "volumetric", [], {"max_rows": 100}),
    Check("lineitem", "between", ["l_quantity"], {"max_value": 48}),
    Check("lineitem", "unique", ["l_orderkey", "l_linenumber"]),
    Check("lineitem", "satisfiesExpression", [], {"expression": "l_discount <= 0.09 OR l_tax > 0.01"}),
    Check("lineitem", "matchesPattern", ["l_returnflag"], {"pattern": "[AN]"}),
]


def _containers(spark: SparkSession, sf: str) -> dict[str, Container]:
    return {
        "orders": Container(frame(spark, sf, HOLED), ["o_orderkey"]),
        "customer": Container(frame(spark, sf, BUILDING), ["c_custkey"]),
        "lineitem": Container(table(spark, sf, "lineitem")),
    }


def q_scan(spark: SparkSession, sf: str) -> DataFrame:
    failures = scan(spark, _containers(spark, sf), checks_frame(spark, SCAN_CHECKS))
    return failures.groupBy("check_uid", "rule_type", "anomaly_type").agg(
        F.count(F.lit(1)).alias("failures")
    )


def q_record_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    failures = scan(spark, _containers(spark, sf), checks_frame(spark, SCAN_CHECKS[:5]))
    return record_anomalies(failures).select("check_uid", "record_key", "fingerprint", "failing_rows")


def q_shape_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    containers = {
        "orders": Container(frame(spark, sf, HOLED), ["o_orderkey"]),
        "orders_raw": Container(table(spark, sf, "orders"), ["o_orderkey"]),
        "lineitem": Container(lines),
    }
    checks = [
        Check("orders", "volumetric", [], {"max_rows": 100}),
        Check("lineitem", "volumetric", [], {"min_rows": 1}),
        Check("orders", "isReplicaOf", ["o_orderkey", "o_custkey"], {"ref_container": "orders_raw"}),
        Check("orders", "dataDiff", ["o_orderpriority"], {"ref_container": "orders_raw", "key_fields": "o_orderkey"}),
        Check(
            "orders", "aggregationComparison", [],
            {"ref_container": "lineitem", "expression": "count(1)", "comparison": "gte", "ref_expression": "count(1)"},
        ),
    ]
    failures = scan(spark, containers, checks_frame(spark, checks))
    return shape_anomalies(failures).select("check_uid", "message", "fingerprint", "failing_rows")


def q_incremental_scan(spark: SparkSession, sf: str) -> DataFrame:
    failures = incremental_scan(
        spark, _containers(spark, sf), checks_frame(spark, SCAN_CHECKS[:4]),
        {"orders": "o_orderdate"}, {"orders": "2000-06-30 00:00:00"},
    )
    return failures.select("check_uid", "record_key", "fingerprint")


def q_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Lines have no key: identical lines share one fingerprint, with a count."""
    check = Check("lineitem", "between", ["l_quantity"], {"max_value": 40})
    failures = scan(spark, {"lineitem": Container(table(spark, sf, "lineitem"))}, checks_frame(spark, [check]))
    grouped = record_anomalies(failures)
    return grouped.groupBy("check_uid", "failing_rows").agg(F.count(F.lit(1)).alias("fingerprints"))


# Yesterday's checks were looser in one place and stricter in another.
YESTERDAY = [
    Check("orders", "between", ["o_totalprice"], {"min_value": 10000, "max_value": 470000}),
    Check("orders", "notNull", ["o_custkey"]),
]
TODAY = [
    Check("orders", "between", ["o_totalprice"], {"min_value": 2000, "max_value": 450000}),
    Check("orders", "notNull", ["o_custkey"], filter="o_totalprice < 15000"),
]


def _two_scans(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    containers = {"orders": Container(frame(spark, sf, HOLED), ["o_orderkey"])}
    before = scan(spark, containers, checks_frame(spark, YESTERDAY))
    stored = an.new_anomalies(before, "scan_1", "2024-01-01 00:00:00")
    checks = checks_frame(spark, TODAY)
    return durable(stored), durable(scan(spark, containers, checks)), checks


def q_auto_resolve(spark: SparkSession, sf: str) -> DataFrame:
    stored, failures, checks = _two_scans(spark, sf)
    resolved = an.auto_resolve(stored, failures, checks.select("check_uid"))
    return resolved.select("fingerprint", "check_uid", "status", "archived")


def q_merge_failures(spark: SparkSession, sf: str) -> DataFrame:
    stored, failures, checks = _two_scans(spark, sf)
    resolved = an.auto_resolve(stored, failures, checks.select("check_uid"))
    merged = an.merge_failures(resolved, failures, "scan_2", "2024-01-02 00:00:00")
    return merged.select(
        "fingerprint", "check_uid", "status", "scan_id",
        F.date_format("created", "yyyy-MM-dd").alias("created"),
    )


def q_high_count_rollup(spark: SparkSession, sf: str) -> DataFrame:
    failures = durable(scan(spark, _containers(spark, sf), checks_frame(spark, SCAN_CHECKS[:6])))
    rolled = an.high_count_rollup(failures, 100)
    return rolled.select("check_uid", "anomaly_type", "record_key", "fingerprint", "failing_rows")


def q_enrich_source_records(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    check = Check("orders", "between", ["o_totalprice"], {"max_value": 400000})
    failures = scan(spark, {"orders": Container(orders, ["o_orderkey"])}, checks_frame(spark, [check]))
    stored = durable(an.new_anomalies(failures, "scan_1", "2024-01-01 00:00:00"))
    source = orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    enriched = an.enrich_source_records(stored, {"orders": (source, ["o_orderkey"])}, 200)
    return enriched.select("record_key", "source_enriched", "source_record")


def _anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return (
        frame(spark, sf, ANOMALIES, "tags")
        .withColumn("assignee_ids", F.array(F.col("assignees").cast("int")))
        .drop("assignees")
    )


def q_anomaly_list(spark: SparkSession, sf: str) -> DataFrame:
    stored = _anomalies(spark, sf)
    listings = {
        "open": an.anomaly_list(
            stored, anomaly_type="record", tags=["urgent", "high"], start_date="1996-01-01",
            end_date="1998-12-31", source_enriched=True, sort_created="desc",
        ),
        "archived": an.anomaly_list(
            stored, statuses=["Invalid", "Resolved"], rule_types=["unique", "volumetric"], sort_weight="asc"
        ),
        "mixed": an.anomaly_list(
            stored, statuses=["Active", "Duplicate"], check_uid="orders__medium",
            timeframe_days=500, as_of="2001-08-01",
        ),
    }
    parts = [df.select("id", "status", "weight", F.lit(n).alias("listing")) for n, df in listings.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


UPDATES = """
SELECT CAST(o_orderkey AS STRING) AS id,
       CASE WHEN o_totalprice > 450000 THEN 'Resolved' WHEN o_orderstatus = 'O' THEN 'Acknowledged' ELSE 'Active' END AS status,
       CASE WHEN o_totalprice > 300000 THEN 'dear ' || o_orderpriority END AS description,
       CASE WHEN o_totalprice < 50000 THEN '' WHEN o_totalprice < 100000 THEN 'cheap,seen' END AS tags
FROM {orders} WHERE o_orderpriority <> '5-LOW'
"""


def q_anomaly_update(spark: SparkSession, sf: str) -> DataFrame:
    updates = frame(spark, sf, UPDATES, "tags").withColumn(
        "assignee_ids", F.when(F.col("status") == "Active", F.array().cast("array<int>"))
    )
    done = an.anomaly_update(_anomalies(spark, sf), updates)
    return done.select(
        "id", "status", "description", F.array_join("tags", ",").alias("tags"),
        F.array_join(F.col("assignee_ids").cast("array<string>"), ",").alias("assignee_ids"),
    )


ARCHIVE_IDS = "SELECT CAST(l_orderkey AS STRING) AS id FROM {lineitem} WHERE l_discount > 0.08 AND l_quantity > 30"


def q_anomaly_archive(spark: SparkSession, sf: str) -> DataFrame:
    ids = frame(spark, sf, ARCHIVE_IDS)
    return an.anomaly_archive(_anomalies(spark, sf), ids, "Invalid").select("id", "status", "archived")


def q_anomaly_delete(spark: SparkSession, sf: str) -> DataFrame:
    return an.anomaly_delete(_anomalies(spark, sf), frame(spark, sf, ARCHIVE_IDS)).select("id", "status")


def q_scan_summary(spark: SparkSession, sf: str) -> DataFrame:
    containers, checks = _containers(spark, sf), checks_frame(spark, SCAN_CHECKS)
    options = ScanOptions(
        incremental_fields={"orders": "o_orderdate"}, greater_than_time={"orders": "1997-01-01 00:00:00"}
    )
    counts: dict[str, Observation] = {}
    failures = durable(scan(spark, containers, checks, options, counts))
    return scan_summary(containers, checks, failures, options, counts)


RUNS = """
SELECT event_id AS id, 'store_' || CAST(user_id AS STRING) AS datastore,
       CASE event_type WHEN 'view' THEN 'scan' WHEN 'click' THEN 'profile' WHEN 'purchase' THEN 'sync'
            WHEN 'signup' THEN 'export' ELSE 'materialize' END AS type,
       CASE WHEN value < 1 THEN 'running' WHEN value < 5 THEN 'failure' ELSE 'success' END AS result,
       ts AS created, CASE WHEN value >= 1 THEN ts END AS end_time
FROM {events}
"""


def q_run_history(spark: SparkSession, sf: str) -> DataFrame:
    runs = frame(spark, sf, RUNS)
    scans = an.run_history(
        runs, operation_type="scan", results=["success"], finished=True,
        start_date="2024-01-05", end_date="2024-01-20",
    )
    stuck = an.run_history(runs, finished=False)
    pick = ["id", "datastore", "type", "result"]
    return scans.select(*pick).unionAll(stuck.select(*pick))


COSTLY = Check("orders", "between", ["o_totalprice"], {"max_value": 300000})


def _run(spark: SparkSession, orders: Container, run_id: str, known: DataFrame | None = None, **options):
    registry = spark.createDataFrame([("orders", ["daily"])], "name string, tags array<string>")
    known = known if known is not None else spark.createDataFrame([], an.ANOMALY_COLUMNS)
    return run_scan(
        spark, {"orders": orders}, registry, checks_frame(spark, [COSTLY]), known, run_id, "2024-01-01", **options
    )


def q_run_scan_rollup(spark: SparkSession, sf: str) -> DataFrame:
    orders = Container(table(spark, sf, "orders"), ["o_orderkey"])
    first = _run(spark, orders, "s1")
    second = _run(spark, orders, "s2", first.anomalies, high_count_rollup_threshold=5)
    return second.anomalies.groupBy("anomaly_type", "status").agg(
        F.count(F.lit(1)).alias("anomalies"), F.sum("failing_rows").alias("failing_rows")
    )


def q_run_scan_capped(spark: SparkSession, sf: str) -> DataFrame:
    orders = Container(table(spark, sf, "orders"), ["o_orderkey"], ["o_orderstatus"], ["o_orderkey"])
    first = _run(spark, orders, "s1")
    second = _run(spark, orders, "s2", first.anomalies, max_records_analyzed_per_partition=2)
    return second.anomalies.groupBy("status").agg(F.count(F.lit(1)).alias("anomalies"))


def q_run_scan_incremental_batch(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    args = {"incremental": True, "incremental_fields": {"orders": "o_orderkey"}}
    first = _run(spark, Container(orders.filter("o_orderkey <= 500"), ["o_orderkey"]), "s1", **args)
    second = _run(
        spark, Container(orders, ["o_orderkey"]), "s2", first.anomalies, checkpoints=first.checkpoints, **args
    )
    runs = [
        r.run.select("id", "records_processed", "anomalies_identified").join(r.checkpoints.select("high_water"))
        for r in (first, second)
    ]
    return runs[0].unionByName(runs[1])


def q_registry_round_trip_scan(spark: SparkSession, sf: str) -> DataFrame:
    named = checks_frame(
        spark,
        [
            Check("orders", "existsIn", ["o_custkey"],
                  {"ref_container_name": "customer", "ref_datastore_name": "second", "field_name": "c_custkey"}),
            Check("orders", "notExistsIn", ["o_custkey"], {"ref_container_name": "customer", "field_name": "c_custkey"}),
        ],
    ).withColumn("datastore_id", F.lit(1))
    stores = spark.createDataFrame([(1, "first"), (2, "second")], "id int, name string")
    known = spark.createDataFrame([(10, "customer", 1), (11, "customer", 2)], "id int, name string, datastore_id int")
    stored = resolve_refs(named, known, stores).drop("error", "datastore_id")
    containers = {
        "orders": Container(frame(spark, sf, HOLED), ["o_orderkey"]),
        "10": Container(table(spark, sf, "customer"), ["c_custkey"]),
        "2.11": Container(frame(spark, sf, BUILDING), ["c_custkey"]),
    }
    failures = scan(spark, containers, stored)
    return failures.groupBy("rule_type").agg(F.count(F.lit(1)).alias("failures"))


# Many set rules of one container: (rule, fields, filter, reference, its fields).
SET_RULES = [
    ("unique", "o_custkey", None, None, ""), ("unique", "o_custkey,o_orderdate", None, None, ""), ("unique", "o_totalprice", None, None, ""),
    ("unique", "o_orderpriority,o_orderdate", "o_orderstatus = 'F'", None, ""), ("unique", "o_orderkey", None, None, ""),
    ("unique", "o_orderdate", "o_totalprice > 300000", None, ""),
    ("existsIn", "o_custkey", None, "customer", "c_custkey"), ("existsIn", "o_custkey", "o_totalprice > 100000", "customer", "c_custkey"),
    ("existsIn", "o_custkey", None, "supplier", "s_suppkey"), ("existsIn", "o_orderkey", "o_totalprice < 400000", "lineitem", "l_orderkey"),
    ("existsIn", "o_orderkey,o_custkey", None, "lineitem", "l_orderkey,l_partkey"),
    ("notExistsIn", "o_custkey", None, "customer", "c_custkey"), ("notExistsIn", "o_custkey", "o_orderstatus = 'O'", "supplier", "s_suppkey"),
    ("notExistsIn", "o_orderkey", None, "part", "p_partkey"), ("notExistsIn", "o_custkey", None, "nation", "n_nationkey"),
    ("notExistsIn", "o_orderpriority,o_orderstatus", None, "lineitem", "l_returnflag,l_linestatus"),
]


def q_scan_set_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Sixteen set rules of orders: one pass over it, one shuffle of its keys."""
    containers = {"orders": Container(frame(spark, sf, HOLED), ["o_orderkey"]), "customer": Container(frame(spark, sf, BUILDING))}
    checks = []
    for i, (rule, fields, where, ref, ref_fields) in enumerate(SET_RULES):
        props = {"ref_container": ref, "field_name": ref_fields} if ref else {}
        if ref and ref not in containers:
            containers[ref] = Container(table(spark, sf, ref))
        checks.append(Check("orders", rule, fields.split(","), props, filter=where, additional_metadata={"_check_uid": f"set_{i:02}"}))
    return scan(spark, containers, checks_frame(spark, checks)).select("check_uid", "rule_type", "record_key")


QUERIES = {
    "scan_set_rules": q_scan_set_rules,
    "run_scan_rollup": q_run_scan_rollup,
    "run_scan_capped": q_run_scan_capped,
    "run_scan_incremental_batch": q_run_scan_incremental_batch,
    "registry_round_trip_scan": q_registry_round_trip_scan,
    "scan": q_scan,
    "record_anomalies": q_record_anomalies,
    "shape_anomalies": q_shape_anomalies,
    "incremental_scan": q_incremental_scan,
    "fingerprint": q_fingerprint,
    "auto_resolve": q_auto_resolve,
    "merge_failures": q_merge_failures,
    "high_count_rollup": q_high_count_rollup,
    "enrich_source_records": q_enrich_source_records,
    "anomaly_list": q_anomaly_list,
    "anomaly_update": q_anomaly_update,
    "anomaly_archive": q_anomaly_archive,
    "anomaly_delete": q_anomaly_delete,
    "scan_summary": q_scan_summary,
    "run_history": q_run_history,
}

_H = duck(HOLED)
_B = duck(BUILDING)


def _repeated(source: str) -> str:
    return f"(SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS n FROM {source} s0)"


def _record_failures(orders: str) -> str:
    """The record failures of the first five checks over one version of orders."""
    return " UNION ALL ".join(
        [
            failing("orders__notnull__o_custkey", "o_custkey IS NULL", orders),
            failing("orders__between__o_totalprice", "o_totalprice < 2000 OR o_totalprice > 450000", orders),
            failing("orders__unique__o_custkey_o_orderdate", "n > 1 AND o_custkey IS NOT NULL", _repeated(orders)),
        ]
    )


_EXISTS = failing(
    "orders__existsin__o_custkey",
    f"o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM {_B} b)",
)
_RECORDS = f"({_record_failures(_H)} UNION ALL {_EXISTS})"
_BEFORE = "(" + " UNION ALL ".join(
    [
        failing("orders__between__o_totalprice", "o_totalprice < 10000 OR o_totalprice > 470000"),
        failing("orders__notnull__o_custkey", "o_custkey IS NULL"),
    ]
) + ")"
_AFTER = "(" + " UNION ALL ".join(
    [
        failing("orders__between__o_totalprice", "o_totalprice < 2000 OR o_totalprice > 450000"),
        failing("orders__notnull__o_custkey", "o_custkey IS NULL AND o_totalprice < 15000"),
    ]
) + ")"
_RESOLVED = f"""SELECT b.fingerprint, b.check_uid, CASE WHEN a.fingerprint IS NULL THEN 'Resolved' ELSE 'Active' END AS status
    FROM {_BEFORE} b LEFT JOIN {_AFTER} a ON b.fingerprint = a.fingerprint"""

_LINE_CHECKS = """
    SELECT 'lineitem__between__l_quantity' AS check_uid, 'between' AS rule_type, count(*) AS failures FROM lineitem WHERE l_quantity > 48
    UNION ALL SELECT 'lineitem__unique__l_linenumber_l_orderkey', 'unique', count(*) FROM (
        SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1
    UNION ALL SELECT 'lineitem__satisfiesexpression', 'satisfiesExpression', count(*) FROM lineitem WHERE NOT (l_discount <= 0.09 OR l_tax > 0.01)
    UNION ALL SELECT 'lineitem__matchespattern__l_returnflag', 'matchesPattern', count(*) FROM lineitem WHERE NOT regexp_full_match(l_returnflag, '[AN]')
"""


def _order_checks(orders: str) -> str:
    return f"""
    SELECT 'orders__notnull__o_custkey' AS check_uid, 'notNull' AS rule_type, count(*) AS failures FROM {orders} h WHERE o_custkey IS NULL
    UNION ALL SELECT 'orders__between__o_totalprice', 'between', count(*) FROM {orders} h WHERE o_totalprice < 2000 OR o_totalprice > 450000
    UNION ALL SELECT 'orders__unique__o_custkey_o_orderdate', 'unique', count(*) FROM {_repeated(orders)} WHERE n > 1 AND o_custkey IS NOT NULL
    UNION ALL SELECT 'orders__existsin__o_custkey', 'existsIn', count(*) FROM {orders} h
        WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM {_B} b)
    """


_LATE = f"(SELECT * FROM {_H} h0 WHERE o_orderdate > TIMESTAMP '1997-01-01')"
_NEWEST = f"(SELECT * FROM {_H} h0 WHERE o_orderdate > TIMESTAMP '2000-06-30')"

def _set_rule(i: int, rule: str, fields: str, where: str | None, ref: str | None, ref_fields: str) -> str:
    cols = fields.split(",")
    rows = f"SELECT * FROM {_H} h WHERE {' AND '.join(f'{c} IS NOT NULL' for c in cols)} AND ({where or 'true'})"
    out = f"SELECT 'set_{i:02}' AS check_uid, '{rule}' AS rule_type, CAST(o_orderkey AS VARCHAR) AS record_key FROM"
    if rule == "unique":
        return f"{out} (SELECT *, count(*) OVER (PARTITION BY {fields}) AS n FROM ({rows})) WHERE n > 1"
    source = _B if ref == "customer" else ref
    match = " AND ".join(f"q.{c} = r.{d}" for c, d in zip(cols, ref_fields.split(",")))
    return f"{out} ({rows}) q WHERE {'NOT ' if rule == 'existsIn' else ''}EXISTS (SELECT 1 FROM {source} r WHERE {match})"


ORACLES = {
    "scan_set_rules": " UNION ALL ".join(_set_rule(i, *r) for i, r in enumerate(SET_RULES)),
    "run_scan_rollup": """
        SELECT 'record' AS anomaly_type, 'Active' AS status, count(*) AS anomalies, count(*) AS failing_rows
        FROM orders WHERE o_totalprice > 300000
        UNION ALL SELECT 'shape', 'Active', 1, count(*) FROM orders WHERE o_totalprice > 300000 HAVING count(*) > 5""",
    "run_scan_capped": "SELECT 'Active' AS status, count(*) AS anomalies FROM orders WHERE o_totalprice > 300000",
    "run_scan_incremental_batch": """
        SELECT 's1' AS id, count(*) AS records_processed, CAST(count_if(o_totalprice > 300000) AS BIGINT) AS anomalies_identified,
               CAST(max(o_orderkey) AS VARCHAR) AS high_water FROM orders WHERE o_orderkey <= 500
        UNION ALL SELECT 's2', CAST(count_if(o_orderkey > 500) AS BIGINT), CAST(count_if(o_orderkey > 500 AND o_totalprice > 300000) AS BIGINT),
               CAST(max(o_orderkey) AS VARCHAR) FROM orders""",
    "registry_round_trip_scan": f"""
        SELECT 'existsIn' AS rule_type, count(*) AS failures FROM {duck(HOLED)}
        WHERE o_custkey IS NOT NULL AND o_custkey NOT IN {duck(BUILDING)}
        UNION ALL SELECT 'notExistsIn', count(*) FROM {duck(HOLED)} WHERE o_custkey IN (SELECT c_custkey FROM customer)""",
    "scan": f"""
        SELECT check_uid, rule_type, 'record' AS anomaly_type, failures FROM ({_order_checks(_H)} UNION ALL {_LINE_CHECKS}) WHERE failures > 0
        UNION ALL SELECT 'orders__volumetric', 'volumetric', 'shape', 1 FROM orders HAVING count(*) > 100""",
    "record_anomalies": f"SELECT check_uid, record_key, fingerprint, 1::BIGINT AS failing_rows FROM {_RECORDS}",
    "shape_anomalies": f"""
        SELECT uid AS check_uid, message, sha256(uid || '|') AS fingerprint, 1::BIGINT AS failing_rows FROM (
            SELECT 'orders__volumetric' AS uid, 'row count ' || count(*) AS message FROM orders HAVING count(*) > 100
            UNION ALL SELECT 'orders__isreplicaof__o_custkey_o_orderkey', 2 * count(*) || ' rows differ' FROM {_H} h WHERE o_custkey IS NULL
            UNION ALL SELECT 'orders__datadiff__o_orderpriority', count(*) || ' rows differ' FROM {_H} h WHERE o_orderpriority IS NULL
            UNION ALL SELECT 'orders__aggregationcomparison', (SELECT count(*) FROM orders) || ' gte ' || (SELECT count(*) FROM lineitem) || ' is false')""",
    "incremental_scan": _record_failures(_NEWEST),
    "fingerprint": """
        SELECT 'lineitem__between__l_quantity' AS check_uid, n AS failing_rows, count(*) AS fingerprints FROM (
            SELECT count(*) AS n FROM lineitem WHERE l_quantity > 40 GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
                l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) GROUP BY n""",
    "auto_resolve": f"SELECT *, status = 'Resolved' AS archived FROM ({_RESOLVED})",
    "merge_failures": f"""
        SELECT *, 'scan_1' AS scan_id, '2024-01-01' AS created FROM ({_RESOLVED})
        UNION ALL SELECT fingerprint, check_uid, 'Active', 'scan_2', '2024-01-02' FROM {_AFTER} a
        WHERE fingerprint NOT IN (SELECT fingerprint FROM {_BEFORE} b)""",
    "high_count_rollup": f"""
        WITH r AS (SELECT * FROM {_RECORDS}), c AS (SELECT check_uid, count(*) AS n FROM r GROUP BY 1)
        SELECT r.check_uid, 'record' AS anomaly_type, record_key, fingerprint, 1::BIGINT AS failing_rows
        FROM r JOIN c ON r.check_uid = c.check_uid WHERE n <= 100
        UNION ALL SELECT check_uid, 'shape', NULL, sha256(check_uid || '|'), n FROM c WHERE n > 100
        UNION ALL SELECT 'orders__volumetric', 'shape', NULL, sha256('orders__volumetric|'), 1 FROM orders HAVING count(*) > 100""",
    "enrich_source_records": f"""
        WITH f AS ({failing('orders__between__o_totalprice', 'o_totalprice > 400000', 'orders')}),
        t AS (SELECT record_key FROM f ORDER BY fingerprint LIMIT 200)
        SELECT f.record_key, t.record_key IS NOT NULL AS source_enriched,
               CASE WHEN t.record_key IS NOT NULL THEN '{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
                   || ',"o_orderstatus":"' || o_orderstatus || '"}}' END AS source_record
        FROM f LEFT JOIN t ON f.record_key = t.record_key JOIN orders ON CAST(o_orderkey AS VARCHAR) = f.record_key""",
    "anomaly_list": f"""
        WITH a AS (SELECT *, string_split(tags, ',') AS t FROM {duck(ANOMALIES)})
        SELECT id, status, weight, 'open' AS listing FROM a WHERE NOT archived AND anomaly_type = 'record'
            AND list_has_any(t, ['urgent', 'high']) AND created >= TIMESTAMP '1996-01-01'
            AND created < TIMESTAMP '1999-01-01' AND source_enriched
        UNION ALL SELECT id, status, weight, 'archived' FROM a
            WHERE status IN ('Invalid', 'Resolved') AND rule_type IN ('unique', 'volumetric')
        UNION ALL SELECT id, status, weight, 'mixed' FROM a WHERE status IN ('Active', 'Duplicate')
            AND check_uid = 'orders__medium' AND created >= TIMESTAMP '2001-08-01' - INTERVAL 500 DAY""",
    "anomaly_update": f"""
        SELECT a.id, coalesce(u.status, a.status) AS status, u.description, coalesce(u.tags, a.tags) AS tags,
               CASE WHEN u.status = 'Active' THEN '' ELSE a.assignees END AS assignee_ids
        FROM {duck(ANOMALIES)} a LEFT JOIN (SELECT * FROM {duck(UPDATES)} u0 WHERE status <> 'Resolved') u ON a.id = u.id""",
    "anomaly_archive": f"""
        SELECT id, CASE WHEN hit THEN 'Invalid' ELSE status END AS status, hit OR archived AS archived FROM (
            SELECT *, id IN (SELECT id FROM {duck(ARCHIVE_IDS)} i) AS hit FROM {duck(ANOMALIES)} a)""",
    "anomaly_delete": f"""
        SELECT id, status FROM {duck(ANOMALIES)} a WHERE id NOT IN (SELECT id FROM {duck(ARCHIVE_IDS)} i)""",
    "scan_summary": f"""
        WITH f AS (SELECT 'orders' AS container, * FROM ({_order_checks(_LATE)}) UNION ALL
                   SELECT 'orders', 'orders__volumetric', 'volumetric', 1 FROM {_LATE} l HAVING count(*) > 100
                   UNION ALL SELECT 'lineitem', * FROM ({_LINE_CHECKS})),
        s AS (SELECT container, count(*) FILTER (failures > 0) AS checks_failing, CAST(sum(failures) AS BIGINT) AS failures
              FROM f GROUP BY 1),
        c AS (SELECT 'orders' AS container, count(*) AS records_processed, 5::BIGINT AS checks_run FROM {_LATE} l
              UNION ALL SELECT 'customer', count(*), 0 FROM {_B} b UNION ALL SELECT 'lineitem', count(*), 4 FROM lineitem)
        SELECT c.container, records_processed, checks_run, coalesce(checks_failing, 0) AS checks_failing,
               coalesce(failures, 0) AS failures FROM c LEFT JOIN s ON c.container = s.container""",
    "run_history": f"""
        SELECT id, datastore, type, result FROM {duck(RUNS)} r WHERE type = 'scan' AND result = 'success'
            AND end_time IS NOT NULL AND created >= TIMESTAMP '2024-01-05' AND created < TIMESTAMP '2024-01-21'
        UNION ALL SELECT id, datastore, type, result FROM {duck(RUNS)} r WHERE end_time IS NULL""",
}
