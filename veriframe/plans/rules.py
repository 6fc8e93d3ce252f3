"""Queries K: each quality rule and modifier, run through the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.operators import rules
from veriframe.operators.registry import Check, active_checks, check_select, checks_frame
from veriframe.operators.scan import Container, scan
from veriframe.plans.common import CHECKS, duck, frame, sql_fingerprint, table

# Orders with holes: cheap ones lose their customer, urgent ones their status.
HOLED = """
SELECT o_orderkey, CASE WHEN o_totalprice >= 20000 THEN o_custkey END AS o_custkey,
       nullif(o_orderpriority, '1-URGENT') AS o_orderpriority, o_orderstatus, o_totalprice, o_orderdate
FROM {orders}
"""


def _failures(spark: SparkSession, checks: list[Check], containers: dict[str, Container]) -> DataFrame:
    out = scan(spark, containers, checks_frame(spark, checks))
    return out.select("check_uid", "record_key", "fingerprint")


def _holed(spark: SparkSession, sf: str) -> dict[str, Container]:
    return {"orders": Container(frame(spark, sf, HOLED), ["o_orderkey"])}


def _one(spark: SparkSession, sf: str, check: Check) -> DataFrame:
    return _failures(spark, [check], _holed(spark, sf))


def q_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return _one(spark, sf, Check("orders", "notNull", ["o_custkey", "o_orderpriority"]))


def q_between(spark: SparkSession, sf: str) -> DataFrame:
    return _failures(
        spark,
        [
            Check("orders", "between", ["o_totalprice"], {"min_value": 5000, "max_value": 450000.5}),
            Check("orders", "between", ["o_custkey"], {"min": 10}),
        ],
        _holed(spark, sf),
    )


def q_unique(spark: SparkSession, sf: str) -> DataFrame:
    return _one(spark, sf, Check("orders", "unique", ["o_custkey", "o_orderdate"]))


def q_matches_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return _one(spark, sf, Check("orders", "matchesPattern", ["o_orderpriority"], {"pattern": "[2-4]-[A-Z]+"}))


def q_satisfies_expression(spark: SparkSession, sf: str) -> DataFrame:
    expression = "`o_custkey` > 100 OR o_totalprice < 300000"
    return _one(spark, sf, Check("orders", "satisfiesExpression", [], {"expression": expression}))


RICH_CUSTOMERS = "SELECT c_custkey, c_nationkey FROM {customer} WHERE c_acctbal > 0"


def _membership(spark: SparkSession, sf: str, rule: str) -> DataFrame:
    containers = {**_holed(spark, sf), "rich": Container(frame(spark, sf, RICH_CUSTOMERS), ["c_custkey"])}
    check = Check("orders", rule, ["o_custkey"], {"ref_container": "rich", "field_name": "c_custkey"})
    return _failures(spark, [check], containers)


def q_exists_in(spark: SparkSession, sf: str) -> DataFrame:
    return _membership(spark, sf, "existsIn")


def q_not_exists_in(spark: SparkSession, sf: str) -> DataFrame:
    return _membership(spark, sf, "notExistsIn")


def q_is_replica_of(spark: SparkSession, sf: str) -> DataFrame:
    """Lines against a copy that rounds high quantities: copies count."""
    lines = table(spark, sf, "lineitem")
    copy = lines.withColumn("l_quantity", F.expr("least(l_quantity, 45)"))
    return rules.replica_diff(lines, copy, ["l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"])


LATER_ORDERS = """
SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
       CASE WHEN o_totalprice > 400000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM {orders} WHERE o_orderdate < DATE '2001-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {orders} WHERE o_totalprice < 3000
UNION ALL
SELECT -1 - c_custkey, c_custkey, 'N', c_acctbal FROM {customer}
"""
BASE_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {orders}"


def q_data_diff(spark: SparkSession, sf: str) -> DataFrame:
    diff = rules.data_diff(
        frame(spark, sf, LATER_ORDERS), frame(spark, sf, BASE_ORDERS), ["o_orderkey"],
        ["o_orderstatus", "o_totalprice"],
    )
    return diff.withColumn("changed_fields", F.array_join("changed_fields", ","))


def q_after_date_time(spark: SparkSession, sf: str) -> DataFrame:
    return _one(spark, sf, Check("orders", "afterDateTime", ["o_orderdate"], {"datetime": "1995-06-30 00:00:00"}))


def _comparisons() -> list[Check]:
    props = {"ref_container": "lineitem", "expression": "count(distinct o_orderkey)",
             "ref_expression": "count(distinct l_orderkey)"}
    return [
        Check("orders", "aggregationComparison", [], {**props, "comparison": c}, description=c)
        for c in ("eq", "ne", "lt", "lte", "gt", "gte")
    ]


def q_aggregation_comparison(spark: SparkSession, sf: str) -> DataFrame:
    containers = {**_holed(spark, sf), "lineitem": Container(table(spark, sf, "lineitem"))}
    checks = checks_frame(spark, _comparisons()).withColumn("check_uid", F.col("description"))
    return scan(spark, containers, checks).select("check_uid", "anomaly_type", "message")


def q_volumetric(spark: SparkSession, sf: str) -> DataFrame:
    containers = {n: Container(table(spark, sf, n)) for n in ("orders", "customer", "lineitem")}
    checks = [
        Check("orders", "volumetric", [], {"min_rows": 1}),
        Check("customer", "volumetric", [], {"max_rows": 10}),
        Check("lineitem", "volumetric", [], {"min_rows": 100000000}, filter="l_quantity > 25"),
    ]
    return scan(spark, containers, checks_frame(spark, checks)).select("check_uid", "message", "fingerprint")


def q_check_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _failures(
        spark,
        [
            Check("orders", "notNull", ["o_custkey"], filter="o_orderstatus = 'F'"),
            Check("orders", "unique", ["o_orderdate"], filter="o_totalprice > 490000"),
        ],
        _holed(spark, sf),
    )


def q_check_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _failures(
        spark,
        [
            Check("orders", "notNull", ["o_orderpriority"], coverage=0.25),
            Check("orders", "between", ["o_totalprice"], {"max_value": 200000}, coverage=0.5),
        ],
        _holed(spark, sf),
    )


def q_anomaly_message(spark: SparkSession, sf: str) -> DataFrame:
    check = Check(
        "orders", "between", ["o_totalprice"], {"max_value": 300000},
        description="too dear", anomaly_message_field="o_orderpriority",
    )
    return scan(spark, _holed(spark, sf), checks_frame(spark, [check])).select("record_key", "message")


def q_active_only(spark: SparkSession, sf: str) -> DataFrame:
    return active_checks(frame(spark, sf, CHECKS, "fields")).select("id", "container", "rule_type", "status")


def q_check_select(spark: SparkSession, sf: str) -> DataFrame:
    checks = frame(spark, sf, CHECKS, "fields", "tags")
    containers = [f"customer_{i}" for i in range(1, 40)]
    live = check_select(checks, containers, ["promo", "brand#4"], "draft")
    old = check_select(checks, tags=["economy"], status="archived")
    pick = ["id", "container", "status"]
    return live.select(*pick, F.lit("draft").alias("listing")).unionAll(
        old.select(*pick, F.lit("archived").alias("listing"))
    )


QUERIES = {
    "notNull": q_not_null,
    "between": q_between,
    "unique": q_unique,
    "matchesPattern": q_matches_pattern,
    "satisfiesExpression": q_satisfies_expression,
    "existsIn": q_exists_in,
    "notExistsIn": q_not_exists_in,
    "isReplicaOf": q_is_replica_of,
    "dataDiff": q_data_diff,
    "afterDateTime": q_after_date_time,
    "aggregationComparison": q_aggregation_comparison,
    "volumetric": q_volumetric,
    "check_filter": q_check_filter,
    "check_coverage": q_check_coverage,
    "anomaly_message": q_anomaly_message,
    "active_only": q_active_only,
    "check_select": q_check_select,
}

_KEY = "CAST(o_orderkey AS VARCHAR)"
_HASH = f"('0x' || substr(md5({_KEY}), 1, 8))::BIGINT"


def failing(uid: str, where: str, source: str | None = None) -> str:
    return (
        f"SELECT '{uid}' AS check_uid, {_KEY} AS record_key, "
        f"{sql_fingerprint(chr(39) + uid + chr(39), _KEY)} AS fingerprint "
        f"FROM {source or duck(HOLED)} h WHERE {where}"
    )


ORACLES = {
    "notNull": failing(
        "orders__notnull__o_custkey_o_orderpriority", "o_custkey IS NULL OR o_orderpriority IS NULL"
    ),
    "between": failing("orders__between__o_totalprice", "o_totalprice < 5000 OR o_totalprice > 450000.5")
    + " UNION ALL "
    + failing("orders__between__o_custkey", "o_custkey < 10"),
    "unique": failing(
        "orders__unique__o_custkey_o_orderdate", "n > 1 AND o_custkey IS NOT NULL",
        f"(SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS n FROM {duck(HOLED)})",
    ),
    "matchesPattern": failing(
        "orders__matchespattern__o_orderpriority", "NOT regexp_full_match(o_orderpriority, '[2-4]-[A-Z]+')"
    ),
    "satisfiesExpression": failing(
        "orders__satisfiesexpression", "NOT (o_custkey > 100 OR o_totalprice < 300000)"
    ),
    "existsIn": failing(
        "orders__existsin__o_custkey",
        f"o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM {duck(RICH_CUSTOMERS)} r)",
    ),
    "notExistsIn": failing(
        "orders__notexistsin__o_custkey",
        f"o_custkey IN (SELECT c_custkey FROM {duck(RICH_CUSTOMERS)} r)",
    ),
    "isReplicaOf": """
        WITH l AS (SELECT l_suppkey, l_quantity, l_returnflag, l_linestatus FROM lineitem),
        r AS (SELECT l_suppkey, least(l_quantity, 45) AS l_quantity, l_returnflag, l_linestatus FROM lineitem)
        SELECT *, 'left_only' AS _side, count(*) AS copies FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) GROUP BY ALL
        UNION ALL
        SELECT *, 'right_only', count(*) FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l) GROUP BY ALL""",
    "dataDiff": f"""
        WITH l AS (SELECT o_orderkey, count(*) AS n, min(o_orderstatus) AS s, min(o_totalprice) AS p
                   FROM {duck(LATER_ORDERS)} a GROUP BY 1),
        r AS (SELECT o_orderkey, count(*) AS n, min(o_orderstatus) AS s, min(o_totalprice) AS p
              FROM {duck(BASE_ORDERS)} b GROUP BY 1),
        j AS (SELECT coalesce(l.o_orderkey, r.o_orderkey) AS o_orderkey,
                     CASE WHEN l.n > 1 OR r.n > 1 THEN 'repeated_key' WHEN r.n IS NULL THEN 'added'
                          WHEN l.n IS NULL THEN 'removed'
                          WHEN l.s IS DISTINCT FROM r.s OR l.p IS DISTINCT FROM r.p THEN 'changed' END AS diff,
                     concat_ws(',', CASE WHEN l.s IS DISTINCT FROM r.s THEN 'o_orderstatus' END,
                                    CASE WHEN l.p IS DISTINCT FROM r.p THEN 'o_totalprice' END) AS f,
                     coalesce(l.n, 0) AS left_rows, coalesce(r.n, 0) AS right_rows
              FROM l FULL JOIN r ON l.o_orderkey = r.o_orderkey)
        SELECT o_orderkey, diff, CASE WHEN diff = 'changed' THEN f END AS changed_fields, left_rows, right_rows
        FROM j WHERE diff IS NOT NULL""",
    "afterDateTime": failing("orders__afterdatetime__o_orderdate", "o_orderdate <= TIMESTAMP '1995-06-30'"),
    "aggregationComparison": """
        WITH v AS (SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS a, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS b),
        c AS (SELECT 'eq' AS check_uid, a = b AS ok, a, b FROM v UNION ALL SELECT 'ne', a <> b, a, b FROM v
              UNION ALL SELECT 'lt', a < b, a, b FROM v UNION ALL SELECT 'lte', a <= b, a, b FROM v
              UNION ALL SELECT 'gt', a > b, a, b FROM v UNION ALL SELECT 'gte', a >= b, a, b FROM v)
        SELECT check_uid, 'shape' AS anomaly_type, a || ' ' || check_uid || ' ' || b || ' is false' AS message
        FROM c WHERE NOT ok""",
    "volumetric": """
        WITH f AS (SELECT 'orders__volumetric' AS check_uid, count(*) AS n, count(*) >= 1 AS ok FROM orders
                   UNION ALL SELECT 'customer__volumetric', count(*), count(*) <= 10 FROM customer
                   UNION ALL SELECT 'lineitem__volumetric', count(*), count(*) >= 100000000 FROM lineitem WHERE l_quantity > 25)
        SELECT check_uid, 'row count ' || n AS message, sha256(check_uid || '|') AS fingerprint FROM f WHERE NOT ok""",
    "check_filter": failing("orders__notnull__o_custkey", "o_custkey IS NULL AND o_orderstatus = 'F'")
    + " UNION ALL "
    + failing(
        "orders__unique__o_orderdate", "n > 1",
        "(SELECT *, count(*) OVER (PARTITION BY o_orderdate) AS n FROM orders WHERE o_totalprice > 490000)",
    ),
    "check_coverage": failing("orders__notnull__o_orderpriority", f"o_orderpriority IS NULL AND {_HASH} < 1073741824")
    + " UNION ALL "
    + failing("orders__between__o_totalprice", f"o_totalprice > 200000 AND {_HASH} < 2147483648"),
    "anomaly_message": f"""
        SELECT {_KEY} AS record_key, coalesce(o_orderpriority, 'too dear') AS message
        FROM {duck(HOLED)} h WHERE o_totalprice > 300000""",
    "active_only": f"""
        SELECT id, container, rule_type, status FROM {duck(CHECKS)} c WHERE status = 'Active' AND NOT archived""",
    "check_select": f"""
        SELECT id, container, status, 'draft' AS listing FROM {duck(CHECKS)} c
        WHERE NOT archived AND status = 'Draft' AND CAST(substr(container, 10) AS INTEGER) BETWEEN 1 AND 39
          AND list_has_any(string_split(tags, ','), ['promo', 'brand#4'])
        UNION ALL SELECT id, container, status, 'archived' FROM {duck(CHECKS)} c
        WHERE archived AND list_has_any(string_split(tags, ','), ['economy'])""",
}
