"""Queries S: scans, sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.operators import computed, observe
from veriframe.operators.registry import Check, checks_frame
from veriframe.operators.scan import Container, scan
from veriframe.plans.common import ANOMALIES, CONTAINERS, TABLES, duck, frame, table
from veriframe.session import scratch
from veriframe.sources import bounds, discover, readers, sampling, sinks


def q_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    df = readers.table_scan(spark, sf, "orders")
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


CUSTOMER_FILE = """
SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS segment, c_acctbal
FROM {customer}
"""


def q_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "file_scan")
    frame(spark, sf, CUSTOMER_FILE).write.option("header", True).csv(path)
    return readers.file_scan(spark, path, has_header=True, infer=True, empty_as_null=True)


def q_discover_containers(spark: SparkSession, sf: str) -> DataFrame:
    found = discover.discover_files(spark, sf, exclude=["labels"], exclude_prefixes=["conv"])
    counts = reduce(
        DataFrame.unionByName,
        [bounds.row_count(table(spark, sf, t)).withColumn("name", F.lit(t)) for t in TABLES],
    )
    return found.join(counts, "name").select("name", "container_type", "row_count")


ORDERED_CUSTOMERS = """
SELECT 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS name FROM {orders}
WHERE o_totalprice > 100000
UNION SELECT s_name AS name FROM {supplier}
"""


def q_sync_diff(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "customer").select(F.col("c_name").alias("name"))
    return discover.sync_diff(found, frame(spark, sf, ORDERED_CUSTOMERS), prune=True)


def q_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return bounds.row_count(table(spark, sf, "lineitem"))


def q_partition_bounds(spark: SparkSession, sf: str) -> DataFrame:
    price = bounds.partition_bounds(table(spark, sf, "lineitem"), "l_extendedprice", 3)
    dates = bounds.partition_bounds(table(spark, sf, "orders"), "o_orderdate", 3)
    both = price.withColumn("field", F.lit("l_extendedprice")).unionByName(
        dates.withColumn("field", F.lit("o_orderdate"))
    )
    return both.select(
        "field", "part", F.round(F.col("lower").cast("double"), 4).alias("lower"),
        F.round(F.col("upper").cast("double"), 4).alias("upper"), "row_count",
    )


def q_schema_only(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem")
    shape = bounds.schema_rows(bounds.schema_only(df)).select("ordinal", "field", "type")
    return shape.join(observe.null_check(df), "field")


def q_table_sample(spark: SparkSession, sf: str) -> DataFrame:
    df = sampling.table_sample(table(spark, sf, "orders"), 10, seed=7, key=["o_orderkey"])
    return df.select("o_orderkey", "o_custkey", "o_totalprice")


def q_view_sample(spark: SparkSession, sf: str) -> DataFrame:
    df = sampling.view_sample(table(spark, sf, "orders"), 100, ["o_orderkey"])
    return df.select("o_orderkey", "o_custkey")


def q_incremental_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    by_time = readers.incremental_filter(orders, "o_orderdate", greater_than_time="1998-01-01 00:00:00")
    by_batch = readers.incremental_filter(orders, "o_totalprice", greater_than_batch=250000)
    return by_time.select("o_orderkey", F.lit("time").alias("kind")).unionAll(
        by_batch.select("o_orderkey", F.lit("batch").alias("kind"))
    )


def q_incremental_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """The mark after the 20th century, then the mark of the rows past it."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    old = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    first = readers.next_checkpoint(old, "orders", "o_orderdate")
    rest = readers.read_past_checkpoint(orders, "o_orderdate", first)
    second = readers.next_checkpoint(rest, "orders", "o_orderdate", previous=first)
    batch = readers.next_checkpoint(lines, "lineitem", "l_extendedprice", "batch")
    step = lambda df, n: df.withColumn("step", F.lit(n))
    return step(first, 1).unionByName(step(second, 2)).unionByName(step(batch, 1))


CAP_ORDER = ["l_extendedprice", "l_orderkey", "l_partkey", "l_linenumber"]


def q_cap_per_partition(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return sampling.cap_per_partition(lines, 3, ["l_suppkey"], CAP_ORDER).select("l_suppkey", *CAP_ORDER)


def q_cap_hot_group(spark: SparkSession, sf: str) -> DataFrame:
    """A cap beyond what one task ranks, on three values that share all lines."""
    lines = table(spark, sf, "lineitem")
    return sampling.cap_per_partition(lines, 1_500, ["l_returnflag"], CAP_ORDER).select("l_returnflag", *CAP_ORDER)


def q_cap_default_split(spark: SparkSession, sf: str) -> DataFrame:
    """No partition columns: orders are dealt to parts by a hash of their key and drawn by it."""
    return sampling.cap_per_partition(table(spark, sf, "orders"), 10, keys=["o_orderkey"]).select("o_orderkey", "o_custkey")


def q_materialize(spark: SparkSession, sf: str) -> DataFrame:
    monthly = computed.computed_file(
        table(spark, sf, "lineitem"),
        "l_suppkey, l_returnflag, count(1) AS n, round(sum(l_extendedprice), 2) AS price",
        group_by="l_suppkey, l_returnflag",
    )
    return sinks.materialize(
        monthly, scratch(spark, "materialize"), 50, ["l_returnflag"], ["price", "l_suppkey"]
    )


def q_enrichment_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs, the second one three times: the rows the store then holds."""
    orders = table(spark, sf, "orders")
    root = scratch(spark, "enrichment_runs")
    for run_id, limit in (("first", 400_000), ("second", 450_000), ("second", 450_000), ("second", 450_000)):
        check = Check("orders", "between", ["o_totalprice"], {"max_value": limit})
        failures = scan(spark, {"orders": Container(orders, ["o_orderkey"])}, checks_frame(spark, [check]))
        rows = orders.filter(F.col("o_totalprice") > limit).select(F.col("o_orderkey").cast("string").alias("record_key"))
        paths = sinks.enrichment_write(failures, root, "dq_", "append", rows, run_id)
    stored = [spark.read.parquet(path).select("run_id", "record_key").withColumn("table_name", F.lit(name)) for name, path in paths.items()]
    return stored[0].unionByName(stored[1])


def q_enrichment_write(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs with append, append and overwrite, as the store then holds them."""
    orders = table(spark, sf, "orders")
    check = Check("orders", "between", ["o_totalprice"], {"max_value": 400000})
    failures = scan(spark, {"orders": Container(orders, ["o_orderkey"])}, checks_frame(spark, [check]))
    source = orders.filter("o_totalprice > 400000")
    root = scratch(spark, "enrichment")
    for strategy in ("append", "append", "overwrite", "none"):
        paths = sinks.enrichment_write(failures, root, "dq_", strategy, source)
    stored = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, stored)


def q_export_assets(spark: SparkSession, sf: str) -> DataFrame:
    assets = {"anomalies": frame(spark, sf, ANOMALIES, "tags")}
    containers = frame(spark, sf, CONTAINERS, "tags")
    path = scratch(spark, "export")
    out = sinks.export_assets(assets, containers, "anomalies", tags=["building", "n3"])
    out.select("id", "container", "check_uid", "status", "weight").write.parquet(path)
    return spark.read.parquet(path)


QUERIES = {
    "table_scan": q_table_scan,
    "file_scan": q_file_scan,
    "discover_containers": q_discover_containers,
    "sync_diff": q_sync_diff,
    "row_count": q_row_count,
    "partition_bounds": q_partition_bounds,
    "schema_only": q_schema_only,
    "table_sample": q_table_sample,
    "view_sample": q_view_sample,
    "incremental_filter": q_incremental_filter,
    "incremental_checkpoint": q_incremental_checkpoint,
    "cap_per_partition": q_cap_per_partition,
    "cap_hot_group": q_cap_hot_group,
    "cap_default_split": q_cap_default_split,
    "materialize": q_materialize,
    "enrichment_write": q_enrichment_write,
    "enrichment_runs": q_enrichment_runs,
    "export_assets": q_export_assets,
}

_LINE_FIELDS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)

ORACLES = {
    "table_scan": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""",
    "file_scan": f"""
        SELECT c_custkey, c_name, nullif(segment, '') AS segment, c_acctbal FROM {duck(CUSTOMER_FILE)}""",
    "discover_containers": " UNION ALL ".join(
        f"SELECT '{t}' AS name, 'file' AS container_type, count(*) AS row_count FROM {t}"
        for t in TABLES
        if t not in ("labels", "conversations")
    ),
    "sync_diff": f"""
        SELECT name, state, CASE state WHEN 'new' THEN 'create' WHEN 'missing' THEN 'drop' ELSE 'keep' END AS action
        FROM (SELECT coalesce(d.name, r.name) AS name,
                     CASE WHEN r.name IS NULL THEN 'new' WHEN d.name IS NULL THEN 'missing' ELSE 'kept' END AS state
              FROM (SELECT DISTINCT c_name AS name FROM customer) d
              FULL JOIN {duck(ORDERED_CUSTOMERS)} r ON d.name = r.name)""",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "partition_bounds": """
        WITH v AS (SELECT 'l_extendedprice' AS field, l_extendedprice AS v FROM lineitem
                   UNION ALL SELECT 'o_orderdate', CAST(epoch(o_orderdate) AS DOUBLE) FROM orders),
        s AS (SELECT field, min(v) AS lo, max(v) AS hi,
                     CASE WHEN field = 'o_orderdate' THEN floor((max(v) - min(v)) / 3)
                          ELSE (max(v) - min(v)) / 3 END AS step FROM v GROUP BY field),
        c AS (SELECT v.field, CAST(least(floor((v - lo) / step), 2) AS INTEGER) AS part, count(*) AS row_count
              FROM v JOIN s ON v.field = s.field GROUP BY 1, 2)
        SELECT s.field, c.part, round(lo + step * c.part, 4) AS lower,
               round(CASE WHEN c.part = 2 THEN hi ELSE lo + step * (c.part + 1) END, 4) AS upper, row_count
        FROM s JOIN c ON s.field = c.field""",
    "schema_only": """
        WITH d AS (SELECT column_name AS field, column_type AS t FROM (DESCRIBE lineitem)),
        n AS ("""
    + " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{f}' AS field, count(*) AS row_count, count(*) - count({f}) AS null_count FROM lineitem"
        for i, f in enumerate(_LINE_FIELDS, 1)
    )
    + """)
        SELECT n.field, ordinal, CASE t WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
               WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS type,
               row_count, null_count FROM n JOIN d ON n.field = d.field""",
    "table_sample": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE ('0x' || substr(md5('7|' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT < 429496730""",
    "view_sample": """
        SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 100""",
    "incremental_filter": """
        SELECT o_orderkey, 'time' AS kind FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
        UNION ALL SELECT o_orderkey, 'batch' FROM orders WHERE o_totalprice > 250000""",
    "incremental_checkpoint": """
        SELECT 'orders' AS container, 'o_orderdate' AS field, 'last-modified' AS kind,
               CAST(max(o_orderdate) AS VARCHAR) AS high_water, 1 AS step FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
        UNION ALL SELECT 'orders', 'o_orderdate', 'last-modified', CAST(max(o_orderdate) AS VARCHAR), 2 FROM orders
        UNION ALL SELECT 'lineitem', 'l_extendedprice', 'batch', CAST(max(l_extendedprice) AS VARCHAR), 1 FROM lineitem""",
    "cap_per_partition": """
        SELECT l_suppkey, l_extendedprice, l_orderkey, l_partkey, l_linenumber FROM (
            SELECT *, row_number() OVER (PARTITION BY l_suppkey
                ORDER BY l_extendedprice, l_orderkey, l_partkey, l_linenumber) AS rn FROM lineitem) WHERE rn <= 3""",
    "cap_hot_group": """
        SELECT l_returnflag, l_extendedprice, l_orderkey, l_partkey, l_linenumber FROM (
            SELECT *, row_number() OVER (PARTITION BY l_returnflag
                ORDER BY l_extendedprice, l_orderkey, l_partkey, l_linenumber) AS rn FROM lineitem) WHERE rn <= 1500""",
    "cap_default_split": """
        SELECT o_orderkey, o_custkey FROM (
            SELECT *, row_number() OVER (PARTITION BY CAST('0x' || d[1:8] AS BIGINT) % 32 ORDER BY d) AS rn
            FROM (SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS d FROM orders)) WHERE rn <= 10""",
    "materialize": """
        SELECT l_suppkey, l_returnflag, n, price FROM (
            SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY price, l_suppkey) AS rn FROM (
                SELECT l_suppkey, l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS price
                FROM lineitem GROUP BY ALL)) WHERE rn <= 50""",
    "enrichment_runs": """
        SELECT run_id, CAST(o_orderkey AS VARCHAR) AS record_key, table_name FROM orders
        JOIN (VALUES ('first', 400000), ('second', 450000)) r(run_id, bound) ON o_totalprice > bound
        CROSS JOIN (VALUES ('anomalies'), ('source_records')) t(table_name)""",
    "enrichment_write": """
        SELECT 'anomalies' AS table_name, 4 * count(*) AS row_count FROM orders WHERE o_totalprice > 400000
        UNION ALL SELECT 'source_records', count(*) FROM orders WHERE o_totalprice > 400000""",
    "export_assets": f"""
        SELECT id, container, check_uid, status, weight FROM {duck(ANOMALIES)} a
        WHERE NOT archived AND container IN (
            SELECT name FROM {duck(CONTAINERS)} c
            WHERE list_has_any(string_split(tags, ','), ['building', 'n3']))""",
}
