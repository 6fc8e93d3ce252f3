"""Inputs of the registered queries.

A frame is one piece of SQL that both engines understand; ``{orders}`` stands
for a table. Spark gets the DataFrame, the SQL counterpart the table's name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.sources.readers import table_scan

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return table_scan(spark, sf, name)


def frame(spark: SparkSession, sf: str, sql: str, *arrays: str) -> DataFrame:
    """A frame as a DataFrame; ``arrays`` are comma lists turned into arrays."""
    names = set(re.findall(r"\{(\w+)\}", sql))
    df = spark.sql(sql, **{n: table(spark, sf, n) for n in names})
    return df.withColumns(
        {a: F.when(F.col(a) == "", F.array().cast("array<string>")).otherwise(F.split(a, ",")) for a in arrays}
    ) if arrays else df


def duck(sql: str) -> str:
    """The same frame for the SQL counterpart."""
    return "(" + re.sub(r"\{(\w+)\}", r"\1", sql).strip() + ")"


def sql_fingerprint(uid: str, key: str) -> str:
    return f"sha256({uid} || '|' || {key})"


# Anomalies as an earlier life of the order book: one per order.
ANOMALIES = """
SELECT CAST(o_orderkey AS STRING) AS id,
       'orders__' || lower(substr(o_orderpriority, 3)) AS check_uid,
       'customer_' || CAST(o_custkey AS STRING) AS container,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'notNull' WHEN '2' THEN 'between'
            WHEN '3' THEN 'unique' WHEN '4' THEN 'existsIn' ELSE 'volumetric' END AS rule_type,
       CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 'shape' ELSE 'record' END AS anomaly_type,
       CASE WHEN o_orderstatus = 'O' THEN 'Active'
            WHEN o_orderstatus = 'P' THEN 'Acknowledged'
            WHEN o_totalprice < 100000 THEN 'Invalid'
            WHEN o_totalprice < 200000 THEN 'Duplicate'
            WHEN o_totalprice < 300000 THEN 'Discarded'
            ELSE 'Resolved' END AS status,
       o_orderstatus = 'F' AS archived,
       o_orderdate AS created,
       CAST(floor(o_totalprice / 10000) AS INT) AS weight,
       lower(o_orderstatus) || ',' || lower(substr(o_orderpriority, 3)) AS tags,
       CAST(NULL AS STRING) AS description,
       CAST(o_custkey AS STRING) AS assignees,
       o_totalprice > 250000 AS source_enriched
FROM {orders}
"""

# Customers as containers of the datastore of their nation.
CONTAINERS = """
SELECT c_custkey AS id,
       'customer_' || CAST(c_custkey AS STRING) AS name,
       'store_' || CAST(c_nationkey AS STRING) AS datastore,
       c_nationkey AS datastore_id,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'table' WHEN 'BUILDING' THEN 'view'
            WHEN 'AUTOMOBILE' THEN 'file' WHEN 'FURNITURE' THEN 'computed_table'
            ELSE 'computed_join' END AS container_type,
       lower(c_mktsegment) || ',n' || CAST(c_nationkey AS STRING) AS tags,
       c_acctbal < 0 AS archived
FROM {customer}
"""

# Parts as stored checks on customers' containers.
CHECKS = """
SELECT p_partkey AS id,
       'customer_' || CAST(p_size AS STRING) AS container,
       CASE p_type WHEN 'MEDIUM' THEN 'notNull' WHEN 'ECONOMY' THEN 'between'
            WHEN 'STANDARD' THEN 'existsIn' WHEN 'LARGE' THEN 'dataDiff'
            WHEN 'PROMO' THEN 'matchesPattern' ELSE 'volumetric' END AS rule_type,
       CASE WHEN p_type = 'SMALL' THEN '' ELSE replace(p_name, ' ', ',') END AS fields,
       CASE WHEN p_retailprice < 930 THEN '' WHEN p_retailprice < 960 THEN CAST(NULL AS STRING)
            ELSE 'Check of ' || p_name END AS description,
       CASE WHEN p_size < 25 THEN 1.0 ELSE 0.5 END AS coverage,
       CASE WHEN p_retailprice > 950 THEN 'Draft' ELSE 'Active' END AS status,
       lower(p_brand) || ',' || lower(p_type) AS tags,
       p_retailprice > 990 AS archived
FROM {part}
"""
