"""Queries C and F: computed containers, bulk definitions and computed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.text import parse_tags, rule_id
from veriframe.operators import computed, definitions, fields
from veriframe.operators.fields import ComputedField
from veriframe.operators.registry import checks_frame
from veriframe.operators.scan import Container, scan
from veriframe.plans.common import duck, frame, sql_fingerprint, table
from veriframe.session import scratch

SEGMENT_QUERY = """
SELECT n.n_name, c.c_mktsegment, count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderdate >= DATE '1997-01-01'
GROUP BY n.n_name, c.c_mktsegment HAVING count(*) > 5
"""


def _tables(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf, n) for n in names}


def q_computed_table(spark: SparkSession, sf: str) -> DataFrame:
    return computed.computed_table(spark, _tables(spark, sf, "orders", "customer", "nation"), SEGMENT_QUERY)


def q_computed_file(spark: SparkSession, sf: str) -> DataFrame:
    return computed.computed_file(
        table(spark, sf, "lineitem"),
        "l_returnflag, l_linestatus, count(1) AS n, round(sum(l_quantity), 2) AS qty, "
        "round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue",
        where="l_shipdate > '1996-06-30' AND l_discount BETWEEN 0.02 AND 0.08",
        group_by="l_returnflag, l_linestatus",
    )


def q_lateral_view(spark: SparkSession, sf: str) -> DataFrame:
    return computed.computed_file(
        table(spark, sf, "documents"),
        "lang, source, count(1) AS words, count(DISTINCT word) AS distinct_words, max(length(word)) AS longest",
        group_by="lang, source",
        lateral_views=["EXPLODE(split(text, ' ')) word"],
    )


def _customer_orders(spark: SparkSession, sf: str, how: str, **clauses: str) -> DataFrame:
    t = _tables(spark, sf, "customer", "orders")
    return computed.computed_join(
        t["customer"], t["orders"], "c_custkey", "o_custkey", how=how,
        left_prefix="c_", right_prefix="o_", **clauses,
    )


def q_computed_join_inner(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_orders(
        spark, sf, "inner",
        select="c_c_mktsegment AS segment, o_o_orderstatus AS status, count(1) AS n, "
        "round(sum(o_o_totalprice), 2) AS price",
        where="c_c_acctbal > 0",
        group_by="c_c_mktsegment, o_o_orderstatus",
    )


BIG_ORDERS = "SELECT o_orderkey, CASE WHEN o_totalprice > 450000 THEN o_custkey END AS o_custkey, o_totalprice FROM {orders}"


def _key_joined(spark: SparkSession, sf: str, how: str) -> DataFrame:
    """Customers against orders whose customer is only known above a price."""
    return computed.computed_join(
        table(spark, sf, "customer"), frame(spark, sf, BIG_ORDERS), "c_custkey", "o_custkey",
        how=how, left_prefix="l_", right_prefix="r_",
        select="CAST(l_c_custkey AS STRING) AS c_custkey, count(r_o_orderkey) AS n_orders, count(1) AS n_rows, "
        "round(sum(r_o_totalprice), 2) AS price",
        group_by="l_c_custkey",
    )


def q_computed_join_left(spark: SparkSession, sf: str) -> DataFrame:
    return _key_joined(spark, sf, "left")


def q_computed_join_right(spark: SparkSession, sf: str) -> DataFrame:
    return _key_joined(spark, sf, "right")


def q_computed_join_full(spark: SparkSession, sf: str) -> DataFrame:
    return _key_joined(spark, sf, "full")


JOIN_SQL = """
SELECT r.r_name AS region, p.p_brand AS brand, count(*) AS n, round(sum(l.l_extendedprice), 2) AS price
FROM li l JOIN pa p ON l.l_partkey = p.p_partkey JOIN su s ON l.l_suppkey = s.s_suppkey
JOIN na n ON s.s_nationkey = n.n_nationkey JOIN re r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, p.p_brand
"""
JOIN_ALIASES = {"li": "lineitem", "pa": "part", "su": "supplier", "na": "nation", "re": "region"}


def q_computed_join_sql(spark: SparkSession, sf: str) -> DataFrame:
    sources = {alias: table(spark, sf, name) for alias, name in JOIN_ALIASES.items()}
    return computed.computed_join_sql(spark, sources, JOIN_SQL)


def q_auto_alias(spark: SparkSession, sf: str) -> DataFrame:
    query = (
        "SELECT lower(l_returnflag), l_linestatus, count(*), max(l_quantity) AS qty, "
        "min(l_partkey) + 1 FROM lineitem GROUP BY lower(l_returnflag), l_linestatus"
    )
    return computed.auto_alias(computed.computed_table(spark, _tables(spark, sf, "lineitem"), query))


CONTAINER_DEFS = """
SELECT p_partkey AS id,
       CASE WHEN p_size < 10 THEN 'computed_table' WHEN p_size < 25 THEN 'computed_file'
            WHEN p_size < 45 THEN 'computed_join' ELSE 'view' END AS container_type,
       CASE WHEN p_type <> 'ECONOMY' THEN 'SELECT * FROM ' || p_type END AS query,
       CASE WHEN p_retailprice > 920 THEN p_brand END AS source_name,
       CASE WHEN p_type <> 'PROMO' THEN '*' END AS select_clause,
       CASE WHEN p_retailprice > 910 THEN p_brand END AS left_name,
       p_name AS right_name,
       CASE WHEN p_type <> 'LARGE' THEN 'id' END AS left_key_field,
       'id' AS right_key_field,
       CASE p_type WHEN 'SMALL' THEN 'cross' WHEN 'MEDIUM' THEN 'full' WHEN 'STANDARD' THEN 'inner' END AS join_type
FROM {part}
"""


def q_validate_container(spark: SparkSession, sf: str) -> DataFrame:
    checked = computed.validate_definitions_bulk(frame(spark, sf, CONTAINER_DEFS))
    return checked.select("id", "container_type", "valid", "reason")


OLD_FIELDS = "SELECT p_brand AS container, p_name AS field FROM {part}"
NEW_FIELDS = "SELECT p_brand AS container, p_name AS field FROM {part} WHERE p_size > 15"
FIELD_CHECKS = "SELECT p_brand AS container, p_name AS fields FROM {part} WHERE p_type IN ('ECONOMY', 'PROMO')"
FIELD_ANOMALIES = """
SELECT p.p_brand AS container, p.p_name AS field FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
WHERE l.l_discount > 0.09
"""


def q_field_drop_guard(spark: SparkSession, sf: str) -> DataFrame:
    return computed.field_drop_guard(
        frame(spark, sf, OLD_FIELDS), frame(spark, sf, NEW_FIELDS),
        frame(spark, sf, FIELD_CHECKS, "fields"), frame(spark, sf, FIELD_ANOMALIES),
    )


DEFINITION_FILE = """
SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '  '
            ELSE 'chk_' || CAST(o_orderkey AS STRING) END AS name,
       'Price, "' || o_orderpriority || '"' AS description,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN ''
            ELSE 'SELECT *' || chr(10) || 'FROM orders' || chr(10) || 'WHERE o_custkey = ' || CAST(o_custkey AS STRING)
       END AS query
FROM {orders}
"""


def q_load_definitions(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "definitions")
    (
        frame(spark, sf, DEFINITION_FILE)
        .write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    )
    return definitions.load_definitions(spark, path, ",").select("name", "description", "query")


DEFINITIONS = """
SELECT c_custkey + 1 AS row,
       CASE WHEN c_nationkey = 3 THEN '' ELSE lower(c_mktsegment) || '_' || CAST(c_nationkey AS STRING) END AS name,
       c_name AS description,
       CASE WHEN c_acctbal < 0 THEN '' ELSE 'SELECT * FROM t WHERE k = ' || CAST(c_custkey AS STRING) END AS query
FROM {customer}
"""


def q_validate_definitions(spark: SparkSession, sf: str) -> DataFrame:
    checked = definitions.validate_definitions(frame(spark, sf, DEFINITIONS))
    return checked.select("row", "name", "valid", "reason")


PLAN_DEFS = "SELECT CAST(p_partkey AS STRING) || '_' || replace(p_name, ' ', '_') AS name, p_type AS description FROM {part}"
PLAN_KNOWN = """
SELECT DISTINCT 'ct_' || CAST(p.p_partkey AS STRING) || '_' || replace(p.p_name, ' ', '_') AS name
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey WHERE l.l_discount > 0.09 AND l.l_quantity > 40
"""
PLAN_CHECKED = """
SELECT DISTINCT 'ct_' || CAST(p.p_partkey AS STRING) || '_' || replace(p.p_name, ' ', '_') AS name
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey WHERE l.l_tax > 0.07 AND l.l_quantity > 45
"""


def q_plan_definitions(spark: SparkSession, sf: str) -> DataFrame:
    planned = definitions.plan_definitions(
        frame(spark, sf, PLAN_DEFS), frame(spark, sf, PLAN_KNOWN), frame(spark, sf, PLAN_CHECKED)
    )
    return planned.select("table_name", "table_action", "check_action")


ERROR_QUERY = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 480000 OR o_orderdate < DATE '1995-02-01'"


def q_error_query_check(spark: SparkSession, sf: str) -> DataFrame:
    bad = computed.computed_table(spark, _tables(spark, sf, "orders"), ERROR_QUERY)
    check = definitions.error_query_check(bad, "ct_price", "Price or date out of bounds", as_draft=False)
    failures = scan(spark, {"ct_price": Container(bad, ["o_orderkey"])}, checks_frame(spark, [check]))
    return failures.select("check_uid", "rule_type", "record_key", "message", "fingerprint")


RULE_NAMES = """
SELECT p_partkey, replace(p_name, ' ', '_') || CASE p_type WHEN 'MEDIUM' THEN '_SF' WHEN 'ECONOMY' THEN '_db'
       WHEN 'STANDARD' THEN '_SNOWFLAKE' WHEN 'LARGE' THEN '_Sf' WHEN 'PROMO' THEN '_PG_BQ' ELSE '' END AS name
FROM {part}
"""


def q_rule_id(spark: SparkSession, sf: str) -> DataFrame:
    return definitions.with_rule_id(frame(spark, sf, RULE_NAMES))


TAG_TEXTS = "SELECT p_partkey, ' ' || p_brand || ' ;' || p_type || ', ,' || p_name || ';;' AS tags FROM {part}"


def q_parse_tags(spark: SparkSession, sf: str) -> DataFrame:
    tags = parse_tags(F.col("tags"))
    return frame(spark, sf, TAG_TEXTS).select(
        "p_partkey", F.array_join(tags, "|").alias("tags"), F.size(tags).alias("n_tags")
    )


# --- computed fields -------------------------------------------------------

TEXT_PRICES = """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority ELSE CAST(o_custkey AS STRING) END AS txt,
       CAST(o_totalprice AS STRING) AS price FROM {orders}
"""


def q_cast_field(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, TEXT_PRICES).select(
        "o_orderkey",
        fields.cast_field("txt", "bigint").cast("string").alias("as_bigint"),
        fields.cast_field("price", "double").alias("as_double"),
    )


DATE_TEXTS = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
       ELSE lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
            || '/' || CAST(year(o_orderdate) AS STRING) END AS txt
FROM {orders}
"""


def q_cast_field_format(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, DATE_TEXTS).select(
        "o_orderkey",
        fields.cast_field("txt", "date", "dd/MM/yyyy").cast("string").alias("as_date"),
        F.date_format(fields.cast_field("txt", "timestamp", "dd/MM/yyyy"), "yyyy-MM-dd HH:mm:ss").alias("as_time"),
    )


ENTITIES = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'The ' ELSE '' END || 'Customer ' ||
       CASE WHEN o_orderstatus = 'O' THEN 'Holding ' ELSE '' END || CAST(o_custkey AS STRING) ||
       CASE o_orderpriority WHEN '1-URGENT' THEN ', Inc.' WHEN '2-HIGH' THEN ' L.L.C.' WHEN '3-MEDIUM' THEN ' Corp. LLC'
            WHEN '4-NOT SPECIFIED' THEN ' Holding' ELSE '' END AS entity
FROM {orders}
"""
ENTITY_TERMS = ["Inc.", "LLC", "Corp.", "The", "Holding", "Customer"]


def q_cleaned_entity_name(spark: SparkSession, sf: str) -> DataFrame:
    clean = fields.cleaned_entity_name(
        "entity", terms_to_drop=ENTITY_TERMS, terms_to_ignore=["customer"],
        suffix=True, prefix=True, interior=True,
    )
    return frame(spark, sf, ENTITIES).select("o_orderkey", clean.alias("cleaned"))


NUMBER_TEXTS = """
SELECT o_orderkey, CASE o_orderpriority
         WHEN '1-URGENT' THEN '$ ' || CAST(CAST(floor(o_totalprice / 1000) AS INT) AS STRING) || ',' || lpad(CAST(o_custkey AS STRING), 3, '0')
         WHEN '2-HIGH' THEN '(' || CAST(o_totalprice AS STRING) || ')'
         WHEN '3-MEDIUM' THEN CAST(o_custkey AS STRING) || ' %'
         WHEN '4-NOT SPECIFIED' THEN o_orderpriority
         ELSE '-' || CAST(o_totalprice AS STRING) || ' €' END AS txt
FROM {orders}
"""


def q_convert_formatted_numeric(spark: SparkSession, sf: str) -> DataFrame:
    value = fields.convert_formatted_numeric("txt")
    return frame(spark, sf, NUMBER_TEXTS).select("o_orderkey", F.round(value, 6).alias("value"))


def q_custom_expression(spark: SparkSession, sf: str) -> DataFrame:
    field = ComputedField(
        "band", "customExpression", None,
        {"column_expression": "CONCAT(o_orderstatus, '-', CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END)"},
    )
    return fields.apply_computed_fields(table(spark, sf, "orders"), [field]).select("o_orderkey", "band")


def q_concatenate(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").withColumn("seg", F.expr("nullif(c_mktsegment, 'BUILDING')"))
    return df.select("c_custkey", fields.concatenate(["c_name", "seg", "c_nationkey"], " / ").alias("joined"))


LOOKUP_NAMES = """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_linestatus = 'O' THEN '  SUPPLIER#' || lpad(CAST(l_suppkey AS STRING), 9, '0')
            WHEN l_returnflag = 'R' THEN 'unknown' ELSE 'supplier#' || lpad(CAST(l_suppkey AS STRING), 9, '0') || '.' END AS who
FROM {lineitem}
"""


def q_entity_name_lookup(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier")
    named = fields.entity_name_lookup(
        frame(spark, sf, LOOKUP_NAMES), "who", suppliers, "s_name", "s_suppkey", "supplier_id"
    )
    return named.groupBy("who", F.col("supplier_id").cast("string").alias("supplier_id")).agg(F.count(F.lit(1)).alias("n"))


COMPUTED_FIELDS = [
    ComputedField("o_orderstatus", "customExpression", None, {"column_expression": "lower(o_orderstatus)"}),
    ComputedField("label", "concatenate", ["o_orderpriority", "o_orderstatus"], {"separator": ":"}),
    ComputedField("price_int", "cast", ["o_totalprice"], {"target_type": "bigint"}),
    ComputedField(
        "who", "entityNameLookup", ["o_orderstatus"],
        {"ref_container_name": "regions", "ref_field": "initial", "ref_id_field": "r_regionkey"},
    ),
]
REGION_INITIALS = "SELECT r_regionkey, CASE r_regionkey WHEN 0 THEN 'F' WHEN 1 THEN 'o.' ELSE r_name END AS initial FROM {region}"


def q_apply_computed_fields(spark: SparkSession, sf: str) -> DataFrame:
    out = fields.apply_computed_fields(
        table(spark, sf, "orders"), COMPUTED_FIELDS, {"regions": frame(spark, sf, REGION_INITIALS)}
    )
    return out.select("o_orderkey", "o_orderstatus", "label", "price_int", F.col("who").cast("string").alias("who"))


QUERIES = {
    "computed_table": q_computed_table,
    "computed_file": q_computed_file,
    "lateral_view": q_lateral_view,
    "computed_join_inner": q_computed_join_inner,
    "computed_join_left": q_computed_join_left,
    "computed_join_right": q_computed_join_right,
    "computed_join_full": q_computed_join_full,
    "computed_join_sql": q_computed_join_sql,
    "auto_alias": q_auto_alias,
    "validate_container": q_validate_container,
    "field_drop_guard": q_field_drop_guard,
    "load_definitions": q_load_definitions,
    "validate_definitions": q_validate_definitions,
    "plan_definitions": q_plan_definitions,
    "error_query_check": q_error_query_check,
    "rule_id": q_rule_id,
    "parse_tags": q_parse_tags,
    "cast_field": q_cast_field,
    "cast_field_format": q_cast_field_format,
    "cleaned_entity_name": q_cleaned_entity_name,
    "convert_formatted_numeric": q_convert_formatted_numeric,
    "custom_expression": q_custom_expression,
    "concatenate": q_concatenate,
    "entity_name_lookup": q_entity_name_lookup,
    "apply_computed_fields": q_apply_computed_fields,
}


def _joined_sql(how: str) -> str:
    return f"""
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, count(o_orderkey) AS n_orders, count(*) AS n_rows, round(sum(o_totalprice), 2) AS price
        FROM customer {how} JOIN {duck(BIG_ORDERS)} o ON c_custkey = o.o_custkey GROUP BY c_custkey"""


def _join_sql() -> str:
    sql = JOIN_SQL
    for alias, name in JOIN_ALIASES.items():
        sql = sql.replace(f" {alias} ", f" {name} ")
    return sql


_ERROR_UID = "'ct_price__satisfiesexpression__o_orderkey_o_totalprice'"
_PRICE_NUMBER = "regexp_replace(txt, '[$€,\\s()%]', '', 'g')"

ORACLES = {
    "computed_table": SEGMENT_QUERY,
    "computed_file": """
        SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty,
               round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
        FROM lineitem WHERE l_shipdate > TIMESTAMP '1996-06-30' AND l_discount BETWEEN 0.02 AND 0.08
        GROUP BY l_returnflag, l_linestatus""",
    "lateral_view": """
        SELECT lang, source, count(*) AS words, count(DISTINCT word) AS distinct_words,
               CAST(max(length(word)) AS INTEGER) AS longest
        FROM (SELECT lang, source, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY lang, source""",
    "computed_join_inner": """
        SELECT c_mktsegment AS segment, o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS price
        FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 0 GROUP BY 1, 2""",
    "computed_join_left": _joined_sql("LEFT"),
    "computed_join_right": _joined_sql("RIGHT"),
    "computed_join_full": _joined_sql("FULL"),
    "computed_join_sql": _join_sql(),
    "auto_alias": """
        SELECT lower(l_returnflag) AS expr_1, l_linestatus, count(*) AS expr_2, max(l_quantity) AS qty,
               min(l_partkey) + 1 AS expr_3 FROM lineitem GROUP BY 1, 2""",
    "validate_container": f"""
        SELECT id, container_type, reason IS NULL AS valid, reason FROM (SELECT *, CASE
            WHEN container_type = 'view' THEN 'not a computed type'
            WHEN container_type = 'computed_table' AND query IS NULL THEN 'query is required for computed_table'
            WHEN container_type = 'computed_file' AND source_name IS NULL THEN 'source_name is required for computed_file'
            WHEN container_type = 'computed_file' AND select_clause IS NULL THEN 'select_clause is required for computed_file'
            WHEN container_type = 'computed_join' AND left_name IS NULL THEN 'left_name is required for computed_join'
            WHEN container_type = 'computed_join' AND left_key_field IS NULL THEN 'left_key_field is required for computed_join'
            WHEN container_type = 'computed_join' AND select_clause IS NULL THEN 'select_clause is required for computed_join'
            WHEN container_type = 'computed_join' AND join_type = 'cross' THEN 'unknown join type cross'
            END AS reason FROM {duck(CONTAINER_DEFS)} d)""",
    "field_drop_guard": f"""
        WITH gone AS (SELECT * FROM {duck(OLD_FIELDS)} o EXCEPT SELECT * FROM {duck(NEW_FIELDS)} n),
        c AS (SELECT container, fields AS field, count(*) AS checks FROM {duck(FIELD_CHECKS)} c GROUP BY 1, 2),
        a AS (SELECT container, field, count(*) AS anomalies FROM {duck(FIELD_ANOMALIES)} a GROUP BY 1, 2)
        SELECT container, field, coalesce(checks, 0) AS checks, coalesce(anomalies, 0) AS anomalies, 'conflict' AS verdict
        FROM gone LEFT JOIN c USING (container, field) LEFT JOIN a USING (container, field)
        WHERE checks IS NOT NULL OR anomalies IS NOT NULL""",
    "load_definitions": f"SELECT name, description, query FROM {duck(DEFINITION_FILE)} d WHERE trim(name) <> ''",
    "validate_definitions": f"""
        WITH d AS (SELECT * FROM {duck(DEFINITIONS)}),
        f AS (SELECT name, min(row) AS first_row FROM d WHERE query <> '' AND name <> '' GROUP BY name)
        SELECT row, name, reason IS NULL AS valid, reason FROM (SELECT d.row, d.name, CASE
            WHEN d.name = '' THEN 'empty name' WHEN query = '' THEN 'empty query'
            WHEN d.row > first_row THEN 'duplicate of row ' || first_row END AS reason
            FROM d LEFT JOIN f ON d.name = f.name)""",
    "plan_definitions": f"""
        SELECT 'ct_' || d.name AS table_name, CASE WHEN k.name IS NULL THEN 'create' ELSE 'skip' END AS table_action,
               CASE WHEN k.name IS NOT NULL AND c.name IS NOT NULL THEN 'skip' ELSE 'create' END AS check_action
        FROM {duck(PLAN_DEFS)} d LEFT JOIN {duck(PLAN_KNOWN)} k ON 'ct_' || d.name = k.name
        LEFT JOIN {duck(PLAN_CHECKED)} c ON 'ct_' || d.name = c.name""",
    "error_query_check": f"""
        SELECT {_ERROR_UID} AS check_uid, 'satisfiesExpression' AS rule_type, CAST(o_orderkey AS VARCHAR) AS record_key,
               'Price or date out of bounds' AS message,
               {sql_fingerprint(_ERROR_UID, 'CAST(o_orderkey AS VARCHAR)')} AS fingerprint
        FROM ({ERROR_QUERY})""",
    "rule_id": f"""
        SELECT p_partkey, name, regexp_replace(name, '_(SF|sf|DB|db|BQ|bq|PG|pg|SNOW|snow|SNOWFLAKE|snowflake)$', '') AS rule_id
        FROM {duck(RULE_NAMES)}""",
    "parse_tags": "SELECT p_partkey, p_brand || '|' || p_type || '|' || p_name AS tags, 3 AS n_tags FROM part",
    "cast_field": f"""
        SELECT o_orderkey, CAST(TRY_CAST(txt AS BIGINT) AS VARCHAR) AS as_bigint, TRY_CAST(price AS DOUBLE) AS as_double
        FROM {duck(TEXT_PRICES)}""",
    "cast_field_format": f"""
        SELECT o_orderkey, strftime(try_strptime(txt, '%d/%m/%Y'), '%Y-%m-%d') AS as_date,
               strftime(try_strptime(txt, '%d/%m/%Y'), '%Y-%m-%d %H:%M:%S') AS as_time FROM {duck(DATE_TEXTS)}""",
    "cleaned_entity_name": """
        SELECT o_orderkey, 'Customer ' || CAST(o_custkey AS VARCHAR) AS cleaned FROM orders""",
    "convert_formatted_numeric": f"""
        SELECT o_orderkey, round(CASE WHEN txt LIKE '(%' THEN -n WHEN txt LIKE '%\\%' ESCAPE '\\' THEN n / 100 ELSE n END, 6) AS value
        FROM (SELECT *, TRY_CAST({_PRICE_NUMBER} AS DOUBLE) AS n FROM {duck(NUMBER_TEXTS)})""",
    "custom_expression": """
        SELECT o_orderkey, o_orderstatus || '-' || CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS band
        FROM orders""",
    "concatenate": """
        SELECT c_custkey, concat_ws(' / ', c_name, nullif(c_mktsegment, 'BUILDING'), CAST(c_nationkey AS VARCHAR)) AS joined
        FROM customer""",
    "entity_name_lookup": f"""
        SELECT who, CAST(s_suppkey AS VARCHAR) AS supplier_id, count(*) AS n FROM {duck(LOOKUP_NAMES)} l
        LEFT JOIN supplier ON regexp_replace(regexp_replace(lower(who), '[^a-z0-9 ]', '', 'g'), ' +', '', 'g')
             = regexp_replace(lower(s_name), '[^a-z0-9]', '', 'g') GROUP BY 1, 2""",
    "apply_computed_fields": """
        SELECT o_orderkey, lower(o_orderstatus) AS o_orderstatus, o_orderpriority || ':' || o_orderstatus AS label,
               CAST(trunc(o_totalprice) AS BIGINT) AS price_int,
               CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' END AS who FROM orders""",
}
