"""Queries R: the registry of checks, templates and containers as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.text import check_uid, slugify
from veriframe.operators import lineage
from veriframe.operators import registry as reg
from veriframe.plans.common import ANOMALIES, CHECKS, CONTAINERS, duck, frame, table
from veriframe.plans.profiles import map_text


def q_slugify(spark: SparkSession, sf: str) -> DataFrame:
    urls = table(spark, sf, "pages").select(F.concat(F.lit("p"), F.col("page_id")).alias("id"), slugify(F.col("url")).alias("slug"))
    texts = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("id"), F.sha2(slugify(F.col("text")), 256).alias("slug")
    )
    return urls.unionAll(texts)


def q_check_uid(spark: SparkSession, sf: str) -> DataFrame:
    checks = frame(spark, sf, CHECKS, "fields")
    return checks.select("id", check_uid(F.col("container"), F.col("rule_type"), F.col("fields")).alias("check_uid"))


def q_portable_names(spark: SparkSession, sf: str) -> DataFrame:
    return reg.portable_names(frame(spark, sf, CHECKS, "fields"), "id").select("id", "folder", "name")


STORED = """
SELECT id, container, rule_type, fields, description, coverage, status, tags,
       CASE WHEN rule_type IN ('existsIn', 'dataDiff', 'volumetric') THEN CAST(p_size * 37 AS STRING) END AS ref_c,
       CASE WHEN rule_type IN ('existsIn', 'volumetric') THEN CAST(p_size AS STRING) END AS ref_d,
       CASE WHEN p_size > 40 THEN 'kept_' || CAST(id AS STRING) END AS own_uid,
       CASE WHEN p_size < 10 THEN CAST(id AS STRING) END AS origin
FROM (SELECT c.*, p.p_size FROM (""" + CHECKS + """) c JOIN {part} p ON c.id = p.p_partkey) x
"""


def _entries(*pairs: tuple[str, str]) -> Column:
    """A map of the columns that are not null."""
    entries = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("v")) for k, c in pairs])
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull())).cast("map<string,string>")


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    return (
        frame(spark, sf, STORED, "fields", "tags")
        .withColumn("properties", _entries(("ref_container_id", "ref_c"), ("ref_datastore_id", "ref_d"), ("note", "rule_type")))
        .withColumn(
            "additional_metadata",
            _entries(("_check_uid", "own_uid"), ("from quality check id", "origin"), ("owner", "origin")),
        )
        .withColumn("filter", F.lit(None).cast("string"))
        .withColumn("anomaly_message_field", F.lit(None).cast("string"))
        .drop("ref_c", "ref_d", "own_uid", "origin")
    )


STORES = "SELECT n_nationkey AS id, 'store_' || CAST(n_nationkey AS STRING) AS name FROM {nation}"


def q_portable_check(spark: SparkSession, sf: str) -> DataFrame:
    out = reg.portable_check(
        _stored(spark, sf), frame(spark, sf, CONTAINERS), frame(spark, sf, STORES)
    )
    return out.select(
        "id", "rule_type", "description", "container", "status",
        F.array_join("fields", ",").alias("fields"),
        map_text(F.col("properties")).alias("properties"),
        map_text(F.col("additional_metadata")).alias("additional_metadata"),
    )


NAMED = """
SELECT o_orderkey AS id, o_custkey AS datastore_id,
       CASE o_orderstatus WHEN 'F' THEN 'store_' || CAST(o_custkey AS STRING) END AS store_name,
       CASE WHEN o_orderpriority <> '5-LOW' THEN 'customer_' || CAST(o_custkey AS STRING) END AS container_name,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'given' END AS given
FROM (SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority,
             CASE WHEN o.o_orderstatus = 'F' THEN o.o_custkey ELSE c.c_nationkey END AS o_custkey
      FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) x
"""


def q_resolve_refs(spark: SparkSession, sf: str) -> DataFrame:
    checks = frame(spark, sf, NAMED).withColumn(
        "properties",
        _entries(
            ("ref_datastore_name", "store_name"), ("ref_container_name", "container_name"),
            ("ref_container_id", "given"),
        ),
    )
    out = reg.resolve_refs(
        checks.select("id", "datastore_id", "properties"), frame(spark, sf, CONTAINERS), frame(spark, sf, STORES)
    )
    return out.select("id", map_text(F.col("properties")).alias("properties"), "error")


INCOMING = """
SELECT o_orderkey AS pos, 'customer_' || CAST(o_custkey AS STRING) AS container,
       CASE WHEN o_orderpriority <> '5-LOW' THEN 'uid_' || CAST(o_custkey AS STRING) || lower(substr(o_orderpriority, 2)) END AS uid
FROM {orders}
"""
KNOWN_UIDS = """
SELECT 'store_' || CAST(c_nationkey AS STRING) AS datastore, 'uid_' || CAST(c_custkey AS STRING) || '-urgent' AS uid,
       c_custkey AS check_id FROM {customer} WHERE c_acctbal > 5000
"""
TARGETS = ["store_3", "store_7", "store_11", "store_99"]


def _plan(spark: SparkSession, sf: str, dry_run: bool) -> DataFrame:
    return reg.upsert_plan(
        frame(spark, sf, INCOMING), TARGETS, frame(spark, sf, CONTAINERS),
        frame(spark, sf, KNOWN_UIDS), "pos", dry_run,
    ).select("target", "pos", "action", F.lit(dry_run).alias("dry_run"))


def q_upsert_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf, False).unionAll(_plan(spark, sf, True))


CHANGES = """
SELECT o_custkey AS id, max(o_orderpriority) AS description, max(CASE WHEN o_totalprice > 450000 THEN 'Draft' END) AS status,
       CASE WHEN sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) > 3 THEN 'description,status' ELSE 'description' END AS present
FROM {orders} GROUP BY o_custkey
"""
STORED_ROWS = """
SELECT c_custkey AS id, 'desc ' || c_name AS description, 'Active' AS status, c_mktsegment AS filter FROM {customer}
"""


def q_merge_update(spark: SparkSession, sf: str) -> DataFrame:
    return reg.merge_update(
        frame(spark, sf, STORED_ROWS), frame(spark, sf, CHANGES, "present"), "id", ["description", "status"]
    )


STORED_CONTAINERS = """
SELECT c_custkey AS id, CASE c_mktsegment WHEN 'MACHINERY' THEN 'table' WHEN 'BUILDING' THEN 'file'
            WHEN 'AUTOMOBILE' THEN 'computed_table' WHEN 'FURNITURE' THEN 'computed_file' ELSE 'computed_join' END AS container_type,
       c_name AS name, CASE WHEN c_acctbal > 3000 THEN 'SELECT 1' END AS query, 'ts' AS incremental_field_name, '|' AS escape_character,
       'a > 0' AS where_clause, 'a' AS group_by_clause, 'old' AS description
FROM {customer}
"""
CONTAINER_CHANGES = """
SELECT o_custkey AS id, CASE WHEN max(o_totalprice) > 400000 THEN 'new' END AS description,
       CASE WHEN min(o_totalprice) < 20000 THEN 'b > 1' END AS where_clause FROM {orders} GROUP BY o_custkey
"""


def q_merge_container_update(spark: SparkSession, sf: str) -> DataFrame:
    return reg.merge_container_update(
        frame(spark, sf, STORED_CONTAINERS), frame(spark, sf, CONTAINER_CHANGES), "id"
    )


# Each order reads its customer, each customer its nation, each nation its region.
LINEAGE = """
SELECT 'order_' || CAST(o_orderkey AS STRING) AS name, 'customer_' || CAST(o_custkey AS STRING) AS source_name,
       CAST(NULL AS STRING) AS left_name, CAST(NULL AS STRING) AS right_name FROM {orders}
UNION ALL SELECT 'customer_' || CAST(c_custkey AS STRING), CAST(NULL AS STRING),
       'nation_' || CAST(c_nationkey AS STRING), 'segment_' || c_mktsegment FROM {customer}
UNION ALL SELECT 'nation_' || CAST(n_nationkey AS STRING), 'region_' || CAST(n_regionkey AS STRING),
       CAST(NULL AS STRING), CAST(NULL AS STRING) FROM {nation}
"""


def q_container_lineage(spark: SparkSession, sf: str) -> DataFrame:
    edges = lineage.lineage_edges(frame(spark, sf, LINEAGE))
    return lineage.lineage_closure(edges)


OLD_REGISTRY = "SELECT l_partkey AS k, max(l_discount) AS coverage, min(l_returnflag) AS status FROM {lineitem} WHERE l_tax < 0.07 GROUP BY l_partkey"
NEW_REGISTRY = "SELECT l_partkey AS k, max(l_discount) AS coverage, min(l_returnflag) AS status FROM {lineitem} WHERE l_quantity > 8 GROUP BY l_partkey"


def q_registry_diff(spark: SparkSession, sf: str) -> DataFrame:
    return reg.registry_diff(frame(spark, sf, OLD_REGISTRY), frame(spark, sf, NEW_REGISTRY), ["k"])


# Checks of the anomalies' registry: one per customer, as each owns anomalies.
OWNED_CHECKS = """
SELECT 'check_' || CAST(c_custkey AS STRING) AS check_uid, 'customer_' || CAST(c_custkey AS STRING) AS container,
       CASE WHEN c_acctbal < 0 THEN 'Discarded' ELSE 'Active' END AS status, c_acctbal < 0 AS archived FROM {customer}
"""
OWNED_ANOMALIES = """
SELECT o_orderkey AS id, 'check_' || CAST(o_custkey AS STRING) AS check_uid,
       'customer_' || CAST(o_custkey AS STRING) AS container FROM {orders}
"""
RETIRED = "SELECT DISTINCT 'check_' || CAST(o_custkey AS STRING) AS check_uid FROM {orders} WHERE o_totalprice > 490000"


def q_check_archive(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for archive in (True, False):
        checks, anomalies = reg.check_archive(
            frame(spark, sf, OWNED_CHECKS), frame(spark, sf, OWNED_ANOMALIES), frame(spark, sf, RETIRED), archive
        )
        mode = F.lit("archive" if archive else "delete").alias("mode")
        parts.append(checks.select(mode, F.lit("check").alias("kind"), F.col("check_uid").alias("key"), "status"))
        parts.append(
            anomalies.select(mode, F.lit("anomaly").alias("kind"), F.col("id").cast("string").alias("key"), F.lit("").alias("status"))
        )
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


def q_check_activate(spark: SparkSession, sf: str) -> DataFrame:
    return reg.check_activate(frame(spark, sf, OWNED_CHECKS), frame(spark, sf, RETIRED))


DELETED = "SELECT 'customer_' || CAST(c_custkey AS STRING) AS name FROM {customer} WHERE c_mktsegment = 'BUILDING'"


def q_container_delete_cascade(spark: SparkSession, sf: str) -> DataFrame:
    left = reg.container_delete_cascade(
        frame(spark, sf, CONTAINERS).select("name"),
        frame(spark, sf, OWNED_ANOMALIES).select("container", F.col("id").alias("field")),
        frame(spark, sf, OWNED_CHECKS), frame(spark, sf, OWNED_ANOMALIES), frame(spark, sf, DELETED),
    )
    counts = [
        df.groupBy(F.col("name" if n == "containers" else "container").alias("container"))
        .agg(F.count(F.lit(1)).alias("rows_left")).withColumn("asset", F.lit(n))
        for n, df in left.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


TEMPLATES = """
SELECT id, rule_type, fields, tags, description, status = 'Draft' AS locked FROM
(""" + CHECKS + ") t"


def q_template_select(spark: SparkSession, sf: str) -> DataFrame:
    templates = frame(spark, sf, TEMPLATES, "fields", "tags")
    chosen = reg.template_select(templates, locked=True, rule_types=["between", "notNull"], tags=["brand#3", "economy"])
    return chosen.select("id", "rule_type", "locked")


TEMPLATE_TARGETS = """
SELECT l_partkey AS template_id, 'supplier_' || CAST(l_suppkey AS STRING) AS container,
       CASE WHEN l_returnflag = 'R' THEN 'l_tax' END AS fields FROM {lineitem} WHERE l_linestatus = 'O'
"""


def q_template_expand(spark: SparkSession, sf: str) -> DataFrame:
    made = reg.template_expand(
        frame(spark, sf, TEMPLATES, "fields", "tags"), frame(spark, sf, TEMPLATE_TARGETS, "fields")
    )
    return made.groupBy("check_uid").agg(F.count(F.lit(1)).alias("targets"))


def q_container_list(spark: SparkSession, sf: str) -> DataFrame:
    containers = frame(spark, sf, CONTAINERS, "tags")
    listings = {
        "open": reg.container_list(containers, ["table", "view"], tags=["n3", "n5", "building"], search="ER_1"),
        "archived": reg.container_list(containers, archived="only", kinds=["file"]),
        "all": reg.container_list(containers, archived="include", search="customer_99"),
    }
    parts = [df.select("id", "name", F.lit(n).alias("listing")) for n, df in listings.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


QUERIES = {
    "slugify": q_slugify,
    "check_uid": q_check_uid,
    "portable_names": q_portable_names,
    "portable_check": q_portable_check,
    "resolve_refs": q_resolve_refs,
    "upsert_plan": q_upsert_plan,
    "merge_update": q_merge_update,
    "merge_container_update": q_merge_container_update,
    "container_lineage": q_container_lineage,
    "registry_diff": q_registry_diff,
    "check_archive": q_check_archive,
    "check_activate": q_check_activate,
    "container_delete_cascade": q_container_delete_cascade,
    "template_select": q_template_select,
    "template_expand": q_template_expand,
    "container_list": q_container_list,
}

_C = duck(CHECKS)


def _slug(col: str) -> str:
    return f"trim(regexp_replace(lower({col}), '[^a-z0-9]+', '_', 'g'), '_')"


def _uid_of(container: str, rule: str, fields: str) -> str:
    """``fields`` is a comma list."""
    joined = f"array_to_string(list_sort(string_split({fields}, ',')), '_')"
    return f"{_slug(container)} || '__' || {_slug(rule)} || CASE WHEN {fields} = '' THEN '' ELSE '__' || {_slug(joined)} END"


_CROSS = "rule_type IN ('existsIn', 'notExistsIn', 'isReplicaOf', 'dataDiff')"
_DONE = f"(SELECT check_uid FROM {duck(RETIRED)} r)"


def _archived(mode: str) -> str:
    checks = (
        f"SELECT check_uid AS key, CASE WHEN check_uid IN {_DONE} THEN 'Discarded' ELSE status END AS status FROM {duck(OWNED_CHECKS)} c"
        if mode == "archive"
        else f"SELECT check_uid AS key, status FROM {duck(OWNED_CHECKS)} c WHERE check_uid NOT IN {_DONE}"
    )
    return f"""SELECT '{mode}' AS mode, 'check' AS kind, key, status FROM ({checks})
        UNION ALL SELECT '{mode}', 'anomaly', CAST(id AS VARCHAR), '' FROM {duck(OWNED_ANOMALIES)} a WHERE check_uid NOT IN {_DONE}"""


def _upsert(dry_run: bool) -> str:
    repeat = "" if dry_run else "WHEN pos > min(CASE WHEN ok THEN pos END) OVER (PARTITION BY target, uid) AND uid IS NOT NULL THEN 'updated'"
    targets = ", ".join(f"'{t}'" for t in TARGETS)
    return f"""SELECT target, pos, CASE WHEN NOT ok THEN 'failed' WHEN known THEN 'updated' {repeat} ELSE 'created' END AS action,
            {str(dry_run).lower()} AS dry_run
        FROM (SELECT i.*, t.target, k.name IS NOT NULL AS ok, u.uid IS NOT NULL AS known
              FROM {duck(INCOMING)} i CROSS JOIN (SELECT unnest([{targets}]) AS target) t
              LEFT JOIN {duck(CONTAINERS)} k ON k.datastore = t.target AND k.name = i.container
              LEFT JOIN {duck(KNOWN_UIDS)} u ON u.datastore = t.target AND u.uid = i.uid)"""


_DEL = f"(SELECT name FROM {duck(DELETED)} d)"

ORACLES = {
    "slugify": f"""
        SELECT 'p' || page_id AS id, {_slug('url')} AS slug FROM pages
        UNION ALL SELECT 'd' || doc_id, sha256({_slug('text')}) FROM documents""",
    "check_uid": f"SELECT id, {_uid_of('container', 'rule_type', 'fields')} AS check_uid FROM {_C} c",
    "portable_names": f"""
        WITH s AS (SELECT id, {_slug('container')} AS folder, {_uid_of("''", 'rule_type', 'fields')} AS u FROM {_C} c),
        n AS (SELECT id, folder, substr(u, 3) AS stem FROM s)
        SELECT id, folder, CASE WHEN rn > 1 THEN stem || '_' || rn ELSE stem END AS name
        FROM (SELECT *, row_number() OVER (PARTITION BY folder, stem ORDER BY id) AS rn FROM n)""",
    "portable_check": f"""
        SELECT s.id, rule_type, coalesce(nullif(description, ''), rule_type || ' quality check') AS description,
               container, s.status, fields,
               concat_ws(';', 'note=' || rule_type,
                   CASE WHEN ref_c IS NOT NULL AND (NOT ({_CROSS}) OR k.name IS NULL) THEN 'ref_container_id=' || ref_c END,
                   CASE WHEN {_CROSS} THEN 'ref_container_name=' || k.name END,
                   CASE WHEN ref_d IS NOT NULL AND (NOT ({_CROSS}) OR d.name IS NULL) THEN 'ref_datastore_id=' || ref_d END,
                   CASE WHEN {_CROSS} THEN 'ref_datastore_name=' || d.name END) AS properties,
               concat_ws(';', '_check_uid=' || coalesce(own_uid, {_uid_of('container', 'rule_type', 'fields')}),
                   'owner=' || origin) AS additional_metadata
        FROM {duck(STORED)} s LEFT JOIN {duck(CONTAINERS)} k ON CAST(k.id AS VARCHAR) = ref_c
        LEFT JOIN {duck(STORES)} d ON CAST(d.id AS VARCHAR) = ref_d""",
    "resolve_refs": f"""
        WITH n AS (SELECT n.*, d.id AS did, coalesce(d.id, CASE WHEN store_name IS NULL THEN n.datastore_id END, n.datastore_id) AS store
                   FROM {duck(NAMED)} n LEFT JOIN {duck(STORES)} d ON n.store_name = d.name)
        SELECT n.id, concat_ws(';', 'ref_container_id=' || coalesce(given, CAST(k.id AS VARCHAR)), 'ref_datastore_id=' || n.did) AS properties,
               CASE WHEN store_name IS NOT NULL AND n.did IS NULL THEN 'referenced datastore not found: ' || store_name
                    WHEN container_name IS NOT NULL AND given IS NULL AND k.id IS NULL THEN 'referenced container not found: ' || container_name END AS error
        FROM n LEFT JOIN {duck(CONTAINERS)} k ON k.datastore_id = n.store AND k.name = n.container_name""",
    "upsert_plan": f"{_upsert(False)} UNION ALL {_upsert(True)}",
    "merge_update": f"""
        SELECT s.id, CASE WHEN c.id IS NULL THEN s.description ELSE c.description END AS description,
               CASE WHEN c.present = 'description,status' THEN c.status ELSE s.status END AS status, filter
        FROM {duck(STORED_ROWS)} s LEFT JOIN {duck(CHANGES)} c ON s.id = c.id""",
    "merge_container_update": f"""
        SELECT s.id, container_type, CASE WHEN container_type LIKE 'computed%' THEN name END AS name,
               CASE WHEN container_type = 'computed_table' THEN query END AS query,
               CASE WHEN container_type IN ('table', 'computed_table') THEN incremental_field_name END AS incremental_field_name,
               CASE WHEN container_type = 'file' THEN escape_character END AS escape_character,
               coalesce(c.where_clause, CASE WHEN container_type = 'computed_file' OR (container_type = 'computed_join' AND query IS NULL)
                   THEN s.where_clause END) AS where_clause,
               CASE WHEN container_type = 'computed_file' OR (container_type = 'computed_join' AND query IS NULL)
                   THEN group_by_clause END AS group_by_clause,
               c.description FROM {duck(STORED_CONTAINERS)} s JOIN {duck(CONTAINER_CHANGES)} c ON s.id = c.id""",
    "container_lineage": f"""
        WITH RECURSIVE e AS (SELECT DISTINCT name AS child, p AS parent FROM (
            SELECT name, unnest([source_name, left_name, right_name]) AS p FROM {duck(LINEAGE)}) WHERE p IS NOT NULL),
        r AS (SELECT child, parent AS ancestor, 1 AS depth FROM e
              UNION SELECT r.child, e.parent, depth + 1 FROM r JOIN e ON r.ancestor = e.child)
        SELECT child, ancestor, min(depth) AS depth FROM r GROUP BY 1, 2""",
    "registry_diff": f"""
        SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NULL THEN 'removed'
               WHEN o.coverage IS NOT DISTINCT FROM n.coverage AND o.status IS NOT DISTINCT FROM n.status THEN 'unchanged'
               ELSE 'changed' END AS change
        FROM {duck(OLD_REGISTRY)} o FULL JOIN {duck(NEW_REGISTRY)} n ON o.k = n.k""",
    "check_archive": f"{_archived('archive')} UNION ALL {_archived('delete')}",
    "check_activate": f"""
        SELECT check_uid, container, CASE WHEN archived AND check_uid IN {_DONE} THEN 'Active' ELSE status END AS status,
               archived AND check_uid NOT IN {_DONE} AS archived FROM {duck(OWNED_CHECKS)} c""",
    "container_delete_cascade": f"""
        SELECT name AS container, count(*) AS rows_left, 'containers' AS asset FROM {duck(CONTAINERS)} c WHERE name NOT IN {_DEL} GROUP BY 1
        UNION ALL SELECT container, count(*), 'fields' FROM {duck(OWNED_ANOMALIES)} a WHERE container NOT IN {_DEL} GROUP BY 1
        UNION ALL SELECT container, count(*), 'checks' FROM {duck(OWNED_CHECKS)} a WHERE container NOT IN {_DEL} GROUP BY 1
        UNION ALL SELECT container, count(*), 'anomalies' FROM {duck(OWNED_ANOMALIES)} a WHERE container NOT IN {_DEL} GROUP BY 1""",
    "template_select": f"""
        SELECT id, rule_type, locked FROM {duck(TEMPLATES)} t WHERE locked AND rule_type IN ('between', 'notNull')
            AND list_has_any(string_split(tags, ','), ['brand#3', 'economy'])""",
    "template_expand": f"""
        SELECT {_uid_of('x.container', 'rule_type', 'coalesce(x.fields, t.fields)')} AS check_uid, count(*) AS targets
        FROM {duck(TEMPLATE_TARGETS)} x JOIN {duck(TEMPLATES)} t ON x.template_id = t.id GROUP BY 1""",
    "container_list": f"""
        WITH c AS (SELECT *, string_split(tags, ',') AS t FROM {duck(CONTAINERS)})
        SELECT id, name, 'open' AS listing FROM c WHERE NOT archived AND container_type IN ('table', 'view')
            AND list_has_any(t, ['n3', 'n5', 'building']) AND contains(name, 'er_1')
        UNION ALL SELECT id, name, 'archived' FROM c WHERE archived AND container_type = 'file'
        UNION ALL SELECT id, name, 'all' FROM c WHERE contains(name, 'customer_99')""",
}
