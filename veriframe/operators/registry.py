"""The registry: checks, templates and containers as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.keys import in_order
from veriframe.functions.skew import group_index, lookup, rows_outside
from veriframe.functions.text import check_uid, rule_and_fields, slugify
from veriframe.operators.rules import CROSS_REFERENCE_RULES
from veriframe.session import durable

UID_KEY = "_check_uid"

# Metadata keys that only track where a check was copied from.
TRACKING_KEYS = ("from quality check id", "main datastore id")

# The portable columns of a check, in their order.
PORTABLE_COLUMNS = (
    "rule_type",
    "description",
    "container",
    "fields",
    "coverage",
    "filter",
    "anomaly_message_field",
    "properties",
    "tags",
    "status",
    "additional_metadata",
)

CHECK_COLUMNS = (
    "container string, rule_type string, description string, fields array<string>, "
    "coverage double, filter string, properties map<string,string>, tags array<string>, "
    "status string, anomaly_message_field string, additional_metadata map<string,string>, "
    "archived boolean"
)


@dataclass(frozen=True)
class Check:
    """One quality check as a user writes it."""

    container: str
    rule_type: str
    fields: Sequence[str] = ()
    properties: Mapping[str, object] = field(default_factory=dict)
    coverage: float | None = None
    filter: str | None = None
    tags: Sequence[str] = ()
    status: str = "Active"
    description: str | None = None
    anomaly_message_field: str | None = None
    additional_metadata: Mapping[str, str] = field(default_factory=dict)
    archived: bool = False


def with_check_uid(checks: DataFrame, uid_key: str = UID_KEY) -> DataFrame:
    """Adds ``check_uid``: the one kept in the metadata, else the generated one."""
    made = check_uid(F.col("container"), F.col("rule_type"), F.col("fields"))
    kept = F.try_element_at(F.col("additional_metadata"), F.lit(uid_key))
    return checks.withColumn("check_uid", F.coalesce(kept, made))


def checks_frame(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """A checks DataFrame from definitions written in code."""
    rows = []
    for check in checks:
        values = asdict(check)
        values["fields"], values["tags"] = list(check.fields), list(check.tags)
        values["properties"] = {k: None if v is None else str(v) for k, v in check.properties.items()}
        rows.append(values)
    return with_check_uid(spark.createDataFrame(rows, CHECK_COLUMNS))


def active_checks(checks: DataFrame) -> DataFrame:
    """Checks that run: Active (the default) and not archived."""
    status = F.coalesce("status", F.lit("Active"))
    return checks.filter((status == "Active") & ~F.coalesce("archived", F.lit(False)))


def check_select(
    checks: DataFrame,
    containers: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
    status: str | None = None,
) -> DataFrame:
    """Checks by container, tags and status.

    A status is capitalised first; ``archived`` shows archived checks only.
    """
    is_archived = F.coalesce("archived", F.lit(False))
    wanted = status.capitalize() if status else None
    if wanted == "Archived":
        checks = checks.filter(is_archived)
    else:
        checks = checks.filter(~is_archived)
        if wanted:
            checks = checks.filter(F.col("status") == wanted)
    if containers:
        checks = checks.filter(F.col("container").isin(list(containers)))
    if tags:
        checks = checks.filter(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])))
    return checks


def _taken_numbers(named: DataFrame) -> DataFrame:
    """Per stem, which numbers are some other check's own name (``x`` and ``x_2``).

    Own names come from field names, so a stem has at most as many as its
    container has columns. ``_skips`` holds, for each such number, the repeat
    from which on numbers move up by one more.
    """
    stems = named.select("folder", "_stem").distinct()
    parts = stems.select(
        "folder",
        F.regexp_extract("_stem", "^(.*)_([1-9][0-9]{0,8})$", 1).alias("_stem"),
        F.regexp_extract("_stem", "^(.*)_([1-9][0-9]{0,8})$", 2).try_cast("int").alias("_number"),
    )
    taken = parts.filter("_number >= 2").join(stems, ["folder", "_stem"], "left_semi")
    numbers = taken.groupBy("folder", "_stem").agg(F.sort_array(F.collect_set("_number")).alias("_taken"))
    return numbers.select("folder", "_stem", F.transform("_taken", lambda b, i: b - i).alias("_skips"))


def portable_names(checks: DataFrame, order: str) -> DataFrame:
    """``folder, name`` per check: ``rule__fields``, repeats get ``_2``, ``_3``, ...

    ``order`` is a unique column giving the order in which names are taken. A
    number that would give another check's own name is left out.
    """
    folder = F.when(F.coalesce("container", F.lit("")) == "", "_no_container").otherwise(
        slugify(F.col("container"))
    )
    stem = rule_and_fields(
        F.when(F.coalesce("rule_type", F.lit("")) == "", "unknown").otherwise(F.col("rule_type")),
        F.col("fields"),
    )
    named = checks.withColumn("folder", folder).withColumn("_stem", stem)
    numbered = group_index(named, ["folder", "_stem"], [order], "_nth")
    numbered = lookup(numbered, ["folder", "_stem"], _taken_numbers(named), ["folder", "_stem"])
    skipped = F.size(F.filter(F.coalesce("_skips", F.array()), lambda s: s <= F.col("_nth")))
    number = (F.col("_nth") + skipped).cast("string")
    return numbered.withColumn(
        "name",
        F.when(F.col("_nth") > 1, F.concat_ws("_", "_stem", number)).otherwise(F.col("_stem")),
    ).drop("_stem", "_nth", "_skips")


def _without(properties: Column, keys: Sequence[str]) -> Column:
    return F.map_filter(properties, lambda k, v: ~k.isin(list(keys)))


def _entry(key: str, value: Column) -> Column:
    """A map of one entry, or an empty one when the value is null."""
    empty = F.create_map().cast("map<string,string>")
    return F.when(value.isNotNull(), F.create_map(F.lit(key), value)).otherwise(empty)


def portable_check(
    checks: DataFrame, containers: DataFrame, datastores: DataFrame, uid_key: str = UID_KEY
) -> DataFrame:
    """Portable form of stored checks: fixed columns, names instead of ids.

    Reference ids of cross-reference rules become names where known and stay
    otherwise. A uid already in the metadata overrides the generated one.
    """
    empty = F.create_map().cast("map<string,string>")
    props = F.coalesce(F.col("properties"), empty)
    crossing = F.col("rule_type").isin(list(CROSS_REFERENCE_RULES))
    refs = checks.withColumns(
        {
            "_ref_c": F.when(crossing, F.try_element_at(props, F.lit("ref_container_id"))),
            "_ref_d": F.when(crossing, F.try_element_at(props, F.lit("ref_datastore_id"))),
        }
    )
    c = containers.select(
        F.col("id").cast("string").alias("_cid"), F.nullif(F.col("name"), F.lit("")).alias("_cname")
    )
    d = datastores.select(
        F.col("id").cast("string").alias("_did"), F.nullif(F.col("name"), F.lit("")).alias("_dname")
    )
    refs = lookup(refs, ["_ref_c"], c, ["_cid"])
    refs = lookup(refs, ["_ref_d"], d, ["_did"])
    resolved = F.map_concat(
        _without(props, ("ref_container_id", "ref_datastore_id")),
        _entry("ref_container_name", F.col("_cname")),
        _entry("ref_container_id", F.when(F.col("_cname").isNull(), F.col("_ref_c"))),
        _entry("ref_datastore_name", F.col("_dname")),
        _entry("ref_datastore_id", F.when(F.col("_dname").isNull(), F.col("_ref_d"))),
    )
    meta = _without(F.coalesce(F.col("additional_metadata"), empty), TRACKING_KEYS)
    made = check_uid(F.col("container"), F.col("rule_type"), F.coalesce("fields", F.array()))
    own_uid = F.map_contains_key(meta, uid_key)
    rule_name = F.coalesce("rule_type", F.lit("Quality"))
    described = F.nullif(F.col("description"), F.lit(""))
    portable = {
        "description": F.coalesce(described, F.concat(rule_name, F.lit(" quality check"))),
        "container": F.coalesce("container", F.lit("")),
        "fields": F.coalesce("fields", F.array().cast("array<string>")),
        "properties": F.when(crossing, resolved).otherwise(props),
        "tags": F.coalesce("tags", F.array().cast("array<string>")),
        "status": F.coalesce("status", F.lit("Active")),
        "additional_metadata": F.map_concat(_entry(uid_key, F.when(~own_uid, made)), meta),
    }
    extra = [x for x in ("id", "check_id") if x in checks.columns]
    return refs.select(
        *extra, *[portable.get(name, F.col(name)).alias(name) for name in PORTABLE_COLUMNS]
    )


def resolve_refs(
    checks: DataFrame, containers: DataFrame, datastores: DataFrame, own_datastore: str = "datastore_id"
) -> DataFrame:
    """Names back to ids for a target datastore; ``error`` says what is missing.

    A missing datastore name means the check's own datastore. An id already
    given wins over a name; of several containers of a name the first id counts.
    """
    props = F.coalesce(F.col("properties"), F.create_map().cast("map<string,string>"))
    refs = checks.withColumns(
        {
            "_dname": F.nullif(F.try_element_at(props, F.lit("ref_datastore_name")), F.lit("")),
            "_did": F.try_element_at(props, F.lit("ref_datastore_id")),
            "_cname": F.nullif(F.try_element_at(props, F.lit("ref_container_name")), F.lit("")),
            "_cid": F.try_element_at(props, F.lit("ref_container_id")),
        }
    )
    d = datastores.groupBy(F.col("name").alias("_d_name")).agg(F.min("id").cast("string").alias("_d_id"))
    refs = lookup(refs, ["_dname"], d, ["_d_name"])
    refs = refs.withColumn("_store", F.coalesce("_did", "_d_id"))
    refs = refs.withColumn(
        "_where", F.coalesce(F.col("_store"), F.col(own_datastore).cast("string"))
    )
    c = containers.groupBy(
        F.col("datastore_id").cast("string").alias("_c_store"), F.col("name").alias("_c_name")
    ).agg(F.min("id").cast("string").alias("_c_id"))
    refs = lookup(refs, ["_where", "_cname"], c, ["_c_store", "_c_name"])
    error = F.when(
        F.col("_dname").isNotNull() & F.col("_store").isNull(),
        F.concat(F.lit("referenced datastore not found: "), F.col("_dname")),
    ).when(
        F.col("_cname").isNotNull() & F.col("_cid").isNull() & F.col("_c_id").isNull(),
        F.concat(F.lit("referenced container not found: "), F.col("_cname")),
    )
    ids = F.map_concat(
        _without(
            props,
            ("ref_datastore_name", "ref_container_name", "ref_datastore_id", "ref_container_id"),
        ),
        _entry("ref_datastore_id", F.col("_store")),
        _entry("ref_container_id", F.coalesce("_cid", "_c_id")),
    )
    return refs.withColumns({"error": error, "_resolved": ids}).select(
        *[F.col("_resolved").alias(c) if c == "properties" else F.col(c) for c in checks.columns],
        "error",
    )


def upsert_plan(
    incoming: DataFrame,
    targets: Sequence[str],
    containers: DataFrame,
    existing: DataFrame,
    order: str,
    dry_run: bool = False,
) -> DataFrame:
    """What an import does to each target datastore: create, update or fail.

    ``incoming`` has ``container, uid`` (uid may be null) and the unique column
    ``order``; ``containers`` has ``datastore, name``; ``existing`` has
    ``datastore, uid, check_id``. A uid repeated in the batch updates the check
    its first occurrence creates; the dry run counts it as another create.

    Until the end a row stands for itself in all targets: what differs between them is in arrays, in their order.
    """
    names = list(targets) or [None]
    each = range(len(names))
    there = [F.col("datastore") == F.lit(t) for t in names]
    known = containers.filter(F.col("datastore").isin(names)).groupBy("name").agg(
        F.array(*[F.max(t) for t in there]).alias("_known")
    )
    rows = lookup(incoming, ["container"], known, ["name"])
    stored = existing.filter(F.col("uid").isNotNull() & F.col("datastore").isin(names)).groupBy("uid").agg(
        F.array(*[F.max(F.when(t, F.col("check_id"))) for t in there]).alias("_ids")
    )
    if not dry_run:
        rows = durable(rows, "upsert_rows")  # read for the first occurrences and for the plan
        first = rows.filter(F.col("uid").isNotNull()).groupBy("uid").agg(
            F.array(*[F.min(F.when(F.col("_known")[i], F.col(order))) for i in each]).alias("_first")
        )
        stored = lookup(first, ["uid"], stored, ["uid"])
    rows = lookup(rows, ["uid"], stored, ["uid"])
    per_target = []
    for i, t in enumerate(names):
        known_id = F.col("_ids")[i]
        action = F.when(~F.coalesce(F.col("_known")[i], F.lit(False)), "failed").when(known_id.isNotNull(), "updated")
        if not dry_run:
            action = action.when(F.col("_first")[i] < F.col(order), "updated")
        per_target.append(F.struct(
            F.lit(t).alias("target"), known_id.alias("existing_id"), action.otherwise("created").alias("action")
        ))
    out = rows.select(*[F.col(f"`{c}`") for c in incoming.columns], F.explode(F.array(*per_target)).alias("_each"))
    return out.filter(F.lit(bool(targets))).select(*[F.col(f"`{c}`") for c in incoming.columns], "_each.*")


# What an import may change on a stored check; container and rule stay.
IMPORTED_FIELDS = (
    "description", "fields", "coverage", "filter", "anomaly_message_field", "properties",
    "tags", "additional_metadata", "status",
)


def _imported(col: dict[str, Column]) -> dict[str, Column]:
    """Defaults of a check that an import creates or updates."""
    texts, empty = F.array().cast("array<string>"), F.create_map().cast("map<string,string>")
    return {
        **col,
        "description": F.coalesce(
            F.nullif(col["description"], F.lit("")), F.lit("Imported quality check")
        ),
        "fields": F.coalesce(col["fields"], texts),
        "tags": F.coalesce(col["tags"], texts),
        "properties": F.coalesce(col["properties"], empty),
        "additional_metadata": F.coalesce(col["additional_metadata"], empty),
        "status": F.coalesce(col["status"], F.lit("Active")),
    }


def import_checks(
    incoming: DataFrame,
    targets: Sequence[str],
    containers: DataFrame,
    existing: DataFrame,
    order: str,
    present: str = "present",
) -> tuple[DataFrame, DataFrame]:
    """The stored checks after an import, and its plan.

    ``existing`` has ``datastore, check_id, uid, container, rule_type`` and the
    imported fields; ``incoming`` has the same without the first two, the unique
    ``order`` and ``present``, the names of the fields it gives. Occurrences of a
    uid in the batch apply in order: of each field the last given value counts.
    New checks have no ``check_id`` yet.
    """
    plan = upsert_plan(incoming, targets, containers, existing, order)
    valid = plan.filter(F.col("action") != "failed")

    def last(name: str) -> Column:
        given = F.when(F.array_contains(present, name), F.col(order))
        return F.max_by(F.struct(F.col(name).alias("v")), given).alias(f"_{name}")

    folded = (
        valid.filter(F.col("uid").isNotNull())
        .groupBy("target", "uid")
        .agg(
            F.max("existing_id").alias("_id"),
            F.min_by("container", order).alias("_container"),
            F.min_by("rule_type", order).alias("_rule_type"),
            *[last(f) for f in IMPORTED_FIELDS],
        )
    )
    new_values = {f: F.col(f"_{f}.v") for f in IMPORTED_FIELDS}
    head = ("datastore", "check_id", "uid", "container", "rule_type")

    changes = folded.filter(F.col("_id").isNotNull()).drop("uid", "_container", "_rule_type")
    joined = existing.join(
        changes, (existing["datastore"] == changes["target"]) & (existing["check_id"] == changes["_id"]), "left"
    )
    touched = F.col("_id").isNotNull()
    merged = _imported(
        {f: F.when(F.col(f"_{f}").isNotNull(), F.col(f"_{f}.v")).otherwise(F.col(f)) for f in IMPORTED_FIELDS}
    )
    kept = joined.select(
        *head, *[F.when(touched, c).otherwise(F.col(f)).alias(f) for f, c in merged.items()]
    )

    no_id = F.lit(None).cast(existing.schema["check_id"].dataType).alias("check_id")
    created = folded.filter(F.col("_id").isNull()).select(
        F.col("target").alias("datastore"), no_id, "uid",
        F.col("_container").alias("container"), F.col("_rule_type").alias("rule_type"),
        *[c.alias(f) for f, c in _imported(new_values).items()],
    )
    given = {f: F.when(F.array_contains(present, f), F.col(f)) for f in IMPORTED_FIELDS}
    bare = valid.filter(F.col("uid").isNull()).select(
        F.col("target").alias("datastore"), no_id, "uid", "container", "rule_type",
        *[c.alias(f) for f, c in _imported(given).items()],
    )
    return kept.unionByName(created).unionByName(bare), plan


def _last(name: str, given: Column | None = None) -> Column:
    """Of the non-null (and given) values of a group the last one in order of its JSON text."""
    told = F.col(name).isNotNull() if given is None else F.col(name).isNotNull() & given
    return F.max_by(F.col(name), F.when(told, F.to_json(F.struct(name)))).alias(name)


def merge_update(
    existing: DataFrame, changes: DataFrame, key: str, fields: Sequence[str], present: str = "present"
) -> DataFrame:
    """Overlay changes on stored rows: a field named in ``present`` wins, even null.

    Several changes of one key are folded into one: per field the given value that comes
    last in order of its JSON text, and null only where none gives another.
    """
    named = F.coalesce(F.col(present), F.array().cast("array<string>"))
    changes = changes.groupBy(key).agg(
        F.array_distinct(F.flatten(F.collect_list(named))).alias(present),
        *[_last(f, F.array_contains(named, f)) for f in fields if f not in (key, present)],
    )
    new = changes.select(
        F.col(key).alias("_key"), F.col(present).alias("_present"),
        *[F.col(f).alias(f"_{f}") for f in fields],
    )
    joined = existing.join(new, existing[key] == new["_key"], "left")

    def merged(name: str) -> Column:
        given = F.array_contains(F.coalesce("_present", F.array().cast("array<string>")), name)
        return F.when(given, F.col(f"_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(*[merged(c) if c in fields else F.col(c) for c in existing.columns])


# Settings an update of each container kind keeps when not given.
KEPT_SETTINGS = {
    "table": (
        "partition_field", "incremental_field_name", "incremental_identifier_type",
        "infer_datatypes",
    ),
    "file": ("escape_character", "infer_datatypes", "has_header", "treat_empty_as_null"),
    "computed_table": ("name", "query", "incremental_field_name", "incremental_identifier_type"),
    "computed_file": (
        "name", "select_clause", "where_clause", "group_by_clause", "lateral_views",
    ),
    "computed_join": ("name",),
}


def merge_container_update(existing: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The update of a container: given values win, the kind's settings are kept.

    A pairwise join also keeps its where and group-by clauses, a SQL-mode join
    (one with a query or sources) does not. Everything else not given is null.
    """
    names = [c for c in existing.columns if c not in (key, "container_type")]
    new = changes.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in names if c in changes.columns]
    )
    # Several changes of one key count as one, folded as in merge_update.
    new = new.groupBy("_key").agg(*[_last(c) for c in new.columns if c != "_key"])
    joined = existing.join(new, existing[key] == new["_key"], "inner")
    sql_mode = F.lit(False)
    for c in ("query", "sources"):
        if c in existing.columns:
            given = F.col(c).isNotNull()
            sql_mode = sql_mode | (given & (F.size(c) > 0) if c == "sources" else given)

    def value(name: str) -> Column:
        kinds = [k for k, kept in KEPT_SETTINGS.items() if name in kept]
        keeps = F.col("container_type").isin(kinds) if kinds else F.lit(False)
        if name in ("where_clause", "group_by_clause"):
            keeps = keeps | ((F.col("container_type") == "computed_join") & ~sql_mode)
        old = F.when(keeps, F.col(name))
        return (F.coalesce(F.col(f"_{name}"), old) if name in changes.columns else old).alias(name)

    return joined.select(key, "container_type", *[value(c) for c in names])


def registry_diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """``change`` per key: unchanged, changed, new or removed.

    Contents are compared as one hash per definition; one grouping serves both
    sides. A registry compared with itself has nothing but unchanged rows.
    """
    key = list(key)

    def hashed(df: DataFrame, side: str) -> DataFrame:
        body = F.struct(*[in_order(df, c) for c in sorted(df.columns) if c not in key])
        digest = F.sha2(F.to_json(body, {"ignoreNullFields": "false"}), 256)
        return df.select(*key, digest.alias("_h"), F.lit(side).alias("_side"))

    both = hashed(old, "old").unionAll(hashed(new, "new")).groupBy(*key).agg(
        F.max(F.when(F.col("_side") == "old", F.col("_h"))).alias("_old"),
        F.max(F.when(F.col("_side") == "new", F.col("_h"))).alias("_new"),
    )
    change = (
        F.when(F.col("_old").isNull(), "new")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") == F.col("_new"), "unchanged")
        .otherwise("changed")
    )
    return both.select(*key, change.alias("change"))


def _among(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    chosen = ids.select(F.col(ids.columns[0]).alias("_id")).distinct()
    return df.join(chosen, df[key] == chosen["_id"], "left").withColumn(
        "_hit", F.col("_id").isNotNull()
    ).drop("_id")


def check_archive(
    checks: DataFrame,
    anomalies: DataFrame,
    ids: DataFrame,
    archive: bool = True,
    status: str = "Discarded",
    delete_anomalies: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Archive checks (or delete them with ``archive=False``) and drop their anomalies."""
    marked = _among(checks, "check_uid", ids)
    if archive:
        kept = marked.withColumns(
            {
                "status": F.when(F.col("_hit"), F.lit(status)).otherwise(F.col("status")),
                "archived": F.col("_hit") | F.coalesce("archived", F.lit(False)),
            }
        )
    else:
        kept = marked.filter(~F.col("_hit"))
    left = anomalies
    if delete_anomalies:
        left = rows_outside(anomalies, ["check_uid"], ids, [ids.columns[0]])
    return kept.select(*checks.columns), left


def check_activate(checks: DataFrame, ids: DataFrame) -> DataFrame:
    """Bring archived checks back as Active."""
    back = F.col("_hit") & F.coalesce("archived", F.lit(False))
    return _among(checks, "check_uid", ids).withColumns(
        {
            "status": F.when(back, "Active").otherwise(F.col("status")),
            "archived": F.coalesce("archived", F.lit(False)) & ~back,
        }
    ).select(*checks.columns)


def container_delete_cascade(
    containers: DataFrame, fields: DataFrame, checks: DataFrame, anomalies: DataFrame, names: DataFrame
) -> dict[str, DataFrame]:
    """Delete containers with their fields, checks and anomalies."""

    def without(df: DataFrame, col: str) -> DataFrame:
        return rows_outside(df, [col], names, ["name"])

    return {
        "containers": without(containers, "name"),
        "fields": without(fields, "container"),
        "checks": without(checks, "container"),
        "anomalies": without(anomalies, "container"),
    }


def template_select(
    templates: DataFrame,
    ids: Sequence | None = None,
    locked: bool | None = None,
    rule_types: Sequence[str] | None = None,
    tags: Sequence[str] | None = None,
) -> DataFrame:
    if ids:
        templates = templates.filter(F.col("id").isin(list(ids)))
    if locked is not None:
        templates = templates.filter(F.coalesce("locked", F.lit(False)) == F.lit(locked))
    if rule_types:
        templates = templates.filter(F.col("rule_type").isin(list(rule_types)))
    if tags:
        templates = templates.filter(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])))
    return templates


def template_expand(templates: DataFrame, targets: DataFrame) -> DataFrame:
    """Checks made from templates: one per ``(template_id, container, fields)`` target.

    A target's own fields win over the template's.
    """
    use = targets.select(
        F.col("template_id").alias("_tid"), F.col("container"), F.col("fields").alias("_fields")
    )
    kinds = templates.drop("container").withColumns({"_tid": F.col("id"), "_found": F.lit(True)})
    made = lookup(use, ["_tid"], kinds, ["_tid"]).filter(F.col("_found")).drop("_found")
    made = made.withColumn("fields", F.coalesce("_fields", "fields"))
    return made.withColumn(
        "check_uid", check_uid(F.col("container"), F.col("rule_type"), F.col("fields"))
    ).drop("_tid", "_fields")


def container_list(
    containers: DataFrame,
    kinds: Sequence[str] | None = None,
    name: str | None = None,
    tags: Sequence[str] | None = None,
    search: str | None = None,
    archived: str | None = None,
) -> DataFrame:
    """Containers by kind, exact name, tags and search text (case ignored)."""
    is_archived = F.coalesce("archived", F.lit(False))
    if archived == "only":
        containers = containers.filter(is_archived)
    elif archived != "include":
        containers = containers.filter(~is_archived)
    if kinds:
        containers = containers.filter(F.col("container_type").isin(list(kinds)))
    if name is not None:
        containers = containers.filter(F.col("name") == name)
    if tags:
        containers = containers.filter(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])))
    if search:
        containers = containers.filter(F.contains(F.lower("name"), F.lit(search.lower())))
    return containers
