import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.operators import lineage
from veriframe.operators import registry as reg
from veriframe.operators.registry import Check, checks_frame
from veriframe.session import durable

META = "map<string,string>"


def stored(spark, *rows_):
    schema = (
        "id int, container string, rule_type string, description string, fields array<string>, coverage double, "
        f"filter string, properties {META}, tags array<string>, status string, anomaly_message_field string, "
        f"additional_metadata {META}"
    )
    base = (1, "orders", "notNull", "d", ["order_id"], 1.0, None, {}, ["q"], "Active", None, None)
    return spark.createDataFrame([base[:0] + tuple(r.get(n, b) for n, b in zip(schema_names(), base)) for r in rows_], schema)


def schema_names():
    return ("id", "container", "rule_type", "description", "fields", "coverage", "filter", "properties", "tags",
            "status", "anomaly_message_field", "additional_metadata")


@pytest.fixture
def refs(spark):
    containers = spark.createDataFrame([(10, "customers", 1), (11, "", 1), (12, "customers", 2)], "id int, name string, datastore_id int")
    stores = spark.createDataFrame([(1, "main"), (2, "other")], "id int, name string")
    return containers, stores


def portable(spark, refs, **values):
    return reg.portable_check(stored(spark, values), *refs).first().asDict()


def test_portable_defaults(spark, refs):
    out = portable(spark, refs, description=None, container=None, fields=None, tags=None, status=None)
    assert out["description"] == "notNull quality check" and out["container"] == ""
    assert out["fields"] == [] and out["tags"] == [] and out["status"] == "Active"
    assert out["additional_metadata"] == {"_check_uid": "__notnull"}


def test_portable_column_order(spark, refs):
    out = reg.portable_check(stored(spark, {}), *refs)
    assert tuple(out.columns) == ("id", *reg.PORTABLE_COLUMNS)


def test_portable_metadata(spark, refs):
    meta = {"owner": "x", "from quality check id": "5", "main datastore id": "6"}
    out = portable(spark, refs, additional_metadata=meta)
    assert out["additional_metadata"] == {"_check_uid": "orders__notnull__order_id", "owner": "x"}
    out = portable(spark, refs, additional_metadata={"_check_uid": "mine"})
    assert out["additional_metadata"] == {"_check_uid": "mine"}


def test_portable_references(spark, refs):
    ids = {"ref_container_id": "10", "ref_datastore_id": "2", "field_name": "id"}
    out = portable(spark, refs, rule_type="existsIn", properties=ids)
    assert out["properties"] == {"field_name": "id", "ref_container_name": "customers", "ref_datastore_name": "other"}
    unknown = {"ref_container_id": "99", "ref_datastore_id": "98"}
    assert portable(spark, refs, rule_type="dataDiff", properties=unknown)["properties"] == unknown
    nameless = {"ref_container_id": "11"}
    assert portable(spark, refs, rule_type="existsIn", properties=nameless)["properties"] == nameless
    # Only cross-reference rules have references.
    assert portable(spark, refs, rule_type="between", properties=ids)["properties"] == ids


@pytest.mark.parametrize(
    "props, want, error",
    [
        ({"ref_container_name": "customers"}, {"ref_container_id": "10"}, None),
        ({"ref_container_name": "customers", "ref_datastore_name": "other"}, {"ref_container_id": "12", "ref_datastore_id": "2"}, None),
        ({"ref_container_name": "nope"}, {}, "referenced container not found: nope"),
        ({"ref_datastore_name": "nope"}, {}, "referenced datastore not found: nope"),
        ({"ref_container_name": "nope", "ref_container_id": "5"}, {"ref_container_id": "5"}, None),
        ({"field_name": "id"}, {"field_name": "id"}, None),
    ],
)
@pytest.mark.parametrize("broadcast", [True, False])
def test_resolve_refs(spark, refs, props, want, error, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    checks = spark.createDataFrame([(1, 1, props)], f"id int, datastore_id int, properties {META}")
    out = reg.resolve_refs(checks, *refs).first()
    assert (out["properties"], out["error"]) == (want, error)


def test_portable_then_resolved_is_the_same(spark, refs):
    ids = {"ref_container_id": "10", "ref_datastore_id": "2"}
    sent = reg.portable_check(stored(spark, {"rule_type": "existsIn", "properties": ids}), *refs)
    # "customers" of datastore 2 has another id there.
    back = reg.resolve_refs(sent.withColumn("datastore_id", F.lit(1)), *refs).first()
    assert back["properties"] == {"ref_container_id": "12", "ref_datastore_id": "2"} and back["error"] is None


def test_portable_names(spark):
    df = spark.createDataFrame(
        [(1, "T", "unique", ["a"]), (2, "t", "unique", ["a"]), (3, "t", "unique", ["a"]), (4, "t", "unique", ["a", "2"]),
         (5, "", "unique", ["a"]), (6, "t", "volumetric", []), (7, None, None, [])],
        "id int, container string, rule_type string, fields array<string>",
    )
    out = rows(reg.portable_names(df, "id"), "id", "folder", "name")
    assert out == [
        (1, "t", "unique__a"), (2, "t", "unique__a_2"), (3, "t", "unique__a_3"), (4, "t", "unique__2_a"),
        (5, "_no_container", "unique__a"), (6, "t", "volumetric"), (7, "_no_container", "unknown"),
    ]


def test_portable_names_never_collide(spark):
    names = ["x", "x", "x_2", "x", "x_3", "x_2", "x"]
    df = spark.createDataFrame(
        [(i, "t", "r", [n]) for i, n in enumerate(names)], "id int, container string, rule_type string, fields array<string>"
    )
    out = rows(reg.portable_names(df, "id"), "id", "name")
    assert len({n for _, n in out}) == len(names)
    assert [n for _, n in out] == ["r__x", "r__x_4", "r__x_2", "r__x_5", "r__x_3", "r__x_2_2", "r__x_6"]


def plan(spark, batch, existing=(), dry_run=False, targets=("s1",)):
    incoming = spark.createDataFrame(batch, "pos int, container string, uid string")
    containers = spark.createDataFrame([("s1", "orders"), ("s2", "orders"), ("s1", "items")], "datastore string, name string")
    known = spark.createDataFrame(list(existing), "datastore string, uid string, check_id int")
    out = reg.upsert_plan(incoming, list(targets), containers, known, "pos", dry_run)
    return rows(out, "target", "pos", "action", "existing_id")


@pytest.mark.parametrize("broadcast", [True, False])
def test_upsert_plan(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    batch = [(1, "orders", "u1"), (2, "orders", "u2"), (3, "ghost", "u3"), (4, "items", "u2"), (5, "items", None), (6, "items", None)]
    known = [("s1", "u1", 7), ("s1", "u1", 9), ("s2", "u2", 8)]
    assert plan(spark, batch, known) == [
        ("s1", 1, "updated", 9), ("s1", 2, "created", None), ("s1", 3, "failed", None),
        ("s1", 4, "updated", None), ("s1", 5, "created", None), ("s1", 6, "created", None),
    ]
    assert [r[2] for r in plan(spark, batch, known, dry_run=True)] == ["updated", "created", "failed", "created", "created", "created"]
    assert [r[2] for r in plan(spark, batch, known, targets=("s2",))] == ["created", "updated", "failed", "failed", "failed", "failed"]


def test_many_targets_do_not_multiply_what_is_joined(spark, monkeypatch, no_broadcast):
    """Every row meets containers and stored uids once, whatever the number of targets; repeated and null keys as with one target."""
    batch = [(1, "orders", "u1"), (2, "ghost", "u2"), (3, "orders", "u2"), (4, "items", "u2"), (4, "items", "u2"), (5, None, "u1"), (6, "items", None), (None, "items", "u2")]
    known = [("s1", "u1", 7), ("s2", "u2", 8), ("s2", "u1", None), (None, "u1", 3), ("s1", None, 4)]
    sizes, real = [], reg.lookup
    monkeypatch.setattr(reg, "lookup", lambda df, *a: sizes.append(df.count()) or real(df, *a))
    targets = ["s1", "s2", "s9", "s1"]
    for dry_run in (False, True):
        together = plan(spark, batch, known, dry_run, targets)
        assert max(sizes) <= len(batch)
        singles = [r for t in targets for r in plan(spark, batch, known, dry_run, [t])]
        assert together == sorted(singles, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert plan(spark, batch, known, targets=()) == []


def test_failed_first_does_not_claim_the_uid(spark):
    assert [r[2] for r in plan(spark, [(1, "ghost", "u"), (2, "orders", "u"), (3, "orders", "u")])] == ["failed", "created", "updated"]


IMPORT = (
    "container string, uid string, rule_type string, description string, fields array<string>, coverage double, "
    f"filter string, anomaly_message_field string, properties {META}, tags array<string>, "
    f"additional_metadata {META}, status string"
)


def batch(spark, *rows_):
    names = [c.strip().split(" ")[0] for c in IMPORT.split(", ")]
    data = [
        (pos, [n for n in names if n in r], *[r.get(n) for n in names]) for pos, r in enumerate(rows_)
    ]
    return spark.createDataFrame(data, f"pos int, present array<string>, {IMPORT}")


def test_import_merges_creates_and_keeps(spark):
    containers = spark.createDataFrame([("dev", "orders"), ("prod", "orders")], "datastore string, name string")
    old = ("orders", "u1", "notNull", "old text", ["id"], 0.5, "id > 1", "msg", {"a": "1"}, ["x"], {"_check_uid": "u1"}, "Draft")
    existing = spark.createDataFrame(
        [("prod", 7, *old), ("prod", 8, *old[:1], "u9", *old[2:])], f"datastore string, check_id int, {IMPORT}"
    )
    incoming = batch(
        spark,
        {"container": "orders", "uid": "u1", "rule_type": "notNull", "tags": ["new"], "filter": None, "description": ""},
        {"container": "orders", "uid": "u2", "rule_type": "unique", "fields": ["id"]},
        {"container": "orders", "uid": "u2", "rule_type": "unique", "description": "second", "coverage": 0.1},
        {"container": "nowhere", "uid": "u3", "rule_type": "unique"},
        {"container": "orders", "rule_type": "volumetric"},
        {"container": "orders", "rule_type": "volumetric"},
    )
    after, plan = reg.import_checks(incoming, ["prod", "dev"], containers, existing, "pos")
    assert [r[0] for r in rows(plan.filter("target = 'prod'").orderBy("pos"), "action")].count("failed") == 1
    got = {(r["datastore"], r["uid"], r["check_id"]): r.asDict() for r in after.filter("uid IS NOT NULL").collect()}
    first = got["prod", "u1", 7]
    # Given fields win, even when they are empty; the others stay.
    assert (first["tags"], first["filter"], first["description"]) == (["new"], None, "Imported quality check")
    assert (first["fields"], first["coverage"], first["status"], first["anomaly_message_field"]) == (["id"], 0.5, "Draft", "msg")
    assert got["prod", "u9", 8]["description"] == "old text"
    second = got["dev", "u2", None]
    assert (second["fields"], second["description"], second["coverage"], second["status"]) == (["id"], "second", 0.1, "Active")
    assert got["dev", "u1", None]["fields"] == [] and ("dev", "u3", None) not in got
    assert after.filter("uid IS NULL").count() == 4 and after.count() == 2 + 1 + 2 + 4


def test_import_twice_changes_nothing(spark):
    containers = spark.createDataFrame([("dev", "orders")], "datastore string, name string")
    incoming = batch(spark, {"container": "orders", "uid": "u1", "rule_type": "notNull", "fields": ["a"], "status": "Draft"})
    empty = spark.createDataFrame([], f"datastore string, check_id int, {IMPORT}")
    once, _ = reg.import_checks(incoming, ["dev"], containers, empty, "pos")
    stored_ = durable(once.withColumn("check_id", F.lit(1)))
    twice, plan = reg.import_checks(incoming, ["dev"], containers, stored_, "pos")
    assert rows(plan, "action") == [("updated",)]
    changes = reg.registry_diff(stored_, twice, ["datastore", "uid"])
    assert rows(changes, "change") == [("unchanged",)]


def test_merge_update(spark):
    old = spark.createDataFrame([(1, "d", "Active"), (2, "e", "Draft")], "id int, description string, status string")
    new = spark.createDataFrame([(1, None, "X", ["description"])], "id int, description string, status string, present array<string>")
    out = reg.merge_update(old, new, "id", ["description", "status"])
    assert rows(out) == [(1, None, "Active"), (2, "e", "Draft")]


def test_merge_container_update(spark):
    old = spark.createDataFrame(
        [(1, "table", "n", None, "ts", "w"), (2, "computed_join", "n", None, "ts", "w"), (3, "computed_join", "n", "q", "ts", "w"),
         (4, "computed_table", "n", "q", "ts", "w")],
        "id int, container_type string, name string, query string, incremental_field_name string, where_clause string",
    )
    new = spark.createDataFrame([(i, "new" if i == 4 else None) for i in range(1, 5)], "id int, query string")
    assert rows(reg.merge_container_update(old, new, "id")) == [
        (1, "table", None, None, "ts", None), (2, "computed_join", "n", None, None, "w"),
        (3, "computed_join", "n", None, None, None), (4, "computed_table", "n", "new", "ts", None),
    ]


def test_registry_diff_with_itself_is_empty(spark):
    checks = checks_frame(spark, [Check("t", "notNull", ["a"], {"k": 1}), Check("t", "unique", ["a"])]).select("check_uid", "status", "fields", "description")
    out = reg.registry_diff(checks, checks, ["check_uid"])
    assert {r["change"] for r in out.collect()} == {"unchanged"}
    changed = checks.withColumn("description", F.when(F.col("check_uid").contains("unique"), "new"))
    assert sorted(r["change"] for r in reg.registry_diff(checks, changed, ["check_uid"]).collect()) == ["changed", "unchanged"]


def test_archive_and_activate(spark):
    checks = checks_frame(spark, [Check("t", "notNull", ["a"]), Check("t", "unique", ["a"])])
    anomalies = spark.createDataFrame([(1, "t__notnull__a"), (2, "t__unique__a")], "id int, check_uid string")
    ids = spark.createDataFrame([("t__unique__a",)], "check_uid string")
    kept, left = reg.check_archive(checks, anomalies, ids)
    assert rows(kept, "check_uid", "status", "archived") == [("t__notnull__a", "Active", False), ("t__unique__a", "Discarded", True)]
    assert rows(left, "id") == [(1,)]
    assert reg.active_checks(kept).count() == 1
    assert rows(reg.check_activate(kept, ids), "status", "archived") == [("Active", False), ("Active", False)]
    kept, left = reg.check_archive(checks, anomalies, ids, archive=False, delete_anomalies=False)
    assert kept.count() == 1 and left.count() == 2


def test_select(spark):
    checks = checks_frame(spark, [Check("t", "notNull", ["a"], tags=["x"]), Check("u", "unique", ["a"], status="Draft"), Check("u", "unique", ["b"], archived=True)])
    assert reg.check_select(checks).count() == 2
    assert reg.check_select(checks, status="draft").count() == 1
    assert reg.check_select(checks, status="ARCHIVED").count() == 1
    assert reg.check_select(checks, containers=["t"], tags=["x", "y"]).count() == 1


def test_template_expand(spark):
    templates = spark.createDataFrame([(1, "notNull", ["a"], True)], "id int, rule_type string, fields array<string>, locked boolean")
    targets = spark.createDataFrame([(1, "t", None), (1, "u", ["b"]), (9, "v", None)], "template_id int, container string, fields array<string>")
    assert rows(reg.template_expand(templates, targets), "check_uid") == [("t__notnull__a",), ("u__notnull__b",)]


def test_lineage_with_cycle(spark):
    df = spark.createDataFrame(
        [("a", "b", None, None, None), ("b", None, "c", "d", None), ("c", None, None, None, [("a", "x", "s")]), ("e", None, None, None, [])],
        "name string, source_name string, left_name string, right_name string, sources array<struct<container:string,alias:string,datastore:string>>",
    )
    edges = lineage.lineage_edges(df)
    assert rows(edges) == [("a", "b"), ("b", "c"), ("b", "d"), ("c", "a")]
    out = rows(lineage.lineage_closure(edges))
    assert ("a", "a", 3) in out and ("c", "d", 3) in out and len(out) == 12


def test_lineage_has_no_depth_limit(spark):
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(6)], "child string, parent string")
    assert lineage.lineage_closure(chain).count() == 21


def test_lineage_rounds_grow_with_the_logarithm_of_depth(spark, monkeypatch):
    rounds = []
    real = lineage.durable
    monkeypatch.setattr(lineage, "durable", lambda df, label: rounds.append(label) or real(df, label))
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(i, i + 3) for i in range(0, 60, 20)], "child int, parent int")
    out = rows(lineage.lineage_closure(chain))
    assert len(rounds) <= 9 and len(out) == 200 * 201 // 2
    jumps = {i: i + 3 for i in range(0, 60, 20)}
    steps, at = 0, 0
    while at < 200:
        at, steps = jumps.get(at, at + 1), steps + 1
    assert (0, 200, steps) in out and (199, 200, 1) in out and (0, 3, 1) in out


def test_repeated_changes_and_map_order(spark):
    old = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, x string, y string")
    changes = spark.createDataFrame(
        [(1, "n", None, ["x"]), (1, None, "m", ["y"]), (1, "k", None, ["x"])], "id int, x string, y string, present array<string>"
    )
    assert rows(reg.merge_update(old, changes, "id", ["x", "y"])) == [(1, "n", "m"), (2, "c", "d")]
    one = spark.sql("select 1 id, map('a', 1, 'b', 2) m")
    two = spark.sql("select 1 id, map('b', 2, 'a', 1) m")
    assert rows(reg.registry_diff(one, two, ["id"])) == [(1, "unchanged")]
