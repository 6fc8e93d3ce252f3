import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.operators import computed, definitions, fields
from veriframe.operators.fields import ComputedField
from veriframe.operators.registry import checks_frame
from veriframe.operators.scan import Container, scan


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (3, 30), (None, 99)], "k int, w int")
    return left, right


JOINED = {
    "inner": [("a", 10), ("b", 10)],
    "left": [("a", 10), ("b", 10), ("c", None), ("n", None)],
    "right": [("a", 10), ("b", 10), (None, 30), (None, 99)],
    "full": [("a", 10), ("b", 10), ("c", None), ("n", None), (None, 30), (None, 99)],
}


@pytest.mark.parametrize("how", list(JOINED))
@pytest.mark.parametrize("broadcast", [True, False])
def test_join_types(sides, how, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    out = computed.computed_join(*sides, "k", "k", "l_v AS v, r_w AS w", how, "l_", "r_")
    assert sorted(rows(out), key=str) == sorted(JOINED[how], key=str)


def test_join_needs_prefixes_and_known_type(sides):
    with pytest.raises(ValueError, match="prefix"):
        computed.computed_join(*sides, "k", "k", "*")
    with pytest.raises(ValueError, match="join type"):
        computed.computed_join(*sides, "k", "k", "*", "cross", "l_", "r_")


def test_computed_file_and_lateral_view(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, [5])], "id int, items array<int>")
    out = computed.computed_file(df, "id, item", where="item > 1", lateral_views=["EXPLODE(items) item"])
    assert rows(out) == [(1, 2), (3, 5)]
    out = computed.computed_file(df, "count(1) AS n, max(item) AS m", lateral_views=["EXPLODE(items) item"], group_by="id % 2")
    assert rows(out) == [(3, 5)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("vf_")]


def test_auto_alias(spark):
    spark.createDataFrame([(1, " x ")], "id int, name string").createOrReplaceTempView("src_alias")
    out = computed.auto_alias(spark.sql("SELECT coalesce(trim(name), 'Blank'), upper(name), id AS order_id, id FROM src_alias"))
    assert out.columns == ["expr_1", "expr_2", "order_id", "id"]
    odd = spark.createDataFrame([(1, 2)], ["my col", "b"])
    assert computed.auto_alias(odd, known=["my col"]).columns == ["my col", "b"]


def test_validate_container(spark):
    df = spark.createDataFrame([(1,)], "a int")
    ok, reason, schema = computed.validate_container(lambda: computed.computed_file(df, "a + 1 AS b"))
    assert ok and reason is None and schema.names == ["b"]
    ok, reason, schema = computed.validate_container(lambda: computed.computed_file(df, "missing"))
    assert not ok and "missing" in reason and schema is None


def test_field_drop_guard(spark):
    old = spark.createDataFrame([("t", "a"), ("t", "b"), ("t", "c")], "container string, field string")
    new = spark.createDataFrame([("t", "a")], "container string, field string")
    checks = spark.createDataFrame([("t", ["b", "a"])], "container string, fields array<string>")
    none = spark.createDataFrame([], "container string, field string")
    assert rows(computed.field_drop_guard(old, new, checks, none)) == [("t", "b", 1, 0, "conflict")]
    assert rows(computed.field_drop_guard(old, new, checks, none, force=True)) == [("t", "b", 1, 0, "dropped")]


def test_load_definitions(spark, tmp_path):
    path = tmp_path / "defs.csv"
    path.write_text(
        'id,text,sql\n'
        'LATE1,"Neg, totals","SELECT *\nFROM t\nWHERE ""x"" < 0"\n'
        '\n'
        '  ,blank name,SELECT 1\n'
        'short,row\n'
        'LATE2,,\n'
        ' LATE3 ,d, SELECT 3 ,extra\n'
    )
    out = rows(definitions.load_definitions(spark, str(path)), "row", "name", "description", "query")
    assert out == [
        (1, "LATE1", "Neg, totals", 'SELECT *\nFROM t\nWHERE "x" < 0'), (2, "LATE2", "", ""), (3, "LATE3", "d", "SELECT 3"),
    ]


def test_load_tab_separated(spark, tmp_path):
    path = tmp_path / "defs.txt"
    path.write_text("n\td\tq\nA\tdesc, one\tSELECT 1\n")
    assert rows(definitions.load_definitions(spark, str(path)), "name", "description", "query") == [("A", "desc, one", "SELECT 1")]
    semi = tmp_path / "semi.txt"
    semi.write_text("n;d;q\nA;;SELECT 1\n")
    assert rows(definitions.load_definitions(spark, str(semi), ";"), "name", "query") == [("A", "SELECT 1")]


@pytest.mark.parametrize("broadcast", [True, False])
def test_validate_definitions(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    df = spark.createDataFrame(
        [(1, "a", "q"), (2, "b", ""), (3, "", "q"), (4, "a", "q"), (5, "b", "q"), (6, "b", "q"), (7, "a", None), (8, "c", "")],
        "row int, name string, query string",
    )
    assert rows(definitions.validate_definitions(df), "row", "valid", "reason") == [
        (1, True, None), (2, False, "empty query"), (3, False, "empty name"), (4, False, "duplicate of row 1"),
        (5, True, None), (6, False, "duplicate of row 5"), (7, False, "empty query"), (8, False, "empty query"),
    ]


def test_plan_definitions(spark):
    defs = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    known = spark.createDataFrame([("ct_a",), ("ct_b",)], "name string")
    checked = spark.createDataFrame([("ct_a",)], "name string")
    pick = ["table_name", "table_action", "check_action"]
    assert rows(definitions.plan_definitions(defs, known, checked), *pick) == [
        ("ct_a", "skip", "skip"), ("ct_b", "skip", "create"), ("ct_c", "create", "create"),
    ]
    assert rows(definitions.plan_definitions(defs, known, checked, "dq_", True), *pick)[0] == ("dq_a", "create", "skip")


def test_error_query_check(spark):
    bad = spark.createDataFrame([(1, None), (None, None), (2, "x")], ["order_id", "coalesce(trim(status))"])
    check = definitions.error_query_check(bad, "ct_LATE1", as_draft=False)
    assert check.properties["expression"] == "`order_id` IS NULL AND `coalesce(trim(status))` IS NULL"
    assert definitions.error_query_check(bad, "ct_LATE1").status == "Draft"
    out = scan(spark, {"ct_LATE1": Container(bad)}, checks_frame(spark, [check]))
    assert out.count() == 2


def test_cast_fields(spark):
    df = spark.createDataFrame([("12", "31/12/2024"), ("x", "99/99/2024"), (None, None)], "a string, d string")
    out = df.select(
        fields.cast_field("a", "integer").alias("i"), fields.cast_field("d", "date", "dd/MM/yyyy").cast("string").alias("d"),
        fields.cast_field("a", "decimal(5,1)").cast("string").alias("c"),
    )
    assert sorted(rows(out), key=str) == sorted([(12, "2024-12-31", "12.0"), (None, None, None), (None, None, None)], key=str)


def test_custom_expression_takes_no_sources(spark):
    with pytest.raises(ValueError):
        fields.custom_expression("1", ["a"])


def test_apply_computed_fields(spark):
    df = spark.createDataFrame([(1, "Acme Inc."), (2, None)], "id int, name string")
    ref = spark.createDataFrame([(7, "ACME"), (5, "acme"), (6, "other")], "rid int, n string")
    out = fields.apply_computed_fields(
        df,
        [
            ComputedField("clean", "cleanedEntityName", ["name"], {"drop_from_suffix": True, "terms_to_drop": ["Inc."]}),
            ComputedField("id", "cast", ["id"], {"target_type": "string"}),
            ComputedField("both", "concatenate", ["id", "name"]),
            ComputedField("n", "customExpression", None, {"column_expression": "id * 10"}),
            ComputedField("who", "entityNameLookup", ["clean"], {"ref_container_name": "r", "ref_field": "n", "ref_id_field": "rid"}),
        ],
        {"r": ref},
    )
    assert out.columns[0] == "id" and dict(out.dtypes)["id"] == "string"
    assert rows(out, "id", "clean", "both", "n", "who") == [("1", "Acme", "1 Acme Inc.", 10, 5), ("2", None, "2", 20, None)]


def test_bad_definitions(spark):
    df = spark.createDataFrame([(1,)], "id int")
    for bad in (
        ComputedField("x", "cast", None, {"target_type": "int"}), ComputedField("x", "cast", ["a", "b"], {"target_type": "int"}),
        ComputedField("x", "nothing", ["id"]),
    ):
        with pytest.raises(ValueError):
            fields.apply_computed_fields(df, [bad])


def test_computed_tables_leave_the_session_as_it_was(spark):
    from veriframe.operators.computed import computed_table

    spark.range(3).createOrReplaceTempView("kept_view")
    one = computed_table(spark, {"kept_view": spark.range(1), "fresh_view": spark.range(2)}, "SELECT a.id FROM kept_view a, fresh_view b")
    two = computed_table(spark, {"kept_view": spark.range(7)}, "SELECT id FROM kept_view")
    assert (one.count(), two.count(), spark.table("kept_view").count()) == (2, 7, 3)
    assert not spark.catalog.tableExists("fresh_view")
    spark.catalog.dropTempView("kept_view")


def test_views_are_put_back_whatever_their_case(spark):
    spark.range(3).createOrReplaceTempView("kept_view")
    assert computed.computed_table(spark, {"Kept_View": spark.range(5)}, "SELECT * FROM kept_view").count() == 5
    assert spark.table("kept_view").count() == 3
    spark.catalog.dropTempView("kept_view")


@pytest.mark.parametrize(
    ("view", "select", "want"),
    [
        ("EXPLODE(a) item", "id, item", [(1, "x"), (1, "y)")]), ("explode(a) AS item", "id, item", [(1, "x"), (1, "y)")]),
        ("POSEXPLODE(a) pos, item", "id, pos, item", [(1, 0, "x"), (1, 1, "y)")]), ("POSEXPLODE(a)  as  `p q`,item", "id, `p q`, item", [(1, 0, "x"), (1, 1, "y)")]),
        ("EXPLODE(m) k, v", "id, k, v", [(1, "k", 2)]), ("OUTER EXPLODE(m) AS k, v", "id, k, v", [(1, "k", 2), (2, None, None)]),
        ("EXPLODE(split('a) b,c', '[,)]')) part", "id, part", [(i, p) for i in (1, 2) for p in (" b", "a", "c")]), ("EXPLODE(a)", "id, col", [(1, "x"), (1, "y)")]),
    ],
)
def test_lateral_view_forms(spark, view, select, want):
    df = spark.sql("SELECT 1 AS id, array('x', 'y)') AS a, map('k', 2) AS m UNION ALL SELECT 2, array(), map()")
    assert rows(computed.computed_file(df, select, lateral_views=[view])) == want
    with pytest.raises(ValueError, match="no whole call"):
        computed.computed_file(df, "id", lateral_views=["EXPLODE(a item"])
