import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.operators import rules
from veriframe.operators.registry import Check, checks_frame
from veriframe.operators.scan import Container, ScanOptions, record_anomalies, scan, scan_summary


@pytest.fixture
def t(spark):
    return spark.createDataFrame(
        [(1, "a", 10.0, "2024-01-01"), (2, None, 20.0, "2024-02-01"), (3, "b", None, None),
         (4, "a", 30.0, "2024-01-01"), (5, "zz\n", 40.0, "2023-01-01")],
        "id int, s string, x double, d string",
    ).withColumn("d", F.col("d").cast("timestamp_ntz"))


def failing(spark, df, check, keys=("id",), **others):
    containers = {"t": Container(df, keys), **{n: Container(o) for n, o in others.items()}}
    return rows(scan(spark, containers, checks_frame(spark, [check])), "record_key")


def keys(*ids):
    return [(str(i),) for i in ids]


def test_not_null(spark, t):
    assert failing(spark, t, Check("t", "notNull", ["s", "x"])) == keys(2, 3)


def test_between_is_inclusive_and_open(spark, t):
    assert failing(spark, t, Check("t", "between", ["x"], {"min_value": 20, "max_value": 30})) == keys(1, 5)
    assert failing(spark, t, Check("t", "between", ["x"], {"max": 30})) == keys(5)
    assert failing(spark, t, Check("t", "between", ["id"], {"min": 1.5, "max": 4})) == keys(1, 5)
    with pytest.raises(ValueError):
        failing(spark, t, Check("t", "between", ["x"], {}))


def test_between_decimal_and_date(spark):
    df = spark.sql("SELECT 1 AS id, CAST(1.25 AS DECIMAL(10,2)) AS v, DATE'2024-01-02' AS d")
    assert failing(spark, df, Check("t", "between", ["v"], {"max_value": "1.249"})) == keys(1)
    assert failing(spark, df, Check("t", "between", ["d"], {"max_value": "2024-01-01"})) == keys(1)


def test_between_keeps_large_whole_numbers_apart(spark):
    df = spark.createDataFrame([(i, 2**53 + i) for i in range(4)], "id int, n bigint")
    assert failing(spark, df, Check("t", "between", ["n"], {"min": f"{2**53 + 1}.5", "max": "9007199254740994.0"})) == keys(0, 1, 3)
    assert failing(spark, df, Check("t", "between", ["n"], {"max": "9.007199254740993E15"})) == keys(2, 3)


def test_unique_ignores_null_tuples(spark, t):
    assert failing(spark, t, Check("t", "unique", ["s"])) == keys(1, 4)
    assert failing(spark, t, Check("t", "unique", ["s", "x"])) == []


def test_pattern_matches_whole_value(spark, t):
    assert failing(spark, t, Check("t", "matchesPattern", ["s"], {"pattern": "a|b|zz"})) == keys(5)
    assert failing(spark, t, Check("t", "matchesPattern", ["s"], {"pattern": "a"})) == keys(3, 5)


def test_expression_fails_only_when_false(spark, t):
    assert failing(spark, t, Check("t", "satisfiesExpression", [], {"expression": "x < 30 OR `s` = 'b'"})) == keys(4, 5)


def test_after_is_strict(spark, t):
    assert failing(spark, t, Check("t", "afterDateTime", ["d"], {"datetime": "2024-01-01"})) == keys(1, 4, 5)


def test_exists_and_not_exists(spark, t):
    ref = spark.createDataFrame([("a",), (None,)], "r string")
    props = {"ref_container": "ref", "field_name": "r"}
    assert failing(spark, t, Check("t", "existsIn", ["s"], props), ref=ref) == keys(3, 5)
    assert failing(spark, t, Check("t", "notExistsIn", ["s"], props), ref=ref) == keys(1, 4)


def test_exists_with_empty_reference(spark, t):
    ref = spark.createDataFrame([], "r string")
    props = {"ref_container": "ref", "field_name": "r"}
    assert failing(spark, t, Check("t", "existsIn", ["s"], props), ref=ref) == keys(1, 3, 4, 5)


def test_replica_counts_copies_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    assert rows(rules.replica_diff(a, b)) == [(1, None, "left_only", 1), (3, "y", "right_only", 1)]
    assert rules.replica_diff(a, a).count() == 0


def test_data_diff(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (4, "n", 1), (5, "d", 1), (5, "d", 1)], "k int, v string, w int")
    b = spark.createDataFrame([(1, "x", None), (2, "z", 2), (3, "g", 1), (5, "d", 1)], "k int, v string, w int")
    assert rows(rules.data_diff(a, b, ["k"])) == [
        (2, "changed", ["v", "w"], 1, 1), (3, "removed", None, 0, 1), (4, "added", None, 1, 0),
        (5, "repeated_key", None, 2, 1),
    ]


@pytest.fixture
def sides(spark):
    left = spark.range(3_000).selectExpr("id", "cast(id % 7 as int) as k", "if(id % 5 = 0, null, concat('v', id % 11)) as s", "if(id % 13 = 0, -0.0D, id / 3) as x", "cast(null as string) as z")
    return left, left.selectExpr("cast(id as decimal(20,0)) as id", "cast(k as bigint) as k", "s", "if(x = 0, 0.0D, x) as x", "z")


def test_digests_skip_equal_buckets(spark, sides):
    left, right = sides
    assert rules.replica_diff(left, right).count() == rules.replica_diff(left, right, exact=True).count() == 0
    changed = right.selectExpr("id", "k", "if(id = 77, z, s) as s", "x", "if(id = 77, s, z) as z").filter("id <> 5").unionAll(right.filter("id = 9"))
    for a, b in ((left, changed), (changed, left)):
        got, want = rules.replica_diff(a, b), rules.replica_diff(a, b, exact=True)
        assert rows(got) == rows(want) and got.count() == 4  # values that swap places with nulls are a difference
    buckets = rules._differing(left.withColumn("_d", F.lit(1)).unionAll(changed.withColumn("_d", F.lit(-1))), [F.col(c) for c in left.columns], [F.col("id")])
    assert buckets.count() < 60
    unlike = rules.data_diff(left, changed.dropDuplicates(["id"]), ["id"], unique_keys=True)
    assert rows(unlike) == rows(rules.data_diff(left, changed.dropDuplicates(["id"]), ["id"]))
    assert [(int(k), d) for k, d in rows(unlike, "id", "diff")] == [(5, "added"), (77, "changed")]


def test_nested_fields_are_grouped_whole(spark):
    a = spark.sql("SELECT array(1, NULL) AS v, 1 AS i")
    b = spark.sql("SELECT array(NULL, 1) AS v, 1 AS i")
    assert rules.replica_diff(a, b).count() == 2


def test_unique_keys_replica_and_diff_agree(spark):
    a = spark.createDataFrame([(i, i % 3) for i in range(50)], "k int, v int")
    b = a.withColumn("v", F.when(F.col("k") == 7, 99).otherwise(F.col("v")))
    assert rules.data_diff(a, b, ["k"]).count() == 1
    assert rules.replica_diff(a, b).count() == 2
    assert rules.data_diff(a, a, ["k"]).count() == rules.replica_diff(a, a).count() == 0


def test_aggregation_null_fails(spark, t):
    empty = t.filter("false")
    out = rules.aggregation_comparison(empty, "sum(x)", "eq", empty, "sum(x)").first()
    assert out["passed"] is False
    assert rules.aggregation_comparison(t, "count(1)", "gte", t, "count(x)").first()["passed"] is True


def test_volumetric(spark, t):
    assert rules.volumetric(t, 1, 5).first()["passed"] is True
    assert rules.volumetric(t, 6).first()["passed"] is False
    assert rules.volumetric(t.filter("false"), 1).first().asDict() == {"row_count": 0, "passed": False}


def test_filter_and_coverage(spark, t):
    assert failing(spark, t, Check("t", "notNull", ["s"], filter="id > 2 OR x > 5")) == keys(2)
    big = spark.range(4000).select(F.col("id"), F.lit(None).cast("string").alias("s"))
    some = len(failing(spark, big, Check("t", "notNull", ["s"], coverage=0.25)))
    assert 850 < some < 1150
    assert len(failing(spark, big, Check("t", "notNull", ["s"], coverage=1.0))) == 4000
    assert failing(spark, big, Check("t", "notNull", ["s"], coverage=0.0)) == []


def test_draft_and_archived_do_not_run(spark, t):
    assert failing(spark, t, Check("t", "notNull", ["s"], status="Draft")) == []
    assert failing(spark, t, Check("t", "notNull", ["s"], archived=True)) == []


def test_unknown_rule_is_refused(spark, t):
    with pytest.raises(ValueError, match="unknown rule"):
        failing(spark, t, Check("t", "sometimes", ["s"]))


def test_fused_scan_equals_single_scans(spark, t):
    checks = [
        Check("t", "notNull", ["s"]), Check("t", "between", ["x"], {"min_value": 15}),
        Check("t", "matchesPattern", ["s"], {"pattern": "a"}, filter="id <> 3"),
        Check("t", "afterDateTime", ["d"], {"datetime": "2023-06-01"}), Check("t", "unique", ["s"]),
        Check("t", "volumetric", [], {"max_rows": 2}), Check("t", "volumetric", ["s"], {"min_rows": 9}),
    ]
    containers = {"t": Container(t, ["id"])}
    cols = ["check_uid", "rule_type", "record_key", "message", "fingerprint"]
    fused = rows(scan(spark, containers, checks_frame(spark, checks)), *cols)
    single = []
    for check in checks:
        single += rows(scan(spark, containers, checks_frame(spark, [check])), *cols)
    assert sorted(map(str, fused)) == sorted(map(str, single))
    assert len(fused) == len({f[-1] for f in fused})


def test_many_checks_are_chunked(spark, t):
    checks = [Check("t", "between", ["x"], {"max_value": 25}, additional_metadata={"_check_uid": f"c{i}"}) for i in range(230)]
    out = scan(spark, {"t": Container(t, ["id"])}, checks_frame(spark, checks))
    assert out.count() == 460 and out.select("check_uid").distinct().count() == 230


def test_message_field(spark, t):
    check = Check("t", "between", ["x"], {"max_value": 25}, anomaly_message_field="s", description="big")
    out = scan(spark, {"t": Container(t, ["id"])}, checks_frame(spark, [check]))
    assert rows(out, "record_key", "message") == [("4", "a"), ("5", "zz\n")]
    check = Check("t", "notNull", ["s"], anomaly_message_field="s")
    out = scan(spark, {"t": Container(t, ["id"])}, checks_frame(spark, [check]))
    assert rows(out, "message") == [("notNull failed on s",)]


def test_rows_without_key_share_a_fingerprint(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None)], "a int, b string")
    out = scan(spark, {"t": Container(df)}, checks_frame(spark, [Check("t", "notNull", ["b"])]))
    assert sorted(r["failing_rows"] for r in record_anomalies(out).collect()) == [1, 2]


def test_composite_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a|b", "c", None), ("a", "b|c", None), (None, "x", None)], "k string, l string, v string")
    out = scan(spark, {"t": Container(df, ["k", "l"])}, checks_frame(spark, [Check("t", "notNull", ["v"])]))
    assert out.select("fingerprint").distinct().count() == 3


def test_cap_and_incremental_come_before_rules(spark):
    df = spark.createDataFrame([(i, i % 2, i) for i in range(10)], "id int, p int, b int")
    options = ScanOptions(
        incremental_fields={"t": "b"}, greater_than_batch={"t": 3}, max_records_per_partition=1
    )
    containers = {"t": Container(df, ["id"], ["p"], ["id"])}
    checks = checks_frame(spark, [Check("t", "between", ["id"], {"max_value": 0})])
    failures = scan(spark, containers, checks, options)
    assert rows(failures, "record_key") == [("4",), ("5",)]
    assert rows(scan_summary(containers, checks, failures, options)) == [("t", 2, 1, 1, 2)]


def test_scan_of_nothing(spark, t):
    out = scan(spark, {"t": Container(t)}, checks_frame(spark, [Check("other", "notNull", ["s"])]))
    assert out.count() == 0 and "fingerprint" in out.columns


def test_scan_without_broadcast(spark, no_broadcast):
    data = [(i, 1 if i % 3 == 0 else i) for i in range(900)]
    df = spark.createDataFrame(data, "id int, k int").repartition(6)
    ref = spark.createDataFrame([(i,) for i in range(0, 900, 2)], "r int")
    containers = {"t": Container(df, ["id"]), "ref": Container(ref)}
    checks = [
        Check("t", "unique", ["k"]),
        Check("t", "existsIn", ["k"], {"ref_container": "ref", "field_name": "r"}),
        Check("t", "notExistsIn", ["k"], {"ref_container": "ref", "field_name": "r"}),
    ]
    got = scan(spark, containers, checks_frame(spark, checks)).groupBy("rule_type").count()
    ones = sum(1 for _, k in data if k == 1)
    odd = sum(1 for _, k in data if k % 2)
    assert dict(rows(got)) == {"unique": ones, "existsIn": odd, "notExistsIn": len(data) - odd}


def test_row_rules_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "id * 1.5D AS x").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = checks_frame(spark, [Check("t", "between", ["x"], {"max_value": 140}), Check("t", "notNull", ["id"])])
    plan = scan(spark, {"t": Container(df, ["id"])}, checks)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThan(x,140.0),IsNull(id))]" in plan or (
        "PushedFilters: [Or(IsNull(id),GreaterThan(x,140.0))]" in plan
    )
