import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.operators import set_rules
from veriframe.operators.registry import Check, checks_frame
from veriframe.operators.scan import Container, scan


@pytest.fixture
def wide(spark, tmp_path):
    """Rows with a hot key, nulls, signed zeros and numbers as text; written, so that plans show their scan."""
    data = [
        (i, 7 if i % 3 == 0 else None if i % 11 == 0 else i, f"v{i % 400}" if i % 5 else None, float(i % 300) * (-1 if i == 300 else 1), str(i % 90))
        for i in range(1_200)
    ]
    path = str(tmp_path / "wide")
    spark.createDataFrame(data, "id int, k int, v string, x double, n string").repartition(6).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def refs(spark):
    return {
        "a": Container(spark.createDataFrame([(i % 500,) for i in range(1_000)] + [(None,)], "r bigint")),
        "b": Container(spark.createDataFrame([("v1", 7), ("v2", 7), ("v300", None), ("v5", 35)], "s string, j bigint")),
        "c": Container(spark.createDataFrame([], "r string")),
        "d": Container(spark.createDataFrame([(0.0,), (5.0,)], "z double")),
        "e": Container(spark.createDataFrame([(5,), (80,)], "z int")),
    }


def twenty():
    def to(ref, field):
        return {"ref_container": ref, "field_name": field}

    out = [
        Check("t", "unique", ["k"], anomaly_message_field="v"), Check("t", "unique", ["v"]), Check("t", "unique", ["k", "v"]), Check("t", "unique", ["x"]),
        Check("t", "unique", ["v", "n"], filter="id < 900"), Check("t", "unique", ["n"], filter="id % 2 = 0"), Check("t", "unique", ["id"], coverage=0.3),
        Check("t", "existsIn", ["k"], to("a", "r")), Check("t", "existsIn", ["id"], to("a", "r"), filter="id > 450"), Check("t", "existsIn", ["v"], to("b", "s")),
        Check("t", "existsIn", ["v", "k"], to("b", "s, j")), Check("t", "existsIn", ["v"], to("c", "r")), Check("t", "existsIn", ["x"], to("d", "z")),
        Check("t", "notExistsIn", ["k"], to("a", "r")), Check("t", "notExistsIn", ["v"], to("b", "s"), coverage=0.5), Check("t", "notExistsIn", ["v"], to("c", "r")),
        Check("t", "notExistsIn", ["v", "k"], to("b", "s, j"), filter="id < 600"), Check("t", "notExistsIn", ["x"], to("d", "z")),
        Check("t", "notExistsIn", ["n"], to("e", "z")), Check("t", "existsIn", ["n"], to("e", "z"), filter="id IS NULL"),
    ]
    for i, c in enumerate(out):
        c.additional_metadata["_check_uid"] = f"check_{i:02}"
    return out


def found(spark, wide, refs, checks):
    failures = scan(spark, {"t": Container(wide, ["id"]), **refs}, checks_frame(spark, checks))
    return rows(failures, "check_uid", "rule_type", "record_key", "message", "fingerprint")


def by_single_scans(spark, wide, refs):
    out = [r for c in twenty() for r in found(spark, wide, refs, [c])]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_twenty_checks_equal_single_scans(spark, wide, refs):
    together = found(spark, wide, refs, twenty())
    assert together == by_single_scans(spark, wide, refs)
    assert len({r[0] for r in together}) >= 16


def test_hot_keys_are_spread(spark, wide, refs, no_broadcast):
    """Most keys count as hot and nothing is broadcast by size: the same failures."""
    assert found(spark, wide, refs, twenty()) == by_single_scans(spark, wide, refs)


def test_one_read_and_one_shuffle(spark, wide, refs, monkeypatch):
    plans = []
    real = set_rules.durable

    def watched(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, label)

    monkeypatch.setattr(set_rules, "durable", watched)
    failures = scan(spark, {"t": Container(wide, ["id"]), **refs}, checks_frame(spark, twenty()))
    (first, read), (second, judged) = plans
    folder = wide.inputFiles()[0].rsplit("/", 1)[0].split(":", 1)[1].lstrip("/")
    assert (first, second) == ("set_rules", "failing_keys")
    assert read.count("FileScan") == 1 and folder in read and "Exchange" not in read
    assert folder not in judged and judged.count("Exchange hashpartitioning") == 1
    last = failures._jdf.queryExecution().executedPlan().toString()
    assert folder not in last


def test_unknown_scope_and_empty_container(spark, wide, refs):
    empty = wide.filter("id < 0")
    assert found(spark, empty, refs, twenty()) == []
    none = [Check("t", "unique", ["n"], filter="k > 0 AND k IS NULL"), Check("t", "existsIn", ["n"], {"ref_container": "e", "field_name": "z"}, filter="false")]
    assert found(spark, wide, refs, none) == []


def test_types_are_compared_as_spark_does(spark, refs):
    df = spark.sql("SELECT 1 AS id, CAST(5.0 AS DECIMAL(10, 2)) AS d, 5 AS i, '5' AS s, DATE'2024-01-01' AS t")
    ref = spark.sql("SELECT CAST(5 AS BIGINT) AS i, 5.0D AS x, CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS t")
    kind = lambda a, b: set_rules.common_type(df, a, ref, b).simpleString()
    assert (kind("i", "i"), kind("d", "x"), kind("t", "t")) == ("bigint", "double", "timestamp")
    checks = [Check("t", "notExistsIn", [a], {"ref_container": "ref", "field_name": b}) for a, b in (("i", "i"), ("d", "x"), ("s", "i"), ("t", "t"))]
    failures = scan(spark, {"t": Container(df, ["id"]), "ref": Container(ref)}, checks_frame(spark, checks))
    assert failures.count() == 4


def test_checks_of_the_same_fields_share_a_key(spark, wide, refs, monkeypatch):
    """Whatever they compare them with: one hash per record for all of them, and no message that nobody asks for."""
    made, real = {}, set_rules.durable
    monkeypatch.setattr(set_rules, "durable", lambda df, label: made.setdefault(label, real(df, label)))
    checks = [c for c in twenty() if list(c.fields) == ["v"]]
    failures = scan(spark, {"t": Container(wide, ["id"]), **refs}, checks_frame(spark, checks))
    assert len(checks) == 5 and made["set_rules"].agg(F.max(F.size("_k"))).first()[0] == 1
    uids = failures.select("check_uid", "record_key")
    assert "_m0" not in uids._jdf.queryExecution().executedPlan().toString()
    assert {r[0] for r in uids.distinct().collect()} == {r[0] for c in checks for r in found(spark, wide, refs, [c])}


def test_more_checks_than_a_group_has_bits(spark, wide, refs, monkeypatch):
    monkeypatch.setattr(set_rules, "BITS", 2)
    assert found(spark, wide, refs, twenty()) == by_single_scans(spark, wide, refs)
