import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veriframe.operators import inference, profile
from veriframe.operators.registry import Check, checks_frame
from veriframe.operators.scan import Container, scan


@pytest.fixture
def t(spark):
    return spark.createDataFrame(
        [(1, "AB-1", 1.0, "2024-01-01"), (2, "CD-22", None, "2024-01-03"), (3, "EF-3", 3.0, None)],
        "id int, code string, x double, d string",
    ).withColumn("d", F.col("d").cast("date"))


@pytest.mark.parametrize("exact", [True, False])
def test_field_profile(spark, t, exact):
    out = {r["field"]: r.asDict() for r in profile.field_profile(t, "t", exact=exact).collect()}
    assert out["x"]["null_count"] == 1 and out["x"]["mean"] == 2.0 and out["x"]["completeness"] == pytest.approx(2 / 3)
    assert out["code"]["pattern"] == "[A-Z]+-[0-9]+" and out["code"]["min_length"] == 4 and out["code"]["max"] == "EF-3"
    assert out["d"]["min"] == "2024-01-01" and out["d"]["type"] == "date" and out["id"]["distinct_count"] == 3


def test_profile_of_nothing_and_nested(spark):
    df = spark.createDataFrame([], "a int, b array<int>, c struct<x:int>, m map<string,int>")
    out = profile.field_profile(df, "t").collect()
    assert len(out) == 4 and all(r["row_count"] == 0 and r["completeness"] is None for r in out)


def test_profile_of_many_columns(spark):
    df = spark.range(5).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(130)])
    out = profile.field_profile(df, "t")
    assert out.count() == 130 and out.filter("distinct_count BETWEEN 4 AND 6").count() == 130


@pytest.mark.parametrize("value, mask", [("a.b", r"[a-z]+\.[a-z]+"), ("A1 (x)", r"[A-Z]+[0-9]+ \([a-z]+\)"), ("", ""), ("é$", r"é\$")])
def test_value_mask_matches_itself(spark, value, mask):
    row = spark.createDataFrame([(value,)], "v string").select(profile.value_mask(F.col("v")).alias("m"), "v")
    assert row.first()["m"] == mask
    assert row.select(F.expr("v RLIKE concat('\\\\A(?:', m, ')\\\\z')").alias("ok")).first()["ok"]


@pytest.mark.parametrize(
    "values, want",
    [
        (["true", "FALSE", None], "boolean"), (["1", "-2"], "bigint"), (["1", "2.5", "1e3"], "double"),
        (["99999999999999999999"], "double"), (["2024-01-01"], "date"), (["2024-01-01", "2024-01-01 10:00:00"], "timestamp_ntz"),
        (["2024-13-01"], "string"), (["1", "x"], "string"), ([None], "string"), (["1", "2024-01-01"], "string"), ([""], "string"),
        (["1", "true"], "string"),
    ],
)
def test_infer_types(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    assert rows(profile.infer_types(df, ["c"])) == [("c", want)]
    cast = profile.cast_inferred(df, ["c"])
    assert cast.schema["c"].dataType.simpleString() == want
    if want != "string":
        assert cast.filter("c IS NULL").count() == sum(v is None for v in values)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(3)
    probabilities = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r["probability"]: r["value"] for r in profile.quantile_profile(df, ["v"], probabilities, exact=True).collect()}
    clean = [float(v) for v in values if v is not None]
    if not clean:
        assert got == {}
        return
    for p in probabilities:
        assert got[p] == pytest.approx(np.quantile(clean, p), rel=1e-9, abs=1e-9)


def test_approximate_quantiles(spark):
    df = spark.range(1001).withColumn("twice", F.col("id") * 2)
    got = rows(profile.quantile_profile(df, ["id", "twice"], [0.5]))
    assert got == [("id", 0.5, 500.0), ("twice", 0.5, 1000.0)]


def test_histogram_limit_is_exact(spark):
    df = spark.range(100).selectExpr("id", "id % 10 AS ten", "id % 11 AS eleven", "IF(id > 1, NULL, id) AS few")
    out = profile.value_histogram(df, ["id", "ten", "eleven", "few"], 10)
    assert dict(rows(out.groupBy("field").agg(F.sum("row_count")))) == {"ten": 100, "few": 2}


def test_correlation(spark):
    df = spark.range(50).selectExpr("id AS a", "-2 * id AS b", "pmod(id * 7919, 13) AS c", "1 AS flat")
    assert rows(profile.correlation_profile(df, ["a", "b", "c", "flat"], 0.9)) == [("a", "b", -1.0)]


def test_correlation_of_many_columns_equals_pairs(spark, monkeypatch):
    """Nulls in different rows, constants, large offsets, and columns over several blocks."""
    from veriframe.operators import gram

    monkeypatch.setattr(gram, "BLOCK", 4)
    monkeypatch.setattr(gram, "ROWS", 50)
    monkeypatch.setattr(gram, "FAN_IN", 2)
    df = spark.range(0, 600, 1, 5).selectExpr(
        "id AS a", "if(id % 7 = 0, null, -2 * id + pmod(id * 7919, 13)) AS b", "pmod(id * 7919, 13) + 1e9 AS c", "0.1 AS flat", "cast(null as double) AS none",
        "if(id % 5 = 0, null, id * id) AS d", "cast(sqrt(id) as decimal(10, 3)) AS e", "if(id < 300, null, 5) AS half", "float(pmod(id * 31, 17)) AS g", "if(id = 3, id, null) AS one",
    )
    for threshold in (0.0, 0.5):
        got, want = ({r[:2]: r[2] for r in rows(f(df, df.columns, threshold))} for f in (gram.correlations, profile.correlation_profile))
        assert got == {k: pytest.approx(v, abs=2e-6) for k, v in want.items()} and len(want) > 3
    assert gram.correlations(df.limit(0), df.columns, 0.0).count() == 0
    odd = df.select("a", F.when(F.col("a") == 9, float("nan")).otherwise(F.col("g")).alias("g"), "d")
    assert str(rows(gram.correlations(odd, odd.columns, 0.9))) == str(rows(profile.correlation_profile(odd, odd.columns, 0.9)))


def test_five_hundred_columns(spark):
    df = spark.range(0, 300, 1, 4).select(*[((F.col("id") * (2 * i + 1)) % 101 + (F.col("id") if i % 50 == 0 else 0) * 1_000).alias(f"c{i}") for i in range(500)])
    got = rows(profile.correlation_profile(df, df.columns, 0.99))
    assert {a for a, _, _ in got} | {b for _, b, _ in got} >= {f"c{i}" for i in range(0, 500, 50)}


def test_inclusion_dependencies(spark, t):
    ref = spark.createDataFrame([(i,) for i in range(1, 6)], "k int")
    pairs = [("t", "id", "ref", "k"), ("ref", "k", "t", "id")]
    assert rows(profile.inclusion_dependencies({"t": t, "ref": ref}, pairs)) == [("t", "id", "ref", "k")]


LEVEL_RULES = [
    ("off", 0, set()), ("low", 1, {"notNull"}), ("medium", 2, {"notNull", "unique"}),
    ("high", 3, {"notNull", "unique", "between", "afterDateTime"}),
    ("xhigh", 4, {"notNull", "unique", "between", "afterDateTime", "matchesPattern"}),
    ("max", 5, {"notNull", "unique", "between", "afterDateTime", "matchesPattern", "existsIn"}),
]


@pytest.mark.parametrize("name, number, rules", LEVEL_RULES)
def test_inferred_checks_hold_on_their_data(spark, t, name, number, rules):
    assert inference.level_name(str(number)) == inference.level_name(number) == name
    ref = spark.createDataFrame([(i,) for i in range(1, 6)], "k int")
    found = profile.inclusion_dependencies({"t": t, "ref": ref}, [("t", "id", "ref", "k")])
    checks = inference.infer_checks(profile.field_profile(t, "t", exact=True), name, inclusions=found)
    assert {r["rule_type"] for r in checks.collect()} == rules
    assert scan(spark, {"t": Container(t, ["id"]), "ref": Container(ref)}, checks).count() == 0


def test_exact_keys_of_a_sketched_profile(spark):
    df = spark.range(3000).selectExpr("id", "IF(id = 9, 8, id) AS almost", "id % 7 AS few")
    out = profile.with_exact_keys(df, profile.field_profile(df, "t"))
    got = {r["field"]: r["distinct_count"] for r in out.collect()}
    assert got["id"] == 3000 and got["almost"] == 2999 and got["few"] == 7
    unique = inference.infer_checks(out, "medium").filter("rule_type = 'unique'")
    assert rows(unique, "check_uid") == [("t__unique__id",)]


def test_unknown_level(spark):
    for bad in ("7", "extreme"):
        with pytest.raises(ValueError):
            inference.level_name(bad)


def test_trial_on_a_sample(spark):
    df = spark.range(200).selectExpr("id", "IF(id < 20, NULL, id) AS v")
    checks = checks_frame(
        spark, [Check("t", "notNull", ["v"], status="Draft"), Check("t", "notNull", ["id"]),
                Check("t", "existsIn", ["id"], {"ref_container": "t", "field_name": "id"})],
    )
    out = inference.test_inferred(spark, {"t": Container(df, ["id"])}, checks, 100_000, 90.0)
    assert rows(out, "check_uid", "pass_percent") == [
        ("t__existsin__id", 100.0), ("t__notnull__id", 100.0), ("t__notnull__v", 90.0),
    ]
    assert inference.test_inferred(spark, {"t": Container(df, ["id"])}, checks, 50, 100.0).count() >= 2
    for bad in (0, -1):
        with pytest.raises(ValueError):
            inference.test_inferred(spark, {"t": Container(df, ["id"])}, checks, bad)


def test_all_inclusions_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    values = {
        ("a", "i"): [rng.randint(0, 6) for _ in range(30)] + [None], ("a", "d"): [float(rng.randint(0, 9)) for _ in range(31)],
        ("a", "s"): [rng.choice("012x") for _ in range(31)], ("a", "none"): [None] * 31,
        ("b", "j"): list(range(10)), ("b", "t"): ["0", "1", "2", "x", "y", None, "z", "n5", "q", "0"], ("b", "f"): [0.5 * i for i in range(10)],
    }
    frames = {
        "a": spark.createDataFrame(list(zip(*[v for (c, _), v in values.items() if c == "a"])), "i int, d double, s string, none double").withColumn("l", F.array("i")),
        "b": spark.createDataFrame(list(zip(*[v for (c, _), v in values.items() if c == "b"])), "j bigint, t string, f double").withColumn("m", F.col("f").cast("decimal(5,1)")),
    }
    values["b", "m"] = values["b", "f"]
    want = sorted(
        (*x, *y) for x, u in values.items() for y, v in values.items()
        if x != y and set(u) - {None} and isinstance(max(u, key=lambda z: z is not None), str) == isinstance(max(v, key=lambda z: z is not None), str) and set(u) - {None} <= set(v)
    )
    got = profile.all_inclusions(frames)
    assert sorted(map(tuple, got.collect())) == want and len(want) >= 6
    assert got.columns == ["container", "field", "ref_container", "ref_field"]
    assert profile.all_inclusions({"a": frames["a"].limit(0)}).count() == 0
