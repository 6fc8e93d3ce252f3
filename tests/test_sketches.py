import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.operators import profile, sketches
from veriframe.session import durable

EXACT = ["field", "type", "row_count", "null_count", "completeness", "min", "max", "min_length", "max_length", "pattern"]


@pytest.fixture
def data(spark):
    return spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 7 > 0, (F.col("id") * 7_919) % 5_003).cast("int").alias("k"),
        ((F.col("id") * 31) % 1_000 - 500).cast("double").alias("x"), (F.col("id").cast("decimal(10,0)") * F.lit(10 ** 15)).cast("decimal(38,0)").alias("d"),
        F.concat(F.lit("AB-"), F.lpad((F.col("id") % 90).cast("string"), 3, "0")).alias("s"),
        F.timestamp_seconds(F.col("id") * 60).alias("t"), (F.col("id") % 3 == 0).alias("b"), F.array("id").alias("a"),
        F.lit(None).cast("double").alias("none"),
    )


@pytest.mark.parametrize("parts", [[20_000], [0, 20_000], [1, 5_000, 5_001, 20_000]])
def test_merged_equals_full(spark, data, parts):
    stored, before = None, -1
    for upto in parts:
        stored = durable(sketches.profile_update(stored, data.filter(F.col("id") < upto), "c", "id", greater_than_batch=before))
        before = max(before, upto - 1)
    got, want = sketches.described(stored), profile.field_profile(data, "c", exact=True)
    assert rows(got, *EXACT) == rows(want, *EXACT)
    full = {r["field"]: r for r in want.collect()}
    for r in got.collect():
        w = full[r["field"]]
        assert abs(r["distinct_count"] - w["distinct_count"]) <= 4 * sketches.DISTINCT_ERROR * w["distinct_count"]
        for m in ("mean", "stddev"):
            assert r[m] == (None if w[m] is None else pytest.approx(w[m], rel=1e-9, abs=1e-9))
        if r["quantiles"]:
            col = F.col(r["field"]).cast("double")
            for p, q in zip((0.25, 0.5, 0.75), r["quantiles"]):
                below, upto = data.filter(col.isNotNull()).agg(F.avg((col < q).cast("int")), F.avg((col <= q).cast("int"))).first()
                assert below - 2 * sketches.RANK_ERROR <= p <= upto + 2 * sketches.RANK_ERROR
    assert {r["field"] for r in got.collect() if r["quantiles"]} == {"id", "k", "x", "d"}


def test_only_new_rows_are_read(spark, data, tmp_path):
    data.write.partitionBy("b").parquet(str(tmp_path / "rows"))
    table = spark.read.parquet(str(tmp_path / "rows"))
    stored = durable(sketches.profile_state(table.filter("id < 19000"), "c", ["k"]))
    plan = sketches.profile_update(stored, table, "c", "id", greater_than_batch=18_999, fields=["k"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,18999)" in plan and "ReadSchema: struct<id:bigint,k:int>" in plan and plan.count("PushedFilters: [IsNotNull(id)") == 1


def test_other_containers_and_changed_types(spark, data):
    stored = sketches.profile_state(data.select("x"), "other").unionByName(sketches.profile_state(data.select("k"), "c"))
    out = sketches.described(sketches.profile_update(stored, data.select(F.col("k").cast("bigint").alias("k")), "c"))
    assert rows(out, "container", "field", "type", "row_count") == [("c", "k", "bigint", 20_000), ("c", "k", "int", 20_000), ("other", "x", "double", 20_000)]


def test_numbers_are_ordered_as_numbers(spark):
    parts = [spark.createDataFrame([(v, f)], "v bigint, f double") for v, f in ((9, 9.5), (10, 1e300), (-3, -0.25), (2**62 + 1, 2.0), (2**62, 7.0))]
    states = None
    for p in parts:
        states = sketches.profile_update(states, p, "c")
    assert rows(sketches.described(states), "field", "min", "max") == [("f", "-0.25", "1.0E300"), ("v", "-3", str(2**62 + 1))]


def test_nan_only(spark):
    df = spark.createDataFrame([(float("nan"),), (None,)], "x double")
    (r,) = sketches.described(sketches.profile_state(df, "c")).collect()
    assert r["quantiles"] is None and r["null_count"] == 1
