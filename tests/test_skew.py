from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.functions import skew


@pytest.fixture
def skewed(spark):
    """A third of the rows share key 7, another group is null."""
    data = [(i, 7 if i % 3 == 0 else (None if i % 11 == 0 else i % 50), f"v{i % 5}") for i in range(3000)]
    return spark.createDataFrame(data, "id int, k int, v string").repartition(8), data


@pytest.fixture(params=[True, False], ids=["adaptive", "salted"])
def adaptive(request, spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", str(request.param).lower())
    yield request.param
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_membership_equals_brute_force(spark, skewed, no_broadcast, adaptive):
    df, data = skewed
    ref = spark.createDataFrame([(7,), (7,), (9,), (None,), (13,)], "r int")
    members = {7, 9, 13}
    inside = skew.rows_by_membership(df, ["k"], ref, ["r"], present=True)
    outside = skew.rows_by_membership(df, ["k"], ref, ["r"], present=False)
    assert rows(inside, "id") == sorted([(i,) for i, k, _ in data if k in members], key=lambda r: (False, str(r[0])))
    want = [(i,) for i, k, _ in data if k is not None and k not in members]
    assert Counter(rows(outside, "id")) == Counter(want)
    assert inside.columns == df.columns


def test_membership_broadcast_path_agrees(spark, skewed):
    df, data = skewed
    ref = spark.createDataFrame([(7,), (9,)], "r int")
    got = skew.rows_by_membership(df, ["k"], ref, ["r"], present=False)
    assert got.count() == sum(1 for _, k, _ in data if k is not None and k not in (7, 9))


def test_attach_spreads_the_hot_key(spark, skewed, no_broadcast):
    df, data = skewed
    counts = skew.key_counts(df, ["k"])
    out = skew.attach(df.filter("k IS NOT NULL"), counts, ["k"])
    sizes = Counter(k for _, k, _ in data if k is not None)
    assert out.count() == sum(sizes.values())
    assert out.filter(F.col("_n") != F.expr("CASE k WHEN 7 THEN %d ELSE _n END" % sizes[7])).count() == 0


def test_attach_keep_drops_hot_keys(spark, skewed, no_broadcast):
    df, data = skewed
    counts = skew.key_counts(df, ["k"]).withColumn("_keep", F.col("k") != 7)
    out = skew.attach(df.filter("k IS NOT NULL"), counts, ["k"], keep="_keep")
    assert out.count() == sum(1 for _, k, _ in data if k is not None and k != 7)


def test_lookup_keeps_every_row(spark, skewed, no_broadcast, adaptive):
    df, data = skewed
    ref = spark.createDataFrame([(7, "seven"), (8, "eight")], "r int, name string")
    out = skew.lookup(df, ["k"], ref, ["r"])
    names = {7: "seven", 8: "eight"}
    assert Counter(rows(out, "id", "name")) == Counter((i, names.get(k)) for i, k, _ in data)


def test_lookup_null_is_no_key(spark, no_broadcast, adaptive):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, k int")
    ref = spark.createDataFrame([(None, "x"), (5, "y")], "r int, name string")
    assert rows(skew.lookup(df, ["k"], ref, ["r"]), "id", "name") == [(1, None), (2, "y")]


@pytest.mark.parametrize("range_bytes", [1 << 30, 1000])
def test_group_index(spark, monkeypatch, tmp_path, range_bytes):
    monkeypatch.setattr(skew, "RANGE_BYTES", range_bytes)
    data = [(("hot" if i % 3 else f"g{i % 7}"), (i * 7919) % 10007) for i in range(2000)]
    spark.createDataFrame(data, "g string, at int").repartition(6).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = rows(skew.group_index(df, ["g"], ["at"], "n"), "g", "at", "n")
    want = []
    for g in {g for g, _ in data}:
        want += [(g, at, n) for n, at in enumerate(sorted(a for h, a in data if h == g), 1)]
    assert Counter(out) == Counter(want)


def test_running_total(spark):
    data = [("a" if i % 4 else "b", i, i % 5) for i in range(500)]
    df = spark.createDataFrame(data, "g string, at int, m int").repartition(5)
    out = rows(skew.running_total(df, ["g"], "at", "m", "t"), "g", "at", "t")
    want, total = [], Counter()
    for g, at, m in data:
        total[g] += m
        want.append((g, at, total[g]))
    assert Counter(out) == Counter(want)


def test_group_index_of_nothing(spark):
    df = spark.createDataFrame([], "g string, at int")
    assert skew.group_index(df, ["g"], ["at"], "n").count() == 0


def test_hot_key_is_read_by_many_tasks(spark, monkeypatch):
    """A third of the rows on one key: no task gets more than a fraction of them."""
    monkeypatch.setattr(skew, "SLOTS", 40)
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        df = spark.range(0, 30000, 1, 32).selectExpr("id", "IF(id % 3 = 0, -1, id) AS k")
        counts = skew.key_counts(df, ["k"])
        out = skew.attach(df, counts, ["k"]).groupBy(F.spark_partition_id().alias("p")).count()
        sizes = [r["count"] for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 30000 and max(sizes) < 4000


@pytest.mark.parametrize("n", [1, 50, 400, 5000])
def test_first_by_hash(spark, monkeypatch, n):
    """Also with a third of the rows being copies, which share one hash."""
    monkeypatch.setattr(skew, "DIRECT_TOP", 20)
    monkeypatch.setattr(skew, "HASH_DIGITS", 2)
    df = spark.range(1200).selectExpr("md5(CAST(IF(id % 3 = 0, -1, id) AS STRING)) AS h").repartition(5)
    want = sorted(r["h"] for r in df.collect())[:n]
    assert sorted(r["h"] for r in skew.first_by_hash(df, "h", n).collect()) == want


@pytest.fixture
def small_splits(spark, no_broadcast):
    """Adaptive execution takes anything above a few kilobytes for skew."""
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in keys if spark.conf.get(k, None) is not None}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)
        if k in before:
            spark.conf.set(k, before[k])


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_hot_keys_are_split_at_run_time(spark, small_splits):
    df = spark.range(0, 60000, 1, 16).selectExpr("id", "IF(id % 3 = 0, -1, id) AS k")
    ref = spark.range(0, 60000, 2, 4).selectExpr("IF(id % 3 = 0, -1, id) AS r")
    for present in (True, False):
        out = skew.rows_by_membership(df, ["k"], ref, ["r"], present)
        assert "skew=true" in final_plan(out)
    out = skew.lookup(df, ["k"], ref.groupBy("r").agg(F.count("r").alias("c")), ["r"])
    assert "skew=true" in final_plan(out)
    assert out.count() == 60000


def test_input_bytes(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert 0 < skew.input_bytes(df) < 10_000
    assert skew.input_bytes(df.crossJoin(df.withColumnRenamed("id", "b"))) == 2 * skew.input_bytes(df)
    assert skew.input_bytes(spark.createDataFrame([(1,)], "a int")) is None


def test_lookups_read_their_input_once(spark, no_broadcast, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, id % 7) as k").write.parquet(path)
    df = spark.read.parquet(path)
    ref = spark.createDataFrame([(i, f"v{i}") for i in range(4)], "k bigint, v string")
    out = df
    for i in range(3):
        out = skew.lookup(out, ["k"], ref.selectExpr("k", f"v as v{i}"), ["k"])
    out = skew.rows_outside(out, ["k"], ref.filter("k = 1"), ["k"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
    assert out.count() == 1000 - sum(i % 3 != 0 and i % 7 == 1 for i in range(1000))
    assert out.filter("k is null").count() == 334 and out.filter("v2 is not null").count() == sum(
        i % 3 != 0 and i % 7 in (0, 2, 3) for i in range(1000)
    )
    # Rows without a key are spread, not gathered.
    spread = df.withColumn("_apart", skew._apart(["k"])).repartition(50).filter("k is null")
    assert spread.select("_apart").distinct().count() >= 1
