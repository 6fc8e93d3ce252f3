import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe import session as vs
from veriframe.functions import skew
from veriframe.operators.profile import profile_incremental
from veriframe.sources import bounds, discover, readers, sampling, sinks


def test_file_scan_empties(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('a;b;c\n1;;x\n2;"";"y;z"\n3;3.5;\n')
    out = readers.file_scan(spark, str(path), delimiter=";")
    assert rows(out) == [("1", None, "x"), ("2", None, "y;z"), ("3", "3.5", None)]
    out = readers.file_scan(spark, str(path), delimiter=";", empty_as_null=False)
    assert rows(out) == [("1", "", "x"), ("2", "", "y;z"), ("3", "3.5", "")]
    out = readers.file_scan(spark, str(path), delimiter=";", infer=True)
    assert dict(out.dtypes) == {"a": "bigint", "b": "double", "c": "string"}


def test_file_scan_header_escape_schema(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('1,"a\\"b"\n')
    assert rows(readers.file_scan(spark, str(path), has_header=False, escape="\\")) == [("1", 'a"b')]
    out = readers.file_scan(spark, str(path), has_header=False, escape="\\", schema="n int, t string")
    assert rows(out) == [(1, 'a"b')]


def test_jdbc_options():
    assert readers.jdbc_options("t", fetch_size=100) == {"dbtable": "t", "fetchsize": "100"}
    out = readers.jdbc_options("t", {"lower": 1, "upper": 90}, "id", 50, 8)
    assert out == {
        "dbtable": "t", "fetchsize": "50", "partitionColumn": "id", "lowerBound": "1", "upperBound": "90", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        readers.jdbc_options("t", None, "id", None, 8)


def test_discover_files(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "big.parquet"))
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "tmp_x.parquet"))
    (tmp_path / "notes.txt").write_text("no container")
    out = discover.discover_files(spark, str(tmp_path), exclude_prefixes=["tmp_"])
    row = out.first()
    assert out.count() == 1 and row["name"] == "big" and row["files"] >= 1 and row["bytes"] > 0
    assert discover.discover_files(spark, str(tmp_path), exclude=["big", "tmp_x"]).count() == 0
    assert discover.discover_files(spark, str(tmp_path), include=["table"]).count() == 0


def test_discover_tables(spark):
    spark.range(1).createOrReplaceTempView("a_view")
    out = discover.discover_tables(spark, "default")
    assert ("a_view", "view") in rows(out, "name", "container_type")
    assert discover.discover_tables(spark, "default", exclude=["default", ""]).count() == 0


def test_sync_diff(spark):
    found = spark.createDataFrame([("a",), ("b",)], "name string")
    known = spark.createDataFrame([("b",), ("c",)], "name string")
    assert rows(discover.sync_diff(found, known)) == [("a", "new", "create"), ("b", "kept", "keep"), ("c", "missing", "keep")]
    assert [r[2] for r in rows(discover.sync_diff(found, known, prune=True))] == ["create", "keep", "drop"]
    assert [r[2] for r in rows(discover.sync_diff(found, known, recreate=True))] == ["create", "recreate", "drop"]


def test_partition_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(None,)], "v double")
    assert rows(bounds.partition_bounds(df, "v")) == [(0, 0.0, 3.0, 3), (1, 3.0, 6.0, 3), (2, 6.0, 9.0, 4)]
    assert sum(r[3] for r in rows(bounds.partition_bounds(df, "v", 7))) == 10
    one = spark.createDataFrame([(5,), (5,)], "v int")
    assert rows(bounds.partition_bounds(one, "v")) == [(0, 5.0, 5.0, 2), (1, 5.0, 5.0, 0), (2, 5.0, 5.0, 0)]
    when = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-01', TIMESTAMP_NTZ'2024-01-10', INTERVAL 1 DAY)) AS d")
    assert [r[3] for r in rows(bounds.partition_bounds(when, "d"))] == [3, 3, 4]


def test_schema_only(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert bounds.schema_only(df).count() == 0 and bounds.schema_only(df).schema == df.schema
    assert rows(bounds.schema_rows(df)) == [(1, "a", "int", True), (2, "b", "string", True)]


def test_sampling_does_not_depend_on_layout(spark):
    df = spark.range(5000)
    a = rows(sampling.table_sample(df, 20, 3, ["id"]))
    assert a == rows(sampling.table_sample(df.repartition(7, F.rand(1)), 20, 3, ["id"])) and 850 < len(a) < 1150
    assert a != rows(sampling.table_sample(df, 20, 4, ["id"]))
    assert 850 < sampling.table_sample(df, 20, 1).count() < 1150
    v = rows(sampling.view_sample(df, 10, ["id"]))
    assert len(v) == 10 and v == rows(sampling.view_sample(df.repartition(3), 10, ["id"]))
    assert sampling.view_sample(df, 9999, ["id"]).count() == 5000


def test_cap(spark):
    df = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1)], "p string, i int")
    assert rows(sampling.cap_per_partition(df, 2, ["p"], ["i"])) == [("a", 0), ("a", 1), ("b", 1)]
    assert sampling.cap_per_partition(df, -1, ["p"], ["i"]) is df
    assert sampling.cap_per_partition(df, None, ["p"], ["i"]) is df
    assert sampling.cap_per_partition(df, 0, ["p"], ["i"]).count() == 0
    with pytest.raises(ValueError):
        sampling.cap_per_partition(df, -2, ["p"], ["i"])
    plan = sampling.cap_per_partition(df, 2, ["p"], ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.fixture
def low_limit(monkeypatch):
    """Caps above three records are cut by ranges."""
    monkeypatch.setattr(sampling, "DIRECT", 3)


def ranked(data, n):
    groups = {}
    for p, i, v in data:
        groups.setdefault(p, []).append((i, v))
    return sorted(((p, *r) for p, g in groups.items() for r in sorted(g)[:n]), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("n", [2, 7, 500, 2_999, 5_000])
def test_cap_of_a_hot_group(spark, low_limit, no_broadcast, n):
    data = [("hot" if i % 3 else None if i % 2 else f"p{i % 40}", (i * 7_919) % 6_007, i) for i in range(6_000)]
    df = spark.createDataFrame(data, "`p.q` string, i int, v int").repartition(7)
    got = rows(sampling.cap_per_partition(df, n, ["p.q"], ["i", "v"]), "`p.q`", "i", "v")
    assert got == ranked(data, n)


def test_hot_group_is_ranked_in_its_cut_range_only(spark, monkeypatch):
    """Four ranges of one group: two pass whole, one is cut, one is left out."""
    seen = []
    real = skew.durable
    monkeypatch.setattr(skew, "durable", lambda df, label: seen.append((label, real(df, label))) or seen[-1][1])
    df = spark.range(0, 40_000, 1, 8).select(F.lit("a").alias("g"), F.col("id").alias("i"))
    conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = skew.first_in_group(df, ["g"], ["i"], 25_000)
        assert kept.agg(F.count("*"), F.max("i")).first() == (25_000, 24_999)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", conf)
    sizes = [r["_m"] for r in dict(seen)["wanted_ranges"].collect()]
    assert len(sizes) == 3 and max(sizes) < 2 * 10_000


def test_cap_without_partition_columns(spark):
    df = spark.range(4_000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("v"))
    got = sampling.cap_per_partition(df, 3, keys=["k"])
    assert got.columns == df.columns and got.count() == 3 * sampling.SPLIT
    assert rows(got) == rows(sampling.cap_per_partition(df.repartition(9), 3, keys=["k"]))
    assert sampling.cap_per_partition(df, 2_000, keys=["k"]).count() == 4_000
    assert rows(sampling.cap_per_partition(df, 1, order_cols=["k"], keys=["v"])) == [(i, i) for i in range(5)]
    profile = profile_incremental(df, "t", max_records_per_partition=3)
    assert {r["row_count"] for r in profile.collect()} == {3 * sampling.SPLIT}
    with pytest.raises(ValueError):
        profile_incremental(df, "t", max_records_per_partition=-2)


def test_incremental(spark):
    df = spark.sql("SELECT id, timestampadd(DAY, id, TIMESTAMP_NTZ'2024-01-01') AS ts FROM range(10)")
    assert readers.incremental_filter(df, "ts", greater_than_time="2024-01-08T00:00:00").count() == 2
    assert readers.incremental_filter(df, "id", greater_than_batch=6).count() == 3
    first = readers.next_checkpoint(df.filter("id < 4"), "t", "ts")
    assert first.first()["high_water"] == "2024-01-04 00:00:00"
    rest = readers.read_past_checkpoint(df, "ts", first)
    assert rest.count() == 6
    second = readers.next_checkpoint(rest, "t", "ts", previous=first)
    assert readers.read_past_checkpoint(df, "ts", second).count() == 0
    # Nothing new, or older data only: the mark does not move back.
    for data in (df.filter("false"), df.filter("id < 2")):
        assert readers.next_checkpoint(data, "t", "ts", previous=second).first()["high_water"] == "2024-01-10 00:00:00"
    none = readers.next_checkpoint(df.filter("false"), "t", "id", "batch")
    assert none.first()["high_water"] is None and readers.read_past_checkpoint(df, "id", none).count() == 10


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("t", 1), ("t", 2), ("u", 3)], "container string, v int")
    out = sinks.materialize(df, str(tmp_path / "m"), 1, ["container"], ["v"])
    assert rows(out) == [("t", 1), ("u", 3)]
    paths = sinks.enrichment_write(df, str(tmp_path / "e"), "p_", "none", df)
    assert not (tmp_path / "e" / "p_source_records").exists()
    for strategy in ("append", "append"):
        sinks.enrichment_write(df, str(tmp_path / "e"), "p_", strategy, df)
    assert spark.read.parquet(paths["source_records"]).count() == 6
    sinks.enrichment_write(df, str(tmp_path / "e"), "p_", "overwrite", df.limit(1))
    assert spark.read.parquet(paths["source_records"]).count() == 1
    assert spark.read.parquet(paths["anomalies"]).count() == 12
    with pytest.raises(ValueError):
        sinks.enrichment_write(df, str(tmp_path / "e"), "p_", "replace", df)


def test_export(spark):
    containers = spark.createDataFrame([("t", ["x"]), ("u", None)], "name string, tags array<string>")
    checks = spark.createDataFrame([("t", False), ("t", True), ("u", None)], "container string, archived boolean")
    assets = {"checks": checks, "profiles": checks.select("container")}
    assert sinks.export_assets(assets, containers, "checks").count() == 2
    assert sinks.export_assets(assets, containers, "checks", include_deleted=True).count() == 3
    assert sinks.export_assets(assets, containers, "checks", tags=["x", "z"]).count() == 1
    assert sinks.export_assets(assets, containers, "profiles", container_names=["u"]).count() == 1
    with pytest.raises(ValueError):
        sinks.export_assets(assets, containers, "users")


def test_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        value = None

        def get(self, key, default=None):
            return self.value or default

    class Fake:
        conf = Conf()

        class sparkContext:
            master = "yarn"
            applicationId = "app"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        vs.shared_dir(Fake())
    Conf.value = "hdfs://shared/ck"
    assert vs.shared_dir(Fake()) == "hdfs://shared/ck"
    assert vs.scratch(Fake(), "x").startswith("hdfs://shared/ck/veriframe/x-")
