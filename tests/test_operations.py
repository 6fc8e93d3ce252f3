import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.operators import anomalies as an
from veriframe.operators import operations as op
from veriframe.operators.registry import Check, checks_frame
from veriframe.operators.scan import Container, ScanOptions, scan


@pytest.fixture
def world(spark):
    orders = spark.createDataFrame(
        [(i, None if i % 10 == 0 else i % 4, f"2024-01-{1 + i % 20:02d}") for i in range(40)], "id int, cust int, d string"
    ).withColumn("d", F.col("d").cast("timestamp_ntz"))
    customers = spark.createDataFrame([(1, "x"), (2, "y")], "cust int, name string")
    containers = {"orders": Container(orders, ["id"]), "customers": Container(customers, ["cust"])}
    registry = spark.createDataFrame(
        [("orders", ["daily"], "file"), ("customers", ["ref"], "file"), ("gone", ["daily"], "file")],
        "name string, tags array<string>, container_type string",
    )
    checks = checks_frame(
        spark,
        [Check("orders", "notNull", ["cust"]), Check("customers", "notNull", ["name"]),
         Check("orders", "existsIn", ["cust"], {"ref_container": "customers", "field_name": "cust"})],
    )
    none = spark.createDataFrame([], an.ANOMALY_COLUMNS)
    return containers, registry, checks, none


def statuses(df):
    return dict(rows(df.groupBy("status").count()))


def test_scan_lifecycle(spark, world):
    containers, registry, checks, none = world
    first = op.run_scan(spark, containers, registry, checks, none, "s1", "2024-02-01", tags=["daily"], enrichment_source_record_limit=3)
    missing = first.failures.filter("rule_type = 'existsIn'").count()
    assert statuses(first.anomalies) == {"Active": 4 + missing}
    assert first.anomalies.filter("source_enriched").count() == 3
    run = first.run.first()
    assert (run["containers_total"], run["containers_analyzed"], run["records_processed"], run["anomalies_identified"]) == (2, 1, 40, 4 + missing)
    # The data is repaired in part: what passes is resolved, the rest stays known.
    fixed = {**containers, "orders": Container(containers["orders"].df.withColumn("cust", F.coalesce("cust", F.lit(1))), ["id"])}
    second = op.run_scan(spark, fixed, registry, checks, first.anomalies, "s2", "2024-02-02")
    assert statuses(second.anomalies) == {"Active": missing, "Resolved": 4}
    off = op.run_scan(spark, fixed, registry, checks, first.anomalies, "s2", "2024-02-02", auto_resolve_passed_anomalies=False)
    assert statuses(off.anomalies) == {"Active": 4 + missing}


def test_rolled_up_scan_resolves_with_its_check(spark, world):
    containers, registry, checks, none = world
    first = op.run_scan(spark, containers, registry, checks, none, "s1", "2024-02-01", high_count_rollup_threshold=4)
    assert rows(first.anomalies.groupBy("rule_type", "anomaly_type").count()) == [
        ("existsIn", "shape", 1), ("notNull", "record", 4),
    ]
    again = op.run_scan(spark, containers, registry, checks, first.anomalies, "s2", "2024-02-02", high_count_rollup_threshold=4)
    assert again.anomalies.count() == 5 and statuses(again.anomalies) == {"Active": 5}


def test_incremental_scans_move_the_mark(spark, world):
    containers, registry, checks, none = world
    early = {**containers, "orders": Container(containers["orders"].df.filter("d <= '2024-01-10'"), ["id"])}
    fields = {"orders": "d"}
    first = op.run_scan(spark, early, registry, checks, none, "s1", "2024-02-01", incremental=True, incremental_fields=fields)
    assert rows(first.checkpoints) == [("orders", "d", "last-modified", "2024-01-10 00:00:00")]
    second = op.run_scan(
        spark, containers, registry, checks, first.anomalies, "s2", "2024-02-02", incremental=True,
        incremental_fields=fields, checkpoints=first.checkpoints,
    )
    assert second.run.first()["records_processed"] == 20 + 2
    assert rows(second.checkpoints, "high_water") == [("2024-01-20 00:00:00",)]
    # Both halves together are what one full scan finds, and nothing was resolved.
    full = op.run_scan(spark, containers, registry, checks, none, "s3", "2024-02-03")
    assert rows(second.anomalies, "fingerprint") == rows(full.anomalies, "fingerprint")
    assert set(statuses(second.anomalies)) == {"Active"}


def test_incremental_by_batch_number(spark, world):
    containers, registry, checks, none = world
    early = {**containers, "orders": Container(containers["orders"].df.filter("id < 25"), ["id"])}
    args = {"incremental": True, "incremental_fields": {"orders": "id"}, "names": ["orders"]}
    first = op.run_scan(spark, early, registry, checks, none, "s1", "2024-02-01", **args)
    assert rows(first.checkpoints) == [("orders", "id", "batch", "24")]
    second = op.run_scan(spark, containers, registry, checks, first.anomalies, "s2", "2024-02-02", checkpoints=first.checkpoints, **args)
    assert second.run.first()["records_processed"] == 15


def test_profile(spark, world):
    containers, registry, checks, none = world
    out = op.run_profile(spark, containers, registry, level="high", histogram_max_distinct_values=5, infer_as_draft=True)
    assert out.profiles.count() == 5
    uids = {r["check_uid"]: r["status"] for r in out.checks.collect()}
    assert uids["orders__unique__id"] == "Draft" and "customers__between__cust" in uids and "orders__notnull__cust" not in uids
    assert set(rows(out.histograms.select("container", "field").distinct())) == {("customers", "cust"), ("customers", "name"), ("orders", "cust")}
    assert out.quantiles.filter("container = 'orders' AND field = 'id' AND probability = 0.5").first()["value"] in (19.0, 20.0)
    assert out.correlations.count() == 0
    only = op.run_profile(spark, containers, registry, names=["customers"], level="low")
    assert rows(only.checks, "check_uid") == [("customers__notnull__cust",), ("customers__notnull__name",)]
    with pytest.raises(ValueError):
        op.run_profile(spark, containers, registry, tags=["nothing"])


def test_sync(spark, world):
    registry = world[1]
    found = spark.createDataFrame([("orders", "file"), ("fresh", "file")], "name string, container_type string")
    assert rows(op.run_sync(found, registry), "name") == [("customers",), ("fresh",), ("gone",), ("orders",)]
    assert rows(op.run_sync(found, registry, prune=True), "name", "tags") == [("fresh", None), ("orders", ["daily"])]
    assert rows(op.run_sync(found, registry, recreate=True), "name", "tags") == [("fresh", None), ("orders", None)]


def test_materialize_and_export(spark, world, tmp_path):
    containers, registry, checks, _ = world
    computed = {"by_cust": containers["orders"].df.groupBy("cust").count(), "other": registry.select("name")}
    out = op.run_materialize(computed, str(tmp_path), names=["by_cust"])
    assert list(out) == ["by_cust"] and out["by_cust"].count() == 5
    path = op.run_export({"checks": checks}, registry, "checks", str(tmp_path / "out"), tags=["ref"])
    assert spark.read.parquet(path).count() == 1


def big_world(spark, n=10):
    t = spark.range(n).selectExpr("id + 9007199254740990 as id", "cast(null as string) as v", "id % 2 as p")
    containers = {"t": Container(t, ["id"], ["p"], ["id"])}
    registry = spark.createDataFrame([("t", ["x"])], "name string, tags array<string>")
    return containers, registry, checks_frame(spark, [Check("t", "notNull", ["v"])]), spark.createDataFrame([], an.ANOMALY_COLUMNS)


def test_rollup_keeps_counts_and_open_anomalies(spark):
    world = big_world(spark)
    single = op.run_scan(spark, *world, "s1", "2024-02-01")
    rolled = op.run_scan(spark, *world[:3], single.anomalies, "s2", "2024-02-02", high_count_rollup_threshold=5)
    assert statuses(rolled.anomalies) == {"Active": 11}
    assert rows(rolled.anomalies.filter("anomaly_type = 'shape'"), "failing_rows") == [(10,)]
    again = op.run_scan(spark, *world[:3], rolled.anomalies, "s3", "2024-02-03", high_count_rollup_threshold=5)
    assert statuses(again.anomalies) == {"Active": 11}


def test_capped_scan_resolves_and_passes_nothing_unread(spark):
    world = big_world(spark)
    first = op.run_scan(spark, *world, "s1", "2024-02-01")
    capped = op.run_scan(
        spark, *world[:3], first.anomalies, "s2", "2024-02-02", max_records_analyzed_per_partition=1,
        incremental=True, incremental_fields={"t": "id"},
    )
    assert statuses(capped.anomalies) == {"Active": 10} and capped.checkpoints.count() == 0
    bare = {"t": Container(world[0]["t"].df, ["id"])}
    with pytest.raises(ValueError, match="records per partition"):
        op.run_scan(spark, bare, *world[1:], "s1", "2024-02-01", max_records_analyzed_per_partition=-2)
    dealt = op.run_scan(spark, bare, *world[1:], "s1", "2024-02-01", max_records_analyzed_per_partition=1)
    assert 0 < dealt.anomalies.count() <= 10  # dealt to parts by key, one record of each


def test_marks_keep_every_digit_and_rows_that_arrive_late(spark, tmp_path):
    containers, registry, checks, none = big_world(spark)
    path = str(tmp_path / "t")
    containers["t"].df.limit(0).unionByName(containers["t"].df.filter("id < 9007199254740995")).write.parquet(path)
    live = {"t": Container(spark.read.parquet(path), ["id"])}
    args = {"incremental": True, "incremental_fields": {"t": "id"}}
    first = op.run_scan(spark, live, registry, checks, none, "s1", "2024-02-01", **args)
    assert rows(first.checkpoints, "high_water") == [("9007199254740994",)]
    # Two rows arrive, one of them without a value; both are found next time.
    late = spark.createDataFrame([(9007199254740993 + 4, None, 1), (None, None, 1)], "id bigint, v string, p bigint")
    late.write.mode("append").parquet(path)
    live = {"t": Container(spark.read.parquet(path), ["id"])}
    second = op.run_scan(spark, live, registry, checks, first.anomalies, "s2", "2024-02-02", checkpoints=first.checkpoints, **args)
    assert second.run.first()["records_processed"] == 2 and rows(second.checkpoints, "high_water") == [("9007199254740997",)]
    assert second.anomalies.count() == 7
    given = op.run_scan(spark, live, registry, checks, none, "s3", "2024-02-03", incremental_fields={"t": "id"}, greater_than_batch={"t": 9007199254740992})
    assert given.run.first()["records_processed"] == 3 and statuses(given.anomalies) == {"Active": 3}


def test_references_by_name_and_datastore(spark):
    left = Container(spark.createDataFrame([(1,), (2,)], "k int"), ["k"])
    near, far = (Container(spark.createDataFrame([(k,)], "k int"), ["k"]) for k in (1, 2))
    containers = {"t": left, "ref": near, "other.ref": far}
    checks = checks_frame(spark, [
        Check("t", "existsIn", ["k"], {"ref_container_name": "ref", "field_name": "k"}),
        Check("t", "notExistsIn", ["k"], {"ref_container_name": "ref", "ref_datastore_name": "other", "field_name": "k"}),
    ])
    assert rows(scan(spark, containers, checks), "rule_type", "record_key") == [("existsIn", "2"), ("notExistsIn", "2")]
    lost = checks_frame(spark, [Check("t", "existsIn", ["k"], {"ref_container": "nowhere", "field_name": "k"})])
    with pytest.raises(ValueError, match="nowhere"):
        scan(spark, containers, lost)


def test_repeated_run_leaves_the_store_as_one_run(spark, tmp_path):
    world = big_world(spark)

    def stored(folder):
        def table(name):
            return spark.read.parquet(f"{tmp_path}/{folder}/p_{name}")

        return rows(table("anomalies"), "run_id", "check_uid", "record_key", "fingerprint"), rows(table("source_records"), "run_id", "fingerprint", "source_record")

    def run(folder, run_id, strategy="append"):
        op.run_scan(
            spark, *world, run_id, "2024-02-01", enrichment_source_record_limit=4, enrichment_root=f"{tmp_path}/{folder}", enrichment_prefix="p_",
            remediation_strategy=strategy,
        )

    run("once", "a/1")
    run("once", "b")
    for run_id in ("a/1", "b", "a/1", "b", "b"):
        run("often", run_id)
    assert stored("often") == stored("once")
    assert len(stored("once")[0]) == 20 and len(stored("once")[1]) == 8 and {r[0] for r in stored("once")[0]} == {"a/1", "b"}
    run("often", "c", "overwrite")
    assert {r[0] for r in stored("often")[1]} == {"c"} and len(stored("often")[0]) == 30
    with pytest.raises(ValueError, match="source record limit"):
        op.run_scan(spark, *world, "d", "2024-02-01", remediation_strategy="append")


@pytest.mark.parametrize("check", [
    Check("t", "notNull", ["v"]),
    Check("t", "notNull", ["id"]),  # never fails, as the optimizer knows
    Check("t", "notNull", ["v"], filter="1 = 0"),
    Check("t", "notNull", ["v"], filter="id < 0"),
])
@pytest.mark.parametrize("cap", [None, 2])
def test_the_pass_of_the_row_rules_counts_the_records(spark, check, cap):
    world = big_world(spark, 50)
    touched = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            touched.add(batch.num_rows)
            yield batch

    df = world[0]["t"].df
    containers = {"t": Container(df.mapInArrow(seen, df.schema).select("id", "v", F.expr("id % 2").alias("p")), ["id"], ["p"], ["id"])}
    out = op.run_scan(
        spark, containers, world[1], checks_frame(spark, [check, Check("t", "between", ["p"], {"min_value": -5})]), world[3], "s1", "2024-02-01",
        max_records_analyzed_per_partition=cap,
    )
    assert out.run.first()["records_processed"] == (50 if cap is None else 4)
    assert touched.value == 50 if cap is None else touched.value >= 50


def test_stored_containers_are_counted_by_their_footers(spark, tmp_path):
    spark.range(100).selectExpr("id", "id * 1.5D AS x").write.parquet(str(tmp_path / "t"))
    containers = {"t": Container(spark.read.parquet(str(tmp_path / "t")), ["id"], stored=True)}
    checks = checks_frame(spark, [Check("t", "between", ["x"], {"max_value": 140})])
    counts = {}
    plan = scan(spark, containers, checks, counts=counts)._jdf.queryExecution().executedPlan().toString()
    assert counts == {} and "PushedFilters: [IsNotNull(x), GreaterThan(x,140.0)]" in plan
    # Read in part, it is counted by the pass.
    scan(spark, containers, checks, ScanOptions(incremental_fields={"t": "id"}, greater_than_batch={"t": 3}), counts)
    assert list(counts) == ["t"]
    world = big_world(spark)
    out = op.run_scan(spark, containers, world[1], checks, world[3], "s1", "2024-02-01")
    assert out.run.first()["records_processed"] == 100


def test_containers_without_row_rules_are_counted(spark):
    containers, registry, _, none = big_world(spark)
    for checks in ([Check("t", "unique", ["v"])], [Check("t", "volumetric", [], {"min_rows": 1})], []):
        out = op.run_scan(spark, containers, registry, checks_frame(spark, checks), none, "s1", "2024-02-01")
        assert out.run.first()["records_processed"] == 10
