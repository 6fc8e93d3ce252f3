import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.functions.keys import fingerprint
from veriframe.operators import anomalies as an
from veriframe.operators import observe


def failures(spark, *pairs):
    df = spark.createDataFrame(
        [(c, "t", "notNull", "record", k, "m") for c, k in pairs],
        "check_uid string, container string, rule_type string, anomaly_type string, record_key string, message string",
    )
    return df.withColumn("fingerprint", fingerprint(F.col("check_uid"), F.col("record_key")))


@pytest.fixture
def stored(spark):
    return an.new_anomalies(failures(spark, ("c1", "1"), ("c1", "2"), ("c2", "1"), ("c1", "1")), "s1", "2024-01-01 00:00:00")


def checks(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "check_uid string")


def test_copies_are_one_anomaly(stored):
    assert rows(stored, "check_uid", "record_key", "failing_rows") == [("c1", "1", 2), ("c1", "2", 1), ("c2", "1", 1)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_auto_resolve(spark, stored, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    now = failures(spark, ("c1", "1"))
    once = an.auto_resolve(stored, now, checks(spark, "c1"))
    want = [("c1", "1", "Active", False), ("c1", "2", "Resolved", True), ("c2", "1", "Active", False)]
    pick = ["check_uid", "record_key", "status", "archived"]
    assert rows(once, *pick) == want
    assert rows(an.auto_resolve(once, now, checks(spark, "c1")), *pick) == want


def test_auto_resolve_off(spark, stored):
    now, all_checks = failures(spark, ("x", "9")), checks(spark, "c1", "c2")
    assert an.auto_resolve(stored, now, all_checks, incremental=True) is stored
    assert an.auto_resolve(stored, now, all_checks, incremental=True, enabled=True) is stored
    assert an.auto_resolve(stored, now, all_checks, enabled=False) is stored
    assert an.auto_resolve(stored, now, all_checks).filter("status = 'Resolved'").count() == 3


def test_acknowledged_is_open_and_archived_stays(spark, stored):
    acknowledged = stored.withColumn("status", F.lit("Acknowledged"))
    out = an.auto_resolve(acknowledged, failures(spark), checks(spark, "c1", "c2"))
    assert {r["status"] for r in out.collect()} == {"Resolved"}
    invalid = stored.withColumns({"status": F.lit("Invalid"), "archived": F.lit(True)})
    out = an.auto_resolve(invalid, failures(spark), checks(spark, "c1", "c2"))
    assert {r["status"] for r in out.collect()} == {"Invalid"}


def test_merge_reopens_as_new_row(spark, stored):
    gone = an.auto_resolve(stored, failures(spark, ("c1", "1")), checks(spark, "c1", "c2"))
    back = an.merge_failures(gone, failures(spark, ("c1", "1"), ("c1", "2"), ("c3", "5")), "s2", "2024-01-02 00:00:00")
    assert rows(back, "check_uid", "record_key", "status", "scan_id") == [
        ("c1", "1", "Active", "s1"), ("c1", "2", "Active", "s2"), ("c1", "2", "Resolved", "s1"),
        ("c2", "1", "Resolved", "s1"), ("c3", "5", "Active", "s2"),
    ]
    assert back.select("id").distinct().count() == 5
    again = an.merge_failures(back, failures(spark, ("c1", "1"), ("c1", "2")), "s3", "2024-01-03 00:00:00")
    assert again.count() == 5


@pytest.mark.parametrize("hot", [False, True])
def test_rollup(spark, hot, request):
    if hot:
        request.getfixturevalue("no_broadcast")
    f = failures(spark, *[("big", str(i)) for i in range(60)], ("small", "1"), ("small", "2")).repartition(4)
    out = an.high_count_rollup(f, 2)
    assert rows(out, "check_uid", "anomaly_type", "record_key", "failing_rows") == [
        ("big", "shape", None, 60), ("small", "record", "1", 1), ("small", "record", "2", 1),
    ]


def test_enrich(spark, stored):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    out = an.enrich_source_records(stored, {"t": (df, ["id"])}, 10)
    assert rows(out, "check_uid", "record_key", "source_enriched", "source_record") == [
        ("c1", "1", True, '{"id":1,"v":"a"}'), ("c1", "2", True, '{"id":2,"v":"b"}'), ("c2", "1", True, '{"id":1,"v":"a"}'),
    ]
    assert an.enrich_source_records(stored, {"t": (df, ["id"])}, 1).filter("source_enriched").count() == 1
    with pytest.raises(ValueError):
        an.enrich_source_records(stored, {"t": (df, ["id"])}, 0)


def test_list_statuses(spark, stored):
    marked = stored.withColumns(
        {"status": F.expr("CASE record_key WHEN '2' THEN 'Invalid' ELSE status END"), "archived": F.col("record_key") == "2"}
    )
    assert an.anomaly_list(marked).count() == 2
    assert rows(an.anomaly_list(marked, statuses=["Invalid"]), "record_key") == [("2",)]
    assert an.anomaly_list(marked, statuses=["Invalid", "Active"]).count() == 3
    assert an.anomaly_list(marked, statuses=["Active"]).count() == 2
    assert an.anomaly_list(marked, statuses=["Resolved"]).count() == 0
    assert an.anomaly_list(marked, end_date="2024-01-01", start_date="2024-01-01").count() == 2
    assert an.anomaly_list(marked, start_date="2024-01-02").count() == 0
    assert an.anomaly_list(marked, source_enriched=True).count() == 0


def test_update_keeps_clears_and_rejects(spark, stored):
    ids = {tuple(r)[:2]: r["id"] for r in stored.select("check_uid", "record_key", "id").collect()}
    updates = spark.createDataFrame(
        [(ids["c1", "1"], "Acknowledged", None, ["x"], [7]), (ids["c1", "2"], "Resolved", "no", None, None)],
        "id string, status string, description string, tags array<string>, assignee_ids array<int>",
    )
    out = an.anomaly_update(stored, updates)
    assert rows(out, "check_uid", "record_key", "status", "description", "tags", "assignee_ids") == [
        ("c1", "1", "Acknowledged", None, ["x"], [7]), ("c1", "2", "Active", None, [], []), ("c2", "1", "Active", None, [], []),
    ]
    assert an.rejected_updates(updates).count() == 1
    clear = updates.limit(1).withColumn("assignee_ids", F.array().cast("array<int>")).withColumn("tags", F.lit(None).cast("array<string>"))
    again = an.anomaly_update(out, clear)
    assert rows(again.filter("record_key = '1' AND check_uid = 'c1'"), "tags", "assignee_ids") == [(["x"], [])]


def test_archive_and_delete(spark, stored):
    some = stored.filter("check_uid = 'c1'").select("id")
    assert an.anomaly_archive(stored, some).filter("archived AND status = 'Resolved'").count() == 2
    assert an.anomaly_archive(stored, some, "Duplicate").filter("status = 'Duplicate'").count() == 2
    with pytest.raises(ValueError):
        an.anomaly_archive(stored, some, "Active")
    assert rows(an.anomaly_delete(stored, some), "check_uid") == [("c2",)]


def test_scores(spark):
    df = spark.createDataFrame(
        [("t", "notNull", 10, 1), ("t", "notNull", 10, 0), ("t", "existsIn", 4, 1), ("t", "isReplicaOf", 4, 0), ("u", "mystery", 1, 1)],
        "container string, rule_type string, checked int, failed int",
    )
    out = {r["container"]: r for r in observe.quality_scores(df).collect()}
    assert out["t"]["completeness"] == pytest.approx(95) and out["t"]["consistency"] == pytest.approx(87.5)
    assert out["t"]["overall"] == pytest.approx(91.25) and out["t"]["volume"] is None
    assert out["u"]["overall"] is None


def test_latest_measurement_and_freshness(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01", 1), ("a", "2024-01-03", 2), ("b", "2024-01-02", 3)], "container string, measured_at string, v int"
    ).withColumn("measured_at", F.col("measured_at").cast("timestamp_ntz"))
    assert rows(observe.latest_measurement(df), "container", "v") == [("a", 2), ("b", 3)]
    assert observe.freshness(df, "measured_at", "2024-01-03 00:01:00").first()["lag_seconds"] == 60
    assert rows(observe.null_check(df.withColumn("v", F.expr("nullif(v, 2)")), ["v", "container"])) == [("container", 3, 0), ("v", 3, 1)]
