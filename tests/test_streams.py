import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.operators.registry import Check, checks_frame
from veriframe.operators.scan import Container, scan
from veriframe.streaming import streams


def events(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ts string, k string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@pytest.fixture
def folder(spark, tmp_path):
    """Four files, read one per batch in order of their times."""
    path = str(tmp_path / "in")
    for batch in (
        [("2024-01-01 00:10:00", "a"), ("2024-01-01 00:20:00", "a"), ("2024-01-01 01:05:00", None)],
        [("2024-01-01 04:00:00", "b")],
        [("2024-01-01 05:00:00", "d")],
        # Long after the watermark: dropped by windows, still scanned.
        [("2024-01-01 00:30:00", "a"), ("2024-01-01 09:00:00", "c")],
    ):
        events(spark, *batch).coalesce(1).write.mode("append").parquet(path)
    return path


def finish(spark, result, tmp_path, name):
    out = str(tmp_path / name)
    streams.run_to_files(result, out, str(tmp_path / f"{name}-offsets")).awaitTermination()
    return spark.read.schema(result.schema).parquet(out)


def test_stream_scan_equals_batch_scan(spark, folder, tmp_path):
    checks = checks_frame(spark, [Check("e", "notNull", ["k"]), Check("e", "matchesPattern", ["k"], {"pattern": "[bcd]"})])
    batch = scan(spark, {"e": Container(spark.read.parquet(folder), ["ts"])}, checks)
    live = finish(spark, streams.stream_scan(streams.stream_container(spark, folder, 1), "e", ["ts"], checks), tmp_path, "scan")
    assert rows(live, "check_uid", "fingerprint") == rows(batch, "check_uid", "fingerprint")
    assert live.count() == 4


REFERENCE_CHECKS = [
    Check("e", "notNull", ["k"]), Check("e", "existsIn", ["k"], {"ref_container": "ref", "field_name": "r"}),
    Check("e", "notExistsIn", ["k"], {"ref_container": "ref", "field_name": "r"}, filter="ts > '2024-01-01 00:15:00'"),
]


@pytest.mark.parametrize("size", ["10485760", "-1"], ids=["broadcast", "shuffled"])
def test_reference_rules_equal_batch_scan(spark, folder, tmp_path, size):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    try:
        ref = Container(spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "r string"))
        checks = checks_frame(spark, REFERENCE_CHECKS)
        batch = scan(spark, {"e": Container(spark.read.parquet(folder), ["ts"]), "ref": ref}, checks)
        stream = streams.stream_container(spark, folder, 1)
        live = finish(spark, streams.stream_scan(stream, "e", ["ts"], checks, {"ref": ref}), tmp_path, "scan")
        assert rows(live, "check_uid", "record_key", "fingerprint") == rows(batch, "check_uid", "record_key", "fingerprint")
        assert live.count() == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_batches_see_references_anew(spark, folder, tmp_path):
    """A value joins the reference after the first batch; row counts are judged batch by batch."""
    checks = checks_frame(spark, [Check("e", "existsIn", ["k"], {"ref_container": "ref", "field_name": "r"}), Check("e", "volumetric", [], {"min_rows": 2})])
    known, got = [("a",)], []

    def sink(failures, batch_id):
        got.append(rows(failures, "check_uid", "record_key", "message"))
        known.append(("b",))

    streams.scan_batches(
        streams.stream_container(spark, folder, 1), "e", ["ts"], checks, str(tmp_path / "offsets"), sink,
        lambda: {"ref": Container(spark.createDataFrame(known, "r string"))},
    ).awaitTermination()
    assert [[m for _, _, m in b] for b in got] == [[], ["row count 1"], ["existsIn failed on k", "row count 1"], ["existsIn failed on k"]]


def test_volume_drops_late_rows(spark, folder, tmp_path):
    stream = streams.stream_container(spark, folder, 1)
    out = finish(spark, streams.stream_volume(stream, "ts", "1 hour", "30 minutes"), tmp_path, "volume")
    got = rows(out.select(F.date_format("window_start", "HH:mm").alias("w"), "row_count"))
    assert got == [("00:00", 2), ("01:00", 1), ("04:00", 1), ("05:00", 1)]


def test_stream_unique(spark, folder, tmp_path):
    stream = streams.stream_container(spark, folder, 1)
    out = finish(spark, streams.stream_unique(stream, ["k"], "ts", "1 hour", "30 minutes"), tmp_path, "unique")
    assert rows(out, "k", "occurrences") == [("a", 2)]


def test_batches_are_written_once(spark, folder, tmp_path):
    checks = checks_frame(spark, [Check("e", "notNull", ["k"]), Check("e", "matchesPattern", ["k"], {"pattern": "b"})])
    failures = streams.stream_scan(streams.stream_container(spark, folder, 1), "e", ["ts"], checks)
    path, offsets = str(tmp_path / "sink"), str(tmp_path / "offsets")
    for _ in range(2):
        streams.write_batches(failures, path, offsets).awaitTermination()
    assert spark.read.parquet(path).count() == 6
    # New file: only it is read.
    events(spark, ("2024-01-02 00:00:00", None)).coalesce(1).write.mode("append").parquet(folder)
    streams.write_batches(failures, path, offsets).awaitTermination()
    assert spark.read.parquet(path).count() == 7
    # All offsets lost: a replay from the start overwrites its own batches.
    streams.write_batches(failures, path, str(tmp_path / "offsets2")).awaitTermination()
    assert spark.read.parquet(path).select("fingerprint").distinct().count() == 7


def test_single_file_container(spark, folder):
    import glob

    one = sorted(glob.glob(f"{folder}/*.parquet"))[0]
    assert streams.stream_container(spark, one).isStreaming


def test_checks_a_stream_cannot_run_are_refused(spark):
    import pytest
    from veriframe.operators.registry import Check, checks_frame
    from veriframe.streaming.streams import scan_batches, stream_scan

    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="unique"):
        stream_scan(df, "t", ["k"], checks_frame(spark, [Check("t", "notNull", ["k"]), Check("t", "unique", ["k"])]))
    with pytest.raises(ValueError, match="nothing"):
        stream_scan(df, "t", ["k"], checks_frame(spark, [Check("u", "notNull", ["k"])]))
    with pytest.raises(ValueError, match="isreplicaof"):
        scan_batches(df, "t", ["k"], checks_frame(spark, [Check("t", "isReplicaOf", ["k"], {"ref_container": "u"})]), "", None)
