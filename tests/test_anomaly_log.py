import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.operators import anomalies as an
from veriframe.operators.registry import Check, checks_frame
from veriframe.operators.scan import Container, scan
from veriframe.streaming import streams
from veriframe.streaming.anomaly_log import AnomalyLog

CHECKS = [Check("e", "notNull", ["k"]), Check("e", "between", ["v"], {"max_value": 5})]


def add(spark, path, *batch):
    spark.createDataFrame(list(batch), "id int, k string, v int").coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def source(spark, tmp_path):
    """Three batches; record 1 fails in two of them."""
    path = str(tmp_path / "in")
    add(spark, path, (1, "a", 9), (2, None, 1), (3, "c", 2))
    add(spark, path, (1, "a", 8), (4, None, 7))
    add(spark, path, (5, "x", 6), (5, "x", 6))
    return path


def failures(spark, source):
    return streams.stream_scan(streams.stream_container(spark, source, 1), "e", ["id"], checks_frame(spark, CHECKS))


def content(log):
    return rows(log.table(), "check_uid", "record_key", "failing_rows", "status", "scan_id")


def in_one_scan(spark, source):
    found = scan(spark, {"e": Container(spark.read.parquet(source), ["id"])}, checks_frame(spark, CHECKS))
    return rows(an.new_anomalies(found, "s", "2024-01-01"), "check_uid", "record_key", "status")


def test_stream_folds_into_the_table(spark, source, tmp_path):
    log = AnomalyLog(spark, str(tmp_path / "log"), 8)
    for _ in range(2):
        log.fold_stream(failures(spark, source), str(tmp_path / "offsets")).awaitTermination()
    assert rows(log.table(), "check_uid", "record_key", "status") == in_one_scan(spark, source)
    assert {r[4] for r in content(log)} == {"stream-0", "stream-1", "stream-2"}
    before = content(log)
    log.fold_stream(failures(spark, source), str(tmp_path / "lost")).awaitTermination()  # offsets lost: all batches again
    assert content(log) == before


def test_same_as_merge_failures(spark, source, tmp_path):
    log, table = AnomalyLog(spark, str(tmp_path / "log"), 8), None
    for i, file in enumerate(sorted(spark.read.parquet(source).inputFiles())):
        found = scan(spark, {"e": Container(spark.read.parquet(file), ["id"])}, checks_frame(spark, CHECKS))
        table = an.new_anomalies(found, f"stream-{i}", "2024-01-01") if table is None else an.merge_failures(table, found, f"stream-{i}", "2024-01-01")
        assert log.fold(found, i, created="2024-01-01") and not log.fold(found, i, created="2024-01-01")
        if i == 0:
            close = lambda t: t.withColumns({"status": F.lit("Resolved"), "archived": F.lit(True)}).select(*t.columns)
            log.rewrite(close)
            table = close(table)
    assert rows(log.table()) == rows(table.select(*log.table().columns))


@pytest.mark.parametrize("moment", ["_write", "_commit", "after"])
def test_killed_and_replayed(spark, source, tmp_path, monkeypatch, moment):
    """The second batch dies while it writes, before its commit, or right behind it."""
    calm = AnomalyLog(spark, str(tmp_path / "calm"), 8)
    calm.fold_stream(failures(spark, source), str(tmp_path / "calm_offsets")).awaitTermination()
    log = AnomalyLog(spark, str(tmp_path / "log"), 8)
    name = "_commit" if moment == "after" else moment
    real, calls = getattr(AnomalyLog, name), []

    def dying(self, *args):
        calls.append(1)
        if moment != "_commit" or len(calls) != 2:
            out = real(self, *args)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return out

    monkeypatch.setattr(AnomalyLog, name, dying)
    with pytest.raises(Exception, match="killed"):
        log.fold_stream(failures(spark, source), str(tmp_path / "offsets")).awaitTermination()
    monkeypatch.setattr(AnomalyLog, name, real)
    log.fold_stream(failures(spark, source), str(tmp_path / "offsets")).awaitTermination()
    assert content(log) == content(calm)
    log.rewrite()
    log.vacuum()
    assert content(log) == content(calm)
    assert len(log._names("data")) == 1 and len(log._names("log")) == 1


def test_only_touched_buckets_are_read(spark, source, tmp_path):
    log = AnomalyLog(spark, str(tmp_path / "log"), 64)
    log.fold_stream(failures(spark, source), str(tmp_path / "offsets")).awaitTermination()
    version = log.version()
    bucket = log._rows(version).select("bucket").first()[0]
    plan = log.known(version, [bucket])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and "ReadSchema: struct<fingerprint:string,status:string,archived:boolean>" in plan


def test_two_writers(spark, source, tmp_path):
    found = scan(spark, {"e": Container(spark.read.parquet(source), ["id"])}, checks_frame(spark, CHECKS))
    log = AnomalyLog(spark, str(tmp_path / "log"))
    stale = log.version()
    log.fold(found, 0)
    with pytest.raises(RuntimeError, match="another writer"):
        log._commit(type(stale)(stale.number + 1, (), {}))
    assert log.table().count() == 5


def test_empty(spark, tmp_path):
    log = AnomalyLog(spark, str(tmp_path / "log"))
    assert log.table().count() == 0
    none = spark.createDataFrame([], "check_uid string, container string, rule_type string, anomaly_type string, record_key string, message string, fingerprint string")
    assert log.fold(none, 0) and log.table().count() == 0 and not log.fold(none, 0)
    log.rewrite()
    assert log.table().columns == AnomalyLog(spark, str(tmp_path / "other")).table().columns
