"""Queries T: the scans and measurements that run on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.operators.registry import Check, checks_frame
from veriframe.operators.scan import Container
from veriframe.plans.common import duck, frame, sql_fingerprint, table
from veriframe.session import scratch
from veriframe.streaming import repeats, streams
from veriframe.streaming.anomaly_log import AnomalyLog

EVENT_CHECKS = [
    Check("events", "between", ["value"], {"max_value": 200}),
    Check("events", "matchesPattern", ["event_type"], {"pattern": "view|click|signup|purchase"}),
    Check("events", "afterDateTime", ["ts"], {"datetime": "2024-01-02 12:00:00"}),
]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return streams.stream_container(spark, f"{sf}/events.parquet")


def _finish(result: DataFrame, label: str) -> DataFrame:
    spark = result.sparkSession
    path = scratch(spark, label)
    streams.run_to_files(result, path, scratch(spark, f"{label}-offsets")).awaitTermination()
    return spark.read.schema(result.schema).parquet(path)


def q_stream_scan(spark: SparkSession, sf: str) -> DataFrame:
    failures = streams.stream_scan(_events(spark, sf), "events", ["event_id"], checks_frame(spark, EVENT_CHECKS))
    return _finish(failures.select("check_uid", "record_key", "fingerprint"), "stream_scan")


def q_stream_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the same source: the second finds nothing new to write."""
    failures = streams.stream_scan(_events(spark, sf), "events", ["event_id"], checks_frame(spark, EVENT_CHECKS))
    failures = failures.select("check_uid", "record_key", "fingerprint")
    path, offsets = scratch(spark, "stream_incremental"), scratch(spark, "stream_incremental-offsets")
    for _ in range(2):
        streams.write_batches(failures, path, offsets).awaitTermination()
    return spark.read.parquet(path).select(*failures.columns)


def q_stream_volume(spark: SparkSession, sf: str) -> DataFrame:
    out = _finish(streams.stream_volume(_events(spark, sf), "ts", "1 hour", "2 hours"), "stream_volume")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "row_count")


def q_stream_unique(spark: SparkSession, sf: str) -> DataFrame:
    result = streams.stream_unique(_events(spark, sf), ["user_id", "event_type"], "ts", "6 hours", "1 hour")
    out = _finish(result, "stream_unique")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


def _ended(spark: SparkSession, sf: str, label: str, result) -> DataFrame:
    """A run over all events and one after the stream has ended, from the first one's offsets and state."""
    end, path, offsets = (scratch(spark, f"{label}{part}") for part in ("-end", "", "-offsets"))
    out = result(repeats.with_end(_events(spark, sf), "ts", end))
    streams.run_to_files(out, path, offsets).awaitTermination()
    repeats.end_stream(spark, end)
    streams.run_to_files(out, path, offsets).awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


def q_stream_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a user that follow one of their own kind within two hours, up to the end of the stream."""
    keys = ["user_id", "event_type"]
    out = _ended(spark, sf, "stream_repeats", lambda s: repeats.stream_repeats(s, keys, "ts", "2 hours", "1 hour"))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_at", "last_at")})


def q_stream_volume_ended(spark: SparkSession, sf: str) -> DataFrame:
    out = _ended(spark, sf, "stream_volume_ended", lambda s: streams.stream_volume(s, "ts", "1 hour", "2 hours"))
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "row_count")


REFERENCE_CHECKS = [
    EVENT_CHECKS[0],
    Check("events", "existsIn", ["user_id"], {"ref_container": "customer", "field_name": "c_custkey"}),
    Check("events", "notExistsIn", ["user_id"], {"ref_container": "supplier", "field_name": "s_suppkey"}, filter="event_type = 'click'"),
]
BUILDING = "SELECT c_custkey FROM {customer} WHERE c_mktsegment <> 'BUILDING'"


def q_stream_reference_scan(spark: SparkSession, sf: str) -> DataFrame:
    refs = {"customer": Container(frame(spark, sf, BUILDING)), "supplier": Container(table(spark, sf, "supplier"))}
    failures = streams.stream_scan(_events(spark, sf), "events", ["event_id"], checks_frame(spark, REFERENCE_CHECKS), refs)
    return _finish(failures.select("check_uid", "record_key", "fingerprint"), "stream_reference_scan")


def q_stream_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Failures of the stream folded into the anomaly table; a second run and a replay from the start change nothing."""
    failures = streams.stream_scan(_events(spark, sf), "events", ["event_id"], checks_frame(spark, EVENT_CHECKS))
    log, offsets = AnomalyLog(spark, scratch(spark, "stream_anomalies")), scratch(spark, "stream_anomalies-offsets")
    for checkpoint in (offsets, offsets, scratch(spark, "stream_anomalies-replay")):
        log.fold_stream(failures, checkpoint).awaitTermination()
    return log.table().select("check_uid", "record_key", "fingerprint", "status", "scan_id", "failing_rows")


QUERIES = {
    "stream_repeats": q_stream_repeats,
    "stream_volume_ended": q_stream_volume_ended,
    "stream_reference_scan": q_stream_reference_scan,
    "stream_anomalies": q_stream_anomalies,
    "stream_scan": q_stream_scan,
    "stream_incremental": q_stream_incremental,
    "stream_volume": q_stream_volume,
    "stream_unique": q_stream_unique,
}


def _failing(uid: str, where: str) -> str:
    key = "CAST(event_id AS VARCHAR)"
    fingerprint = sql_fingerprint("'" + uid + "'", key)
    return f"SELECT '{uid}' AS check_uid, {key} AS record_key, {fingerprint} AS fingerprint FROM events WHERE {where}"


_SCAN = " UNION ALL ".join(
    [
        _failing("events__between__value", "value > 200"),
        _failing("events__matchespattern__event_type", "event_type NOT IN ('view', 'click', 'signup', 'purchase')"),
        _failing("events__afterdatetime__ts", "ts <= TIMESTAMP '2024-01-02 12:00:00'"),
    ]
)

ORACLES = {
    "stream_repeats": """
        WITH t AS (SELECT user_id, event_type, ts, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS earlier FROM events
                   WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND ts IS NOT NULL),
        s AS (SELECT *, count(*) FILTER (earlier IS NULL OR ts > earlier + INTERVAL 2 HOUR)
                     OVER (PARTITION BY user_id, event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS chain FROM t)
        SELECT user_id, event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at,
               count(*) AS occurrences FROM s GROUP BY user_id, event_type, chain HAVING count(*) > 1""",
    "stream_volume_ended": """
        SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS row_count FROM events
        WHERE ts IS NOT NULL GROUP BY date_trunc('hour', ts)""",
    "stream_reference_scan": " UNION ALL ".join([
        _failing("events__between__value", "value > 200"),
        _failing("events__existsin__user_id", f"user_id IS NOT NULL AND user_id NOT IN {duck(BUILDING)}"),
        _failing("events__notexistsin__user_id", "event_type = 'click' AND user_id IN (SELECT s_suppkey FROM supplier)"),
    ]),
    "stream_anomalies": f"SELECT *, 'Active' AS status, 'stream-0' AS scan_id, 1::BIGINT AS failing_rows FROM ({_SCAN})",
    "stream_scan": _SCAN,
    "stream_incremental": _SCAN,
    "stream_volume": """
        SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS row_count FROM events
        GROUP BY date_trunc('hour', ts)
        HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
    "stream_unique": """
        SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_start, user_id, event_type, count(*) AS occurrences
        FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM events)
        WHERE w + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
        GROUP BY w, user_id, event_type HAVING count(*) > 1""",
}
