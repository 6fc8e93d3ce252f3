"""Repeated keys on a stream, with state and timers of their own.

Rows of a key that follow each other within ``within`` belong together, whatever window edge lies between them.
The state of a key is its open stretches (first time, last time, rows), few as they are further apart
than ``within`` and closed once the watermark is past them. A key has one event-time timer, of its earliest stretch: it
reports all stretches the watermark is past, if they have more than one row, drops them and waits for the next one, so a key
is woken once a batch however many stretches close in it. Rows may come in any order inside the allowed delay.

A watermark stops with the last row, so the last stretches would wait for ever. :func:`with_end` adds a second source
for one marker, :func:`end_stream` writes it when the source is known to have ended: it carries the watermark past everything.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import batched

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from veriframe.session import importable
from veriframe.streaming.streams import as_given, event_time

END_OF_TIME = "9999-01-01 00:00:00"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
AT_ONCE = 1_024  # rows of a key merged into its stretches at a time
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Stretch = tuple[int, int, int]  # first and last time in microseconds, rows


def joined(stretches: Sequence[Stretch], new: Stretch, within: int) -> list[Stretch]:
    """The stretches in order of time with ``new`` merged into all that it touches."""
    return merged([*stretches, new], within)


def merged(stretches: Iterable[Stretch], within: int) -> list[Stretch]:
    """The stretches in order of time, those that touch as one."""
    out: list[Stretch] = []
    for first, last, n in sorted(stretches):
        if out and first <= out[-1][1] + within:
            a, b, m = out[-1]
            out[-1] = (a, max(b, last), m + n)
        else:
            out.append((first, last, n))
    return out


class Repeats(StatefulProcessor):
    """Open stretches of a key, reported once the watermark is past them."""

    def __init__(self, key_fields: Sequence[str], within: int):
        self.key_fields, self.within = list(key_fields), within

    def init(self, handle) -> None:
        self.handle = handle
        fields = [T.StructField(n, T.ArrayType(T.LongType())) for n in ("first", "last", "n")]
        self.open = handle.getValueState("open", T.StructType(fields))

    def _read(self) -> list[Stretch]:
        held = self.open.get()
        return list(zip(*held)) if held is not None else []

    def _due(self, last: int) -> int:
        """The millisecond from which no row can touch a stretch that ends at ``last``."""
        return (last + self.within) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = stretches = self._read()
        times = ((row["_us"],) * 2 + (1,) for row in rows if not row["_end"])
        for some in batched(times, AT_ONCE):
            stretches = merged([*stretches, *some], self.within)
        if stretches:
            self._wait(stretches, self._due(before[0][1]) if before else None)
            self.open.update(tuple(list(c) for c in zip(*stretches)))
        return iter(())

    def _wait(self, stretches: Sequence[Stretch], set_to: int | None) -> None:
        """Set the key's timer, which is ``set_to``, to its earliest stretch."""
        due = self._due(stretches[0][1])
        if due != set_to:
            if set_to is not None:
                self.handle.deleteTimer(set_to)
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        stretches = self._read()
        left = [s for s in stretches if self._due(s[1]) > now]
        if left:
            self._wait(left, None)
            self.open.update(tuple(list(c) for c in zip(*left)))
        else:
            self.open.clear()
        for first, last, n in stretches:
            if self._due(last) <= now and n > 1:
                yield Row(**dict(zip(self.key_fields, key)), first=first, last=last, n=n)

    def close(self) -> None:
        pass


def _micros(spark: SparkSession, interval: str) -> int:
    """Microseconds of an interval of days or less, such as ``10 minutes``."""
    value = F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {interval})")
    return spark.range(1).select(value.alias("v")).first()[0]


def with_end(stream: DataFrame, ts: str, folder: str) -> DataFrame:
    """``stream`` and a source for the marker of its end below ``folder``; ``_end`` tells them apart."""
    spark = stream.sparkSession
    spark.createDataFrame([], "at string").write.mode("ignore").parquet(folder)
    marker = spark.readStream.schema("at string").parquet(folder)
    kind = stream.schema[ts].dataType
    nulls = [
        (F.col("at").cast(kind) if f.name == ts else F.lit(None).cast(f.dataType)).alias(f.name) for f in stream.schema
    ]
    return stream.withColumn("_end", F.lit(False)).unionByName(marker.select(*nulls, F.lit(True).alias("_end")))


def end_stream(spark: SparkSession, folder: str) -> None:
    """Declare the stream ended: its next run closes all that is open. Rows that come after that are late."""
    spark.createDataFrame([(END_OF_TIME,)], "at string").coalesce(1).write.mode("append").parquet(folder)


def _marked(stream: DataFrame) -> Column:
    return F.col("_end") if "_end" in stream.columns else F.lit(False)


def stream_repeats(stream: DataFrame, keys: Sequence[str], ts: str, within: str, delay: str) -> DataFrame:
    """Keys that occur again within ``within`` of an earlier row: the key, ``first_at``, ``last_at``, ``occurrences``.

    A chain of such rows is reported once, when the watermark, ``delay`` behind the latest row, is past it. Keys
    holding a null are no repeats, nor are rows without a time. Rows older than the watermark are dropped by Spark and counted
    (see :func:`late_rows`). Needs state in RocksDB, which is set here; a key's rows of a batch are read by one
    task as a stream, and its state does not grow with them.
    """
    spark = stream.sparkSession
    importable(spark)
    spark.conf.set(PROVIDER_KEY, PROVIDER)
    cols = [F.col(f"`{k}`") for k in keys]
    complete = F.lit(True)
    for c in cols:
        complete = complete & c.isNotNull()
    at = event_time(stream, ts)
    rows = stream.filter((complete & at.isNotNull()) | _marked(stream)).select(
        *cols, at.alias("_at"), F.unix_micros(at).alias("_us"), _marked(stream).alias("_end")
    )
    # Markers reach the state, as a key of nulls, and are passed over there: Spark would move a filter in front of the watermark.
    seen = rows.withWatermark("_at", delay)
    schema = T.StructType([
        *[T.StructField(f"k{i}", stream.schema[k].dataType) for i, k in enumerate(keys)],
        *[T.StructField(n, T.LongType()) for n in ("first", "last", "n")],
    ])
    processor = Repeats([f"k{i}" for i in range(len(keys))], _micros(spark, within))
    found = seen.groupBy(*cols).transformWithState(processor, schema, "Append", "EventTime")
    return found.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)],
        as_given(stream, ts, F.timestamp_micros("first")).alias("first_at"),
        as_given(stream, ts, F.timestamp_micros("last")).alias("last_at"),
        F.col("n").alias("occurrences"),
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows a finished run dropped behind the watermark, over the batches Spark still remembers."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
