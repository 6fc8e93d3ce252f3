"""Row rules, incremental anomaly sinks, volume and duplicates on streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veriframe.functions.keys import fingerprint
from veriframe.operators.registry import active_checks
from veriframe.operators.rules import ROW_RULES
from veriframe.operators.scan import Container, row_rule_failures, scan, set_rule_failures


def stream_container(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A Parquet container, one file or a folder, as a stream of its files.

    A file source takes a plain path to be a folder, but a pattern to be either;
    so the path is given as the pattern that matches just itself.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


EPOCH = "1970-01-01"


def event_time(df: DataFrame, ts: str) -> Column:
    """Watermarks need a zoned timestamp; zone-less times are taken as UTC."""
    col = F.col(f"`{ts}`")
    if df.schema[ts].dataType.typeName() != "timestamp_ntz":
        return col.cast("timestamp")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), col))


def as_given(df: DataFrame, ts: str, col: Column) -> Column:
    """A window bound in the kind of the time column it came from."""
    if df.schema[ts].dataType.typeName() != "timestamp_ntz":
        return col
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), F.lit(EPOCH).cast("timestamp_ntz"))


#: What a stream can be checked for row by row, and what only a batch of it as a whole.
STREAM_RULES = (*ROW_RULES, "existsIn", "notExistsIn")
BATCH_RULES = (*STREAM_RULES, "volumetric", "aggregationComparison")


def _checks_of(checks: DataFrame, container: str, able: Sequence[str]) -> list[Row]:
    """The active checks of a container; those of other rules than ``able``, and an absence of checks, are refused."""
    mine = sorted(active_checks(checks).filter(F.col("container") == container).collect(), key=lambda c: c["check_uid"])
    others = [c["check_uid"] for c in mine if c["rule_type"] not in able]
    if others or not mine:
        raise ValueError(f"a stream of {container} cannot be checked for {', '.join(others) or 'nothing'}")
    return mine


def stream_scan(
    stream: DataFrame, container: str, keys: Sequence[str], checks: DataFrame, references: Mapping[str, Container] = {}
) -> DataFrame:
    """Failures of the active row and reference rules; stateless, so nothing is kept between batches.

    ``existsIn`` and ``notExistsIn`` join each batch with the keys of their container in ``references``, as its files were when the
    stream was set up; :func:`scan_batches` looks at references anew. Rules that need other rows of
    the stream, and an absence of checks, are refused by name.
    """
    mine = _checks_of(checks, container, STREAM_RULES)
    rows = [c for c in mine if c["rule_type"] in ROW_RULES]
    parts = [row_rule_failures(container, stream, keys, rows)] if rows else []
    # One join per check: a stream is read by each branch of its plan once, from the same files.
    parts += [set_rule_failures(container, stream, keys, [c], references) for c in mine if c["rule_type"] not in ROW_RULES]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("fingerprint", fingerprint(F.col("check_uid"), F.col("record_key")))


def scan_batches(
    stream: DataFrame,
    container: str,
    keys: Sequence[str],
    checks: DataFrame,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    references: Callable[[], Mapping[str, Container]] = dict,
) -> StreamingQuery:
    """Scan every micro-batch as a container of its own and hand its failures to ``sink`` with the batch's id.

    ``references`` is called for each batch, so that one sees what a reference holds by then. Row counts and
    aggregates are judged for the batch. Rules about all rows of the container (``unique``, replicas,
    differences) are refused: see ``stream_repeats`` for repeated keys.
    """
    _checks_of(checks, container, BATCH_RULES)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            sink(scan(batch.sparkSession, {**references(), container: Container(batch, keys)}, checks.filter(F.col("container") == container)), batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_batches(failures: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch to its own folder, once and only once.

    A batch replayed after a failure overwrites what it wrote before, and the
    offsets live in ``checkpoint``; both belong on shared storage.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        failures.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_volume(stream: DataFrame, ts: str, width: str, delay: str) -> DataFrame:
    """Rows per tumbling window; rows later than ``delay`` are dropped.

    A window is emitted once the watermark has passed its end. A stream that can be ended
    (``repeats.with_end``) then emits its last windows, too; its marker counts for nothing.
    """
    marked = F.col("_end") if "_end" in stream.columns else F.lit(False)
    at = stream.select(event_time(stream, ts).alias("_at"), marked.alias("_end")).withWatermark("_at", delay)
    return (
        at.groupBy(F.window("_at", width).alias("w"))
        .agg(F.count_if(~F.col("_end")).alias("row_count"))
        .filter(F.col("row_count") > 0)
        .select(
            as_given(stream, ts, F.col("w.start")).alias("window_start"),
            as_given(stream, ts, F.col("w.end")).alias("window_end"),
            "row_count",
        )
    )


def stream_unique(
    stream: DataFrame, keys: Sequence[str], ts: str, width: str, delay: str
) -> DataFrame:
    """Keys that repeat inside a tumbling window, once the window is closed."""
    cols = [F.col(f"`{k}`") for k in keys]
    at = stream.select(*cols, event_time(stream, ts).alias("_at")).withWatermark("_at", delay)
    return (
        at.groupBy(F.window("_at", width).alias("w"), *cols)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
        .select(as_given(stream, ts, F.col("w.start")).alias("window_start"), *cols, "occurrences")
    )


def run_to_files(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a streaming result to Parquet, processing what is available now."""
    return (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
