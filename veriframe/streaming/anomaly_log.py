"""The anomaly table of a stream: a log of commits over bucketed files.

Every batch writes its new anomalies to a folder of its own and becomes part of the table by one file, the next
version in ``log``: it names the folders that make up the table and the last batch of each stream. A version is
made by renaming a finished file to a name that is not taken, so a batch is in the table whole or not at all. A batch
killed before that leaves a folder no version names; a batch that is replayed after it finds its number there and changes
nothing.

Anomalies lie in buckets by fingerprint. A batch needs to know which of its failures have an open anomaly, and reads
the fingerprints of the buckets it touches for that, never the whole table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veriframe.operators.anomalies import ANOMALY_COLUMNS, is_open, new_anomalies


@dataclass(frozen=True)
class Version:
    number: int = 0
    folders: tuple[str, ...] = ()
    last: dict[str, int] = field(default_factory=dict)  # stream -> its last batch in the table


class AnomalyLog:
    """An anomaly table below ``root``, a folder that driver and executors share; one writer at a time wins a version."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # -- versions ---------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, *parts: str) -> list[str]:
        files, folder = self._files(), self._path(*parts)
        return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []

    def version(self) -> Version:
        """What the table is now."""
        names = [n for n in self._names("log") if n.endswith(".json")]
        if not names:
            return Version()
        held = json.loads(self.spark.read.text(f"{self.root}/log/{names[-1]}", wholetext=True).first()[0])
        return Version(held["number"], tuple(held["folders"]), held["last"])

    def _commit(self, new: Version) -> None:
        text = json.dumps({"number": new.number, "folders": new.folders, "last": new.last})
        files, draft, final = self._files(), self._path("log", f".{uuid.uuid4().hex}"), self._path("log", f"{new.number:012}.json")
        out = files.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if files.exists(final) or not files.rename(draft, final):
            files.delete(draft, False)
            raise RuntimeError(f"version {new.number} of {self.root} was made by another writer")

    # -- rows -------------------------------------------------------------

    def _rows(self, version: Version) -> DataFrame:
        schema = f"{ANOMALY_COLUMNS}, commit string, bucket int"
        if not version.folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*[f"{self.root}/data/{f}" for f in version.folders])

    def table(self) -> DataFrame:
        """The anomalies as of now; later commits do not change the frame."""
        return self._rows(self.version()).drop("commit", "bucket")

    def _write(self, rows: DataFrame) -> tuple[str, ...]:
        folder = f"commit={uuid.uuid4().hex}"
        placed = rows.withColumn("bucket", self._bucket())
        placed.write.partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
        return (folder,) if any(n.startswith("bucket=") for n in self._names("data", folder)) else ()

    def _bucket(self):
        return (F.conv(F.substring("fingerprint", 1, 6), 16, 10).cast("int") % self.buckets).alias("bucket")

    def known(self, version: Version, touched: list[int]) -> DataFrame:
        """Fingerprints with an open anomaly in the given buckets; no other bucket's files are read."""
        return self._rows(version).filter(F.col("bucket").isin(touched) & is_open()).select("fingerprint").distinct()

    # -- writing ----------------------------------------------------------

    def fold(self, failures: DataFrame, batch_id: int, stream: str = "stream", created: str | None = None) -> bool:
        """Make the failures of a batch part of the table; returns whether anything was to be done.

        As ``merge_failures`` does: a fingerprint with an open anomaly keeps it, all others get a new one. A batch that
        is in the table already changes nothing.
        """
        now = self.version()
        if batch_id <= now.last.get(stream, -1):
            return False
        moment = created or self.spark.range(1).select(F.current_timestamp().cast("string")).first()[0]
        fresh = new_anomalies(failures, f"{stream}-{batch_id}", moment).persist()
        try:
            touched = sorted(r[0] for r in fresh.select(self._bucket()).distinct().collect())
            folders = now.folders
            if touched:
                # Fingerprints are unique on either side, so none is hot.
                added = fresh.join(self.known(now, touched), "fingerprint", "left_anti").select(*fresh.columns)
                folders += self._write(added)
            self._commit(Version(now.number + 1, folders, {**now.last, stream: batch_id}))
        finally:
            fresh.unpersist()
        return True

    def fold_stream(self, failures: DataFrame, checkpoint: str, stream: str = "stream") -> StreamingQuery:
        """Fold every micro-batch of ``failures`` (see ``stream_scan``), once each, processing what is available now."""

        def run(batch: DataFrame, batch_id: int) -> None:
            self.fold(batch, batch_id, stream)

        return failures.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def rewrite(self, change: Callable[[DataFrame], DataFrame] = lambda t: t) -> None:
        """Replace the table by ``change`` of it in one commit: updates, resolving, or just fewer and larger files."""
        now = self.version()
        changed = change(self._rows(now).drop("commit", "bucket"))
        folders = self._write(changed.repartition(self._bucket()))
        self._commit(Version(now.number + 1, folders, now.last))

    def vacuum(self) -> None:
        """Delete what the last version does not name: folders of killed or replaced commits, and earlier versions."""
        now, files = self.version(), self._files()
        for name in self._names("data"):
            if name not in now.folders:
                files.delete(self._path("data", name), True)
        for name in self._names("log"):
            if name != f"{now.number:012}.json":
                files.delete(self._path("log", name), False)
