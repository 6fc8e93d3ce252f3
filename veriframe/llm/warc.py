"""WARC archives in Zstandard: a dictionary in front, then one frame per record.

An archive is a sequence of Zstandard frames. The first is a skippable frame that
holds the dictionary (itself compressed or not); each following frame is one WARC
record. Archives are a Spark data source, ``warczst``: writing gives one file per
task, put in place when the job commits, and a reader task streams whole archives,
checking every frame, header and length, so a file of any size needs the memory of
one record.

Files are opened through pyarrow's file systems, so the folder must be one that all
executors reach and that pyarrow has a driver for.
"""

from __future__ import annotations

import base64
import dataclasses
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from veriframe.llm.common import col, importable, opened
from veriframe.session import scratch

DICTIONARY_MAGIC = 0x184D2A5D  # skippable frame that holds a dictionary
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
SMALLEST_REVISIT = 1000  # payload bytes
DICTIONARY_BYTES = 32 << 10
TRAINED_ON = 2 << 20  # bytes of a file's first records the dictionary is trained on at most
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"


class BadArchive(ValueError):
    """An archive that breaks the format; names the file and the place."""


def digest_field(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def digest_hex(field: str) -> str:
    kind, _, value = field.partition(":")
    if kind != "sha1":
        raise ValueError(f"unknown digest {field!r}")
    return base64.b32decode(value).hex()


REQUIRED = {"warc-type", "warc-record-id", "warc-date", "content-length"}


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC record; header values may not hold line ends."""
    lines = [VERSION]
    for name, value in [*headers, ("Content-Length", str(len(block)))]:
        if "\r" in value or "\n" in value:
            raise ValueError(f"{name} holds a line end")
        lines.append(f"{name}: {value}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record that fills ``raw`` exactly."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line[:60]!r}")
        name = name.strip().lower()
        if name in REQUIRED and name in headers:
            raise ValueError(f"{name} is repeated")
        headers[name] = value.strip()
    missing = REQUIRED - headers.keys()
    if missing:
        raise ValueError(f"missing {sorted(missing)}")
    if not headers["content-length"].isdecimal():
        raise ValueError(f"bad length {headers['content-length']!r}")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, not {n}")
    return headers, rest[:n]


# ---- frames --------------------------------------------------------------------------


class ArchiveWriter:
    """Writes one archive; the dictionary is trained on its first records."""

    def __init__(self, stream):
        self.stream, self.waiting, self.size, self.compressor = stream, [], 0, None

    def add(self, raw: bytes) -> None:
        if self.compressor:
            self.stream.write(self.compressor.compress(raw))
            return
        self.waiting.append(raw)
        self.size += len(raw)
        if self.size >= TRAINED_ON:
            self._begin()

    def _begin(self) -> None:
        import zstandard

        trained = None
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, self.waiting)
        except zstandard.ZstdError:
            pass  # too few records to learn from: an empty dictionary frame
        held = zstandard.ZstdCompressor().compress(trained.as_bytes()) if trained else b""
        self.stream.write(struct.pack("<II", DICTIONARY_MAGIC, len(held)) + held)
        options = {"level": LEVEL, "write_checksum": True, "write_content_size": True}
        if trained:
            options["dict_data"] = trained
        self.compressor = zstandard.ZstdCompressor(**options)
        for raw in self.waiting:
            self.stream.write(self.compressor.compress(raw))
        self.waiting = []

    def close(self) -> None:
        if not self.compressor:
            self._begin()
        self.stream.close()


def read_frames(stream, name: str = "archive", chunk: int = 1 << 20) -> Iterator[bytes]:
    """The decoded frames of an archive, one at a time; raises BadArchive on any fault."""
    import zstandard

    head = stream.read(8)
    if len(head) < 8:
        raise BadArchive(f"{name}: no dictionary frame")
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_MAGIC:
        raise BadArchive(f"{name}: starts with {magic:#x}, not a dictionary frame")
    held = stream.read(size)
    if len(held) < size:
        raise BadArchive(f"{name}: dictionary cut short")
    options = {}
    if held:
        try:
            if struct.unpack("<I", held[:4])[0] == FRAME_MAGIC:
                held = zstandard.ZstdDecompressor().decompress(held)
            options["dict_data"] = zstandard.ZstdCompressionDict(held)
        except (zstandard.ZstdError, struct.error) as e:
            raise BadArchive(f"{name}: bad dictionary: {e}") from e
    decompressor = zstandard.ZstdDecompressor(**options)
    rest, at = b"", 8 + size
    while rest := rest or stream.read(chunk):
        frame, out = decompressor.decompressobj(), []
        while True:
            try:
                out.append(frame.decompress(rest))
            except zstandard.ZstdError as e:
                raise BadArchive(f"{name}: bad frame at about byte {at}: {e}") from e
            if frame.eof:
                at += len(rest) - len(frame.unused_data)
                rest = frame.unused_data
                break
            at += len(rest)
            rest = stream.read(chunk)
            if not rest:
                raise BadArchive(f"{name}: last frame cut short")
        yield b"".join(out)


def read_records(stream, name: str = "archive") -> Iterator[tuple[dict[str, str], bytes]]:
    """Validated records: whole headers, right lengths, right digests where there are any."""
    for i, raw in enumerate(read_frames(stream, name)):
        try:
            headers, block = parse_record(raw)
            given = headers.get("warc-block-digest")
            if given and digest_hex(given) != hashlib.sha1(block).hexdigest():
                raise ValueError("block differs from its digest")
        except ValueError as e:
            raise BadArchive(f"{name}: record {i}: {e}") from e
        yield headers, block


# ---- the data source -----------------------------------------------------------------

#: One row per record. ``payload_digest`` and ``payload_bytes`` speak of the full payload, also
#: for a revisit, whose own block is empty.
SCHEMA = (
    "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to bigint"
)


@dataclasses.dataclass
class Written(WriterCommitMessage):
    path: str | None
    records: int


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    if not (record_id.startswith("<urn:page:") and record_id.endswith(">")):
        raise ValueError(f"unknown record id {record_id!r}")
    return int(record_id[10:-1]) if record_id[10:-1] else None


def row_record(page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to) -> bytes:
    """The WARC record of a row of ``SCHEMA``."""
    block = payload or b""
    headers = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", digest_field(payload_digest)),
        ("WARC-Block-Digest", digest_field(hashlib.sha1(block).hexdigest())),
        ("X-Payload-Length", str(payload_bytes)),
    ]
    if url is not None:
        # Any text in a header of one line, line ends and outer blanks included.
        headers.append(("WARC-Target-URI", url.encode("unicode_escape").decode().replace(" ", "\\x20")))
    if record_type == "revisit":
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(refers_to)),
        ]
    return record(headers, block)


def record_row(headers: dict[str, str], block: bytes) -> tuple:
    """The row of ``SCHEMA`` of a record; a response must match its own digest and length."""
    kind = headers["warc-type"]
    digest = digest_hex(headers["warc-payload-digest"])
    size = int(headers["x-payload-length"])
    if kind == "response" and (size != len(block) or digest != hashlib.sha1(block).hexdigest()):
        raise ValueError("payload differs from its length or digest")
    uri = headers.get("warc-target-uri")
    return (
        _page_of(headers["warc-record-id"]),
        None if uri is None else uri.encode().decode("unicode_escape"),
        kind,
        block if kind == "response" else None,
        size,
        digest,
        _page_of(headers["warc-refers-to"]) if kind == "revisit" else None,
    )


class WarcSource(DataSource):
    """Rows of ``SCHEMA`` as archives in a folder (option ``path``)."""

    @classmethod
    def name(cls) -> str:
        return "warczst"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"])

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], schema.fieldNames())


class WarcWriter(DataSourceArrowWriter):
    """One archive per task, under a name of its own attempt; only committed ones get the suffix readers look for."""

    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path.rstrip("/"), names

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = opened(self.path)
        path, records, archive = f"{folder}/part-{uuid.uuid4().hex}.open", 0, None
        fields = [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in iterator:
            if batch.num_rows and archive is None:
                fs.create_dir(folder, recursive=True)
                archive = ArchiveWriter(fs.open_output_stream(path, compression=None))
            columns = [batch.column(self.names.index(f)) for f in fields]
            for i in range(batch.num_rows):
                archive.add(row_record(*(c[i].as_py() for c in columns)))
                records += 1
        if archive is None:
            return Written(None, 0)
        archive.close()
        return Written(path, records)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = opened(self.path)
        fs.create_dir(folder, recursive=True)
        for m in messages:
            if m is not None and m.path:
                fs.move(m.path, m.path.removesuffix(".open") + ".warc.zst")

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.path)
        for m in messages:
            if m is not None and m.path and fs.get_file_info(m.path).type == pa.fs.FileType.File:
                fs.delete_file(m.path)


@dataclasses.dataclass
class Archives(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    """Small archives share a task; frames cannot be found without reading, so one is never split."""

    TASK_BYTES = 64 << 20

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Archives]:
        fs, folder = opened(self.path.rstrip("/"))
        files = fs.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True))
        out, size = [Archives([])], 0
        for f in sorted(files, key=lambda f: f.path):
            if f.path.endswith(".warc.zst"):
                if out[-1].paths and size + f.size > self.TASK_BYTES:
                    out.append(Archives([]))
                    size = 0
                out[-1].paths.append(f.path)
                size += f.size
        return out

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.path)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
        names = [f.split()[0] for f in SCHEMA.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        rows, size = [], 0
        for path in partition.paths:
            with fs.open_input_stream(path, compression=None) as stream:
                for i, (headers, block) in enumerate(read_records(stream, path)):
                    try:
                        rows.append(record_row(headers, block))
                    except (KeyError, ValueError) as e:
                        raise BadArchive(f"{path}: record {i}: {e}") from e
                    size += len(block)
                    if size > 4 << 20 or len(rows) >= 4_000:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)


# ---- pages ---------------------------------------------------------------------------


def with_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    smallest: int = SMALLEST_REVISIT,
) -> DataFrame:
    """Pages as rows of ``SCHEMA``.

    Of pages with equal payloads of at least ``smallest`` bytes the one with the largest id is
    the response and the others revisit it; rows that repeat this page are responses as well,
    and so are pages of a payload that only pages without an id have. A null html is an empty
    payload. Other columns are not read.
    """
    payload = F.coalesce(col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        col(id_col).cast("bigint").alias("page_id"), col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumns({
        "payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1("payload"),
    })
    # Digests that several pages share; pre-aggregated, and the pages read only for their digest.
    shared = (
        rows.filter(F.col("payload_bytes") >= smallest)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("_keeper"), F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") > 1) & F.col("_keeper").isNotNull())
        .select(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"), "_keeper")
        .hint("rebalance")  # a plain shuffle, so that hot digests of the pages are split at run time
    )
    same = (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes"))
    joined = rows.join(shared, same, "left")
    revisit = F.col("_keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_keeper"))
    return joined.select(
        "page_id", "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes", "payload_digest",
        F.when(revisit, F.col("_keeper")).alias("refers_to"),
    )


def write(records: DataFrame, path: str) -> None:
    """Write rows of ``SCHEMA`` as archives into a new folder."""
    importable(records.sparkSession)
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warczst").mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder; an empty or missing folder has none."""
    importable(spark)
    spark.dataSource.register(WarcSource)
    return spark.read.format("warczst").load(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives into the shared folder and read back from them."""
    path = scratch(pages.sparkSession, "warc")
    write(with_revisits(pages), path)
    return read(pages.sparkSession, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
