"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are windows of consecutive words of the benchmark items. For the
windows of one length a *shift table* says, for the block of two words under a
cursor, how far the nearest window that holds this block can still end, so that a
cursor jumps over positions where no window can end. A zero shift selects a
*bucket* by a hash of the last words of the window, and the bucket's windows are
compared word by word. Each task moves a few thousand cursors through its texts
at once, which makes every step one numpy operation.

Spark makes and groups the windows and writes them in hash blocks to the shared
folder. Tasks build the tables of a block from its files; the driver sees sizes only.

Words are maximal runs of ASCII letters and digits and of all characters beyond
ASCII, with A-Z lower-cased.
"""

from __future__ import annotations

import dataclasses
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.common import col, opened, slices
from veriframe.session import scratch

WINDOW = 10
# One searcher holds the windows of so many characters of items; a larger benchmark takes several.
BLOCK_BYTES = 4 << 20
KEPT = 4  # searchers a Python worker keeps
SLICE_BYTES = 2 << 20  # text searched at once
RELOAD_BYTES = 64 << 20  # text searched per loading of a block, where the blocks are more than are kept
CHUNK = 1024  # words a cursor is responsible for
SUFFIX = 4  # words hashed to choose a bucket

_FOLD = bytes(
    i + 32 if 65 <= i <= 90 else i if i > 127 or 48 <= i <= 57 or 97 <= i <= 122 else 32
    for i in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows_of(text: str | None, window: int) -> Iterator[bytes]:
    """The windows of an item, their words joined by a blank; repeated ones are repeated."""
    words = words_of(text)
    m = min(window, len(words))
    return (b" ".join(words[i : i + m]) for i in range(len(words) - m + 1 if m else 0))


def _mix(columns: Iterable[np.ndarray], bits: int) -> np.ndarray:
    h = None
    for c in columns:
        c = c.astype(np.uint64)
        h = c if h is None else (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + c
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


@dataclasses.dataclass
class Tables:
    """Shift table and buckets for the windows of one length."""

    length: int
    block: int
    bits: int
    windows: np.ndarray  # distinct windows, one per row, ordered by bucket
    shift: np.ndarray
    bucket: np.ndarray  # start of each bucket in ``windows``
    first: int  # number of the first window among those of all lengths

    @classmethod
    def build(cls, windows: np.ndarray, first: int) -> tuple[Tables, np.ndarray]:
        """The tables, and the order in which they hold ``windows``."""
        n, m = windows.shape
        block = min(2, m)
        bits = min(22, max(12, int(n * m).bit_length() + 2))
        shift = np.full(1 << bits, m - block + 1, np.int16)
        for end in range(block, m + 1):
            at = _mix((windows[:, end - block + k] for k in range(block)), bits)
            np.minimum.at(shift, at, m - end)
        key = _mix((windows[:, k] for k in range(max(0, m - SUFFIX), m)), bits)
        order = np.argsort(key, kind="stable")
        bucket = np.searchsorted(key[order], np.arange((1 << bits) + 1))
        return cls(m, block, bits, windows[order], shift, bucket, first), order

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word, window) of every occurrence in ``ids``."""
        m, n = self.length, len(ids)
        if n < m:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pos = np.arange(m - 1, n, CHUNK)
        end = np.minimum(pos + CHUNK, n)
        ends: list[np.ndarray] = []
        found: list[np.ndarray] = []
        while len(pos):
            s = self.shift[_mix((ids[pos - self.block + 1 + k] for k in range(self.block)), self.bits)]
            here = pos[s == 0]
            if len(here):
                p, w = self._confirm(ids, here)
                ends.append(p)
                found.append(w)
            pos = pos + np.maximum(s, 1)
            on = pos < end
            pos, end = pos[on], end[on]
        if not ends:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(ends), np.concatenate(found)

    def _confirm(self, ids: np.ndarray, here: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = self.length
        key = _mix((ids[here - m + 1 + k] for k in range(max(0, m - SUFFIX), m)), self.bits)
        at, last = self.bucket[key], self.bucket[key + 1]
        ends, found = [], []
        while True:
            on = at < last
            here, at, last = here[on], at[on], last[on]
            if not len(here):
                break
            same = np.arange(len(here))
            for k in range(m):
                same = same[ids[here[same] - m + 1 + k] == self.windows[at[same], k]]
                if not len(same):
                    break
            ends.append(here[same])
            found.append(at[same] + self.first)
            at = at + 1
        if not ends:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(ends), np.concatenate(found)


@dataclasses.dataclass
class Searcher:
    """All windows of a block of benchmark items."""

    vocabulary: dict[bytes, int]
    tables: list[Tables]
    starts: np.ndarray  # per window, where its items begin in ``owners``
    owners: np.ndarray  # item numbers
    items: list[str]

    @classmethod
    def build(cls, items: list[tuple[object, str | None]], window: int = WINDOW) -> Searcher:
        """The searcher of a few items."""
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for w in windows_of(text, window):
                owners.setdefault(w, set()).update([] if item is None else [str(item)])
        return cls.of(owners.items())

    @classmethod
    def of(cls, windows: Iterable[tuple[bytes, Iterable[str]]]) -> Searcher:
        """The searcher of distinct windows, each with the ids of its items."""
        vocabulary: dict[bytes, int] = {}
        names: dict[str, int] = {}
        by_length: dict[int, tuple[array, array, array]] = {}
        for text, items in windows:
            words = text.split()
            ids, sizes, owners = by_length.setdefault(len(words), (array("i"), array("q"), array("q")))
            ids.extend([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words])
            before = len(owners)
            owners.extend([names.setdefault(i, len(names)) for i in items])
            sizes.append(len(owners) - before)
        tables, all_sizes, all_owners, first = [], [np.zeros(1, np.int64)], [np.empty(0, np.int64)], 0
        for m, (ids, sizes, owners) in sorted(by_length.items()):
            built, order = Tables.build(np.array(ids, np.int32).reshape(-1, m), first)
            tables.append(built)
            first += len(order)
            size = np.array(sizes, np.int64)
            begin, moved = (np.cumsum(size) - size)[order], size[order]
            within = np.arange(moved.sum()) - np.repeat(np.cumsum(moved) - moved, moved)
            all_sizes.append(moved)
            all_owners.append(np.array(owners, np.int64)[np.repeat(begin, moved) + within])
        starts = np.cumsum(np.concatenate(all_sizes))
        return cls(vocabulary, tables, starts, np.concatenate(all_owners), list(names))

    def search(self, texts: list[str | None]) -> tuple[list[int], list[list[int]], list[list[str]]]:
        """Per text: number of words, hit runs of words as flat [start, end) pairs, items."""
        gap = WINDOW if not self.tables else max(t.length for t in self.tables)
        get, counts, pieces = self.vocabulary.get, [], []
        blank = np.zeros(gap, np.int32)
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            pieces += [np.fromiter(map(get, words, repeat(0)), np.int32, len(words)), blank]
        ids = np.concatenate(pieces) if pieces else blank
        begin = np.cumsum([0, *(c + gap for c in counts)])
        spans: list[list[int]] = [[] for _ in texts]
        items: list[list[str]] = [[] for _ in texts]
        marks = np.zeros(len(ids) + 1, np.int64)
        pairs = []
        for t in self.tables:
            ends, windows = t.find(ids)
            if len(ends):
                np.add.at(marks, ends - t.length + 1, 1)
                np.add.at(marks, ends + 1, -1)
                doc = np.searchsorted(begin, ends, side="right") - 1
                pairs.append(np.unique(doc * (len(self.starts) + 1) + windows))
        if pairs:
            hit = np.concatenate(([0], np.cumsum(marks[:-1]) > 0, [0])).astype(np.int8)
            edge = np.flatnonzero(np.diff(hit))  # starts and ends in turn; texts are apart by a gap
            for a, b in zip(edge[::2], edge[1::2]):
                d = int(np.searchsorted(begin, a, side="right")) - 1
                spans[d] += [int(a - begin[d]), int(b - begin[d])]
            owned: dict[int, set[str]] = {}
            for key in np.concatenate(pairs):
                d, w = divmod(int(key), len(self.starts) + 1)
                owned.setdefault(d, set()).update(
                    self.items[o]
                    for o in self.owners[self.starts[w] : self.starts[w + 1]]
                )
            for d, names in owned.items():
                items[d] = sorted(names)
        return counts, spans, items


_NOTHING = Searcher.of([])
_searchers: dict[tuple[str, int], Searcher] = {}


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of items (columns item, text, window), some thousand at a time; repeats are left to the grouping."""
    for batch in batches:
        for item, text, window in zip(*(c.to_pylist() for c in batch.columns)):
            found = windows_of(text, window)
            while part := list(islice(found, 8192)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(part), pa.string()), pa.array(part, pa.binary())], names=["item", "window"]
                )


@dataclasses.dataclass(frozen=True)
class Blocks:
    """The distinct windows of a benchmark as a table in the shared folder, a folder of bounded size per block."""

    path: str
    rows: dict[int, int]  # windows per block

    @classmethod
    def write(cls, benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> Blocks:
        """Windows are made, grouped and dealt to blocks by a hash in Spark; sizes alone reach the driver."""
        spark = benchmark.sparkSession
        rows = benchmark.select(
            col(item_col).cast("string").alias("item"), col(text_col).cast("string").alias("text"), F.lit(window).alias("window")
        )
        size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
        n = max(1, -(-size // block_bytes))
        found = rows.mapInArrow(_windows, "item string, window binary")
        found = found.groupBy("window").agg(F.collect_set("item").alias("items"))
        found = found.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(n)).cast("int"))
        path = scratch(spark, "benchmark")
        found.repartition("block").write.partitionBy("block").parquet(path)
        written = spark.read.schema(found.schema).parquet(path).groupBy("block").count()
        return cls(path, {r["block"]: r["count"] for r in written.collect()})

    def searcher(self, block: int) -> Searcher:
        """The tables of a block, built by the task from its files and kept for the next ones."""
        key = (self.path, block)
        if key not in _searchers:
            while len(_searchers) >= KEPT:
                del _searchers[next(iter(_searchers))]
            _searchers[key] = Searcher.of(self._read(block))
        return _searchers[key]

    def _read(self, block: int) -> Iterator[tuple[bytes, list[str]]]:
        fs, folder = opened(f"{self.path}/block={block}")
        n = 0
        for info in fs.get_file_info(pa.fs.FileSelector(folder)):
            if info.path.endswith(".parquet"):
                with fs.open_input_file(info.path) as file:
                    for batch in pq.ParquetFile(file).iter_batches(8192, columns=["window", "items"]):
                        n += batch.num_rows
                        yield from zip(*(c.to_pylist() for c in batch.columns))
        if n != self.rows[block]:
            raise OSError(f"{folder} holds {n} windows of {self.rows[block]}")

    def search(self, batch: pa.RecordBatch, at: int | str) -> Iterator[tuple[pa.RecordBatch, list, list, list]]:
        """``batch`` in parts, with words, hit runs and items of the texts in column ``at``, as :meth:`Searcher.search`.

        Where the blocks are more than are kept, each is loaded once for many texts.
        """
        for part in slices(batch, at, SLICE_BYTES if len(self.rows) <= KEPT else RELOAD_BYTES):
            slots = [p for p in slices(part, at, SLICE_BYTES)]
            found: list[tuple] = [_NOTHING.search(p.column(at).to_pylist()) for p in slots] if not self.rows else []
            for block in self.rows:
                searcher = self.searcher(block)
                for k, p in enumerate(slots):
                    new = searcher.search(p.column(at).to_pylist())
                    if len(found) <= k:
                        found.append(new)
                    else:
                        found[k] = (new[0], *([join(a, b) for a, b in zip(x, y)]
                                              for join, x, y in ((_joined, found[k][1], new[1]), (_both, found[k][2], new[2]))))
            for p, f in zip(slots, found):
                yield p, *f


def _joined(a: list[int], b: list[int]) -> list[int]:
    """The union of two lists of flat [start, end) runs."""
    if not a or not b:
        return a or b
    out: list[int] = []
    for start, end in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _both(a: list[str], b: list[str]) -> list[str]:
    return sorted({*a, *b}) if a and b else a or b


def contaminated_words(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: the words inside occurrences of benchmark windows.

    Returns the id, ``n_words``, ``spans`` (hit runs of words, flat [start, end) pairs)
    and ``items`` (ids, as sorted strings, of the items with an occurring window).

    An item of fewer than ``window`` words is one window; one without words is none. Null
    texts have no words. Rows are judged one by one, so repeated rows repeat their result;
    items of one id count once, and windows of items without an id hit but name no item.
    Other columns are not read. An empty benchmark hits nothing.

    The benchmark's windows are a table in the shared folder, in blocks of those of about
    ``block_bytes`` characters of items. All blocks are searched in one pass over ``docs``
    without a shuffle; a task holds at most ``KEPT`` blocks at a time.
    """
    rows = docs.select(col(id_col).alias("_id"), col(text_col).cast("string").alias("_text"))
    blocks = Blocks.write(benchmark, item_col, item_text_col, window, block_bytes)

    def run(batches):
        for batch in batches:
            for part, counts, spans, items in blocks.search(batch, "_text"):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"),
                        pa.array(counts, pa.int64()),
                        pa.array(spans, pa.list_(pa.int64())),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["_id", "n_words", "spans", "items"],
                )

    schema = rows.drop("_text").schema.add("n_words", T.LongType())
    schema = schema.add("spans", T.ArrayType(T.LongType())).add("items", T.ArrayType(T.StringType()))
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and the digest of the items per document, from :func:`contaminated_words`."""
    found = contaminated_words(docs, benchmark, id_col)
    # Ends minus starts: the flat array holds them in turn.
    n_hit = F.expr(
        "aggregate(transform(spans, (x, i) -> if(i % 2 = 0, -x, x)), 0L, (n, x) -> n + x)"
    )
    return found.select(
        col(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns.

    All blocks of the benchmark are searched in one pass; nothing of ``docs`` is shuffled.
    Null texts hold no window and stay.
    """
    at = docs.columns.index(text_col)
    blocks = Blocks.write(benchmark, item_col, item_text_col, window, block_bytes)

    def run(batches):
        for batch in batches:
            for part, _, spans, _ in blocks.search(batch, at):
                yield part.filter(pa.array([not s for s in spans], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
