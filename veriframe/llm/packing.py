"""Documents packed into sequences of tokens: best-fit decreasing.

Best-fit decreasing takes the pieces from the longest to the shortest and puts each into the open sequence
with the least room that still holds it. What happens depends on the number of pieces of each length
alone, and all sequences with the same room are alike. So the placement is worked out once, on
the histogram of lengths (at most ``size`` rows, whatever the corpus), for whole runs of equal pieces
and equal sequences: a segment tree over the remaining capacities finds the tightest one in
logarithmic time, and as many pieces as fit go into each of its sequences. That is the same packing as
piece by piece over the whole corpus, not one per task.

The result is a list of slots: pieces ``first`` to ``first + n - 1`` of a length, ``per_sequence`` of them in each of
the sequences from ``sequence`` on, from ``offset``. Spark numbers the pieces of each length: a task
counts its own while it cuts the documents, the counts of earlier tasks are added by a join on task
and length, so not even a length that a third of all pieces share is numbered in one task.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from veriframe.llm.common import col, id_and_text, slices
from veriframe.session import durable

SIZE = 2048
END = 0
SLICE = 2 << 20
REMEMBERED = 400_000
REMEMBERED_BYTES = 64
CLOSING = b".,;:!?#$%&*)\"'"  # not | and >, which end the control strings
# Letters of Latin, Greek and Cyrillic alphabets that stay one letter in lower case (U+0130 does not).
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0391-\u03a1\u03a3-\u03a9\u03ac-\u03ce\u0400-\u0481]+")


def tokenizer_path() -> str:
    """The vocabulary among the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def lowered(text: bytes) -> bytes:
    """The text with A-Z lowered where that changes no ids, so that more words are known.

    The vocabulary lowers case itself, but composes marks first (U+0300 to U+036F, of lead bytes CC
    and CD, are all that compose with a letter of ASCII), and finds its control strings before that.
    """
    if b"\xcc" in text or b"\xcd" in text or b"<|" in text:
        return text
    return text.lower()


class Words:
    """Token ids of texts by the library, remembering those of frequent words.

    The vocabulary drops white space and never joins what stands on both sides of it, so a text's ids are
    those of its stretches between blanks, each encoded by the library. It always parts the marks that
    close a word from a letter before them, so the word is looked up without them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.library.get_vocab_size(with_added_tokens=True), bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # the generation before; what is used of it moves on

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Per text its ids, little-endian in 32 bits each."""
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
        known = self.known
        split = [lowered(t or b"").split() for t in texts]
        closed, wanted = [], set()
        for w in self._missing(set().union(*split)):
            core = w.rstrip(CLOSING)
            if len(core) < len(w) and (core[-1:].isalpha() or PLAIN.fullmatch(core.decode())):
                closed.append((w, core, w[len(core) :]))
                wanted.update(closed[-1][1:])
            else:
                wanted.add(w)
        new = self._missing(wanted)
        self._learn(new)
        known.update((w, known[core] + known[tail]) for w, core, tail in closed)
        out = [b"".join([known[w] for w in words]) for words in split]
        for w in [w for w in new if len(w) > REMEMBERED_BYTES] + [w for w, _, _ in closed if len(w) > REMEMBERED_BYTES]:
            del known[w]
        return out

    def _missing(self, wanted: set[bytes]) -> list[bytes]:
        """Those that are not known, once those of the generation before have moved on."""
        wanted = wanted.difference(self.known)
        self.known.update((w, self.older[w]) for w in wanted if w in self.older)
        return list(wanted.difference(self.known))

    def _learn(self, new: list[bytes]) -> None:
        """Words of plain letters are encoded as one text, as each ends at its one token with a word end; others word by word."""
        decoded = [w.decode() for w in new]
        letters = [PLAIN.fullmatch(w) is not None for w in decoded]
        plain = [w for w, p in zip(decoded, letters) if p]
        ids = np.array(self.library.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(plain):
            self._keep([w for w, p in zip(new, letters) if p], ids, ends)
        else:
            letters = [False] * len(new)
        rest = [w for w, p in zip(decoded, letters) if not p]
        found = self.library.encode(rest, is_pretokenized=True, add_special_tokens=False)
        ends = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(rest)), "right")
        self._keep([w for w, p in zip(new, letters) if not p], np.array(found.ids, "<u4"), ends)

    def _keep(self, learnt: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        self.known.update((w, raw[a:b]) for w, a, b in zip(learnt, [0, *ends], ends))


_words: dict[str, Words] = {}


def words(path: str) -> Words:
    """The worker's encoder; what it remembers serves later tasks too."""
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]


def pieces(
    df: DataFrame, tokenizer: str, size: int = SIZE, end: int = END, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The documents' token ids, cut after every ``size`` of them; written to the shared folder.

    Per piece: the id, ``piece`` (from 0), ``start`` (ids of the document before it), ``length``,
    ``ids_crc32`` (of the ids as unsigned 32-bit little-endian numbers), with ``with_ids`` the ``ids`` themselves, and
    ``_part`` and ``_nth``, the task that cut it and the piece's number among those of its length there.

    ``end`` closes every document, so a null or empty text is one piece of length 1. Rows are taken one
    by one: repeated ones, ties and null ids give pieces of their own; no rows give none; other
    columns are not read. A long text gives as many pieces as it needs; one task holds its ids.
    """
    if size < 1:
        raise ValueError("a sequence holds one token at least")
    rows = id_and_text(df, id_col, text_col)
    kind = rows.schema["_id"].dataType
    fields = [
        T.StructField("_id", kind), T.StructField("piece", T.IntegerType()),
        *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
        T.StructField("_part", T.IntegerType()), T.StructField("_nth", T.LongType()),
    ]
    schema = T.StructType(fields)
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                at, made = [], []
                for i, ids in enumerate(words(tokenizer).encode(part.column("_text").cast(pa.binary()).to_pylist())):
                    ids += last
                    for k in range(0, len(ids), 4 * size):
                        own = ids[k : k + 4 * size]
                        n = len(own) // 4
                        at.append(i)
                        made.append((k // (4 * size), k // 4, n, zlib.crc32(own), *([own] if with_ids else []), task, seen[n]))
                        seen[n] += 1
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else []), pa.int32(), pa.int64()]
                columns = list(zip(*made)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(pa.array(at, pa.int64())), *(pa.array(v, t) for v, t in zip(columns, types))],
                    names=schema.fieldNames(),
                )

    return durable(rows.mapInArrow(run, schema), "pieces").withColumnRenamed("_id", id_col)


class Capacities:
    """A segment tree over remaining capacities 0 to ``size``; a leaf holds the open sequences with that much room.

    Sequences are kept as intervals (first, n) of their numbers.
    """

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.some = [False] * (2 * self.width)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def _mark(self, room: int) -> None:
        node = room + self.width
        self.some[node] = bool(self.open[room])
        while node > 1:
            node //= 2
            self.some[node] = self.some[2 * node] or self.some[2 * node + 1]

    def put(self, room: int, first: int, n: int) -> None:
        self.open[room].append((first, n))
        if len(self.open[room]) == 1:
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        found = self.open[room].pop()
        if not self.open[room]:
            self._mark(room)
        return found

    def tightest(self, need: int) -> int | None:
        """The least room of ``need`` or more that an open sequence has."""
        node = need + self.width
        if not self.some[node]:
            while node > 1 and (node & 1 or not self.some[node + 1]):  # up to the first subtree further right
                node //= 2
            if node <= 1:
                return None
            node += 1
        while node < self.width:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        return node - self.width


class Slot(NamedTuple):
    length: int
    first: int
    n: int
    sequence: int
    per_sequence: int
    offset: int


def best_fit_decreasing(histogram: dict[int, int], size: int = SIZE) -> list[Slot]:
    """The slots of all pieces, given the number of pieces of each length."""
    room = Capacities(size)
    slots: list[Slot] = []
    sequences = 0
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} does not fit a sequence of {size}")
        first, left = 0, histogram[length]
        while left:
            r = room.tightest(length)
            if r is None:
                r, (sequence, n) = size, (sequences, -(-left // (size // length)))
                sequences += n
            else:
                sequence, n = room.take(r)
            # A sequence that has just taken a piece is the tightest again while it holds another.
            each = r // length
            whole = min(n, left // each)
            for count, per in ((whole, each), (1, left - whole * each if whole < n and left - whole * each < each else 0)):
                if count and per:
                    slots.append(Slot(length, first, count * per, sequence, per, size - r))
                    if r > per * length:
                        room.put(r - per * length, sequence, count)
                    sequence, n, first, left = sequence + count, n - count, first + count * per, left - count * per
            if n:
                room.put(r, sequence, n)
    return slots


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``cut`` (see :func:`pieces`) with ``sequence_id`` and ``offset``, its place in that sequence.

    Sequences are filled from 0 without gaps; they are numbered from 0 in the order in which they
    were opened. Only the histogram of lengths, ``size`` rows at most, reaches the driver.
    """
    per_task = cut.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    # A window per length over one row per task: never over pieces.
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("_part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    histogram = {r[0]: r[1] for r in cut.groupBy("length").agg(F.count(F.lit(1))).collect()}
    slots = best_fit_decreasing(histogram, size)
    # Sorted by length and first number, a piece's slot is the last one at or before it.
    table = np.array(sorted(slots), np.int64).reshape(-1, len(Slot._fields))
    lengths = table[:, 0].copy()
    numbered = cut.join(before, ["_part", "length"]).withColumn("_nth", F.col("_nth") + F.col("_before")).select(*map(col, cut.columns))
    names = cut.columns
    at_length, at_nth = names.index("length"), names.index("_nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(at_length).to_numpy()
            nth = batch.column(at_nth).to_numpy()
            slot = np.empty(len(length), np.int64)
            for n in np.unique(length):
                low, high = np.searchsorted(lengths, [n, n + 1])
                of_length = length == n
                slot[of_length] = low + np.searchsorted(table[low:high, 1], nth[of_length], "right") - 1
            _, first, _, sequence, per, offset = table[slot].T
            ahead, within = np.divmod(nth - first, per)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence + ahead, pa.int64()), pa.array(offset + within * length, pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    schema = T.StructType([*cut.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(run, schema).drop("_part", "_nth")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id``, ``n_pieces`` and ``ids``, its token ids, from pieces that carry theirs.

    A sequence holds ``size`` ids at most, and so many pieces at most.
    """
    in_order = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(in_order.alias("_pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = [b"".join(p["ids"] for p in row) for row in batch.column(1).to_pylist()]
            counts = batch.column(1).value_lengths().cast(pa.int32())
            ids = [np.frombuffer(j, "<u4").astype(np.int32) for j in joined]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(ids, pa.list_(pa.int32()))], names=["sequence_id", "n_pieces", "ids"]
            )

    return grouped.mapInArrow(run, "sequence_id bigint, n_pieces int, ids array<int>")
