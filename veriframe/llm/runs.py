"""Periodic runs of words: stretches that repeat their first words four times or more.

Seed and extend on diagonals. A run of smallest period q has max(6, 4 q) words at least, so on the
diagonal of lag q (word i against word i + q) it has an unbroken overlap of max(6, 4 q) - q words.
Lags are taken in classes; the guaranteed overlap of a class's smallest lag is the length k of the
word k-grams that are indexed for it, and a class ends at lag k.

Only neighbouring occurrences of a k-gram in one document are paired, so pairs grow with the words
and never with their square. That loses nothing: inside a run of smallest period q <= k, a further
occurrence d < q words behind the first would give a stretch of d + k words the periods d and q, so
(Fine and Wilf) their common divisor, and with it the whole run, against q being the smallest. For the
same reason a stretch found at the distance of neighbouring occurrences has no smaller period.

Each pair is extended along its diagonal to the first difference on either side; a table of the
furthest word covered per lag drops the pairs of stretches that are already known. K-grams are
compared by rank, not by hash: the rank of a gram of 2 m words is that of its two halves, and words that
occur once in their document leave the index at once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from veriframe.llm.common import id_and_text, slices

MIN_WORDS = 6
EXPONENT = 4
SLICE = 2 << 20

Run = tuple[int, int, int]  # first word, length, period


def lag_classes(n: int) -> Iterator[tuple[int, int, int]]:
    """(smallest lag, largest lag, k) of each class, as far as ``n`` words can hold a run."""
    low = 1
    while max(MIN_WORDS, EXPONENT * low) <= n:
        k = max(MIN_WORDS, EXPONENT * low) - low
        yield low, k, k
        low = k + 1


def _first_difference(w: np.ndarray, at: int, lag: int) -> int:
    """The first x >= at where word x and word x + lag differ, or where there is no such word."""
    end, step = len(w) - lag, 32
    while at < end:
        to = min(end, at + step)
        differ = w[at:to] != w[at + lag : to + lag]
        if differ.any():
            return at + int(differ.argmax())
        at, step = to, step * 2
    return at


def _last_difference(w: np.ndarray, at: int, lag: int) -> int:
    """The smallest s so that words s to at - 1 all equal those a lag behind."""
    step = 32
    while at > 0:
        to = max(0, at - step)
        differ = w[to:at] != w[to + lag : at + lag]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = to, step * 2
    return at


def _pairs(ranks: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in order of the gram made of ranks i and i + apart, and whether each equals the one before."""
    if len(ranks) <= apart:
        return np.empty(0, np.int64), np.empty(0, bool)
    at = np.flatnonzero((ranks[:-apart] >= 0) & (ranks[apart:] >= 0))
    keys = ranks[at] * np.int64(len(ranks)) + ranks[at + apart]
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    return at, np.r_[False, keys[1:] == keys[:-1]][: len(at)]


def _doubled(ranks: np.ndarray, size: int) -> np.ndarray:
    """Ranks of grams of ``2 * size`` words from those of ``size``; -1 where the gram occurs once."""
    at, same = _pairs(ranks, size)
    out = np.full(len(ranks), -1, np.int64)
    often = same | np.r_[same[1:], False][: len(same)]
    out[at[often]] = np.cumsum(~same)[often]
    return out


def find_runs(w: np.ndarray) -> list[Run]:
    """All runs among word numbers ``w``, in order of start and period.

    Several documents may stand behind each other if no word number occurs in two of them:
    then no gram and no diagonal crosses from one into the next.
    """
    runs: list[Run] = []
    counts = np.bincount(w) if len(w) else np.empty(0, np.int64)
    ranks, size = np.where(counts[w] > 1, w, -1), 1
    for low, high, k in lag_classes(len(w)):
        while 2 * size <= k:
            ranks, size = _doubled(ranks, size), 2 * size
        at, same = _pairs(ranks, k - size) if k > size else _single(ranks)
        if not same.any():
            break  # no gram of k words occurs twice, so no longer one does
        later = at[same]
        earlier = at[np.flatnonzero(same) - 1]
        lags = later - earlier
        fits = (lags >= low) & (lags <= high)
        earlier, lags = earlier[fits], lags[fits]
        order = np.lexsort((earlier, lags))
        covered: dict[int, int] = {}
        for p, lag in zip(earlier[order].tolist(), lags[order].tolist()):
            if p < covered.get(lag, 0):
                continue
            start, end = _last_difference(w, p, lag), _first_difference(w, p + k, lag)
            covered[lag] = end
            length = end - start + lag
            if length >= max(MIN_WORDS, EXPONENT * lag):
                runs.append((start, length, lag))
    runs.sort(key=lambda r: (r[0], r[2]))
    return runs


def _single(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_pairs`, for grams whose rank is known already."""
    at = np.flatnonzero(ranks >= 0)
    at = at[np.argsort(ranks[at], kind="stable")]
    return at, np.r_[False, ranks[at][1:] == ranks[at][:-1]][: len(at)]


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest exact length / period; ties: smallest start, then period."""

    def less(a: Run, b: Run) -> int:
        return b[1] * a[2] - a[1] * b[2] or a[0] - b[0] or a[2] - b[2]

    return min(runs, key=cmp_to_key(less), default=None)


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words with a run planted into every tenth document or so, drawn by its id; none for a null id."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


Change = Callable[[object, list[bytes]], list[bytes]]


def _searched(ids: list, texts: list[bytes | None], change: Change | None) -> Iterator[tuple[list[bytes], list[Run]]]:
    """Words and runs of each text; the words of all texts are searched together."""
    split, numbers, ends, total = [], [], [], 0
    for key, text in zip(ids, texts):
        words = (text or b"").split()  # bytes split at space and \t to \r, no others
        if change:
            words = change(key, words)
        known: dict[bytes, int] = {}
        numbers.append(np.array([known.setdefault(x, len(known)) for x in words], np.int64) + total)
        total += len(known)
        split.append(words)
        ends.append(len(words))
    starts = np.concatenate([[0], np.cumsum(ends)])
    runs = find_runs(np.concatenate(numbers)) if numbers else []
    first = np.searchsorted(starts, [r[0] for r in runs], "right") - 1
    of_text: list[list[Run]] = [[] for _ in split]
    for i, (start, length, period) in zip(first.tolist(), runs):
        of_text[i].append((start - int(starts[i]), length, period))
    return zip(split, of_text)


def _mapped(df: DataFrame, id_col: str, text_col: str, fields: list[T.StructField], arrays, change: Change | None) -> DataFrame:
    rows = id_and_text(df, id_col, text_col)
    schema = T.StructType([T.StructField(id_col, rows.schema["_id"].dataType), *fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                ids = part.column("_id")
                keys = ids.to_pylist() if change else [None] * len(ids)
                found = _searched(keys, part.column("_text").cast(pa.binary()).to_pylist(), change)
                yield pa.RecordBatch.from_arrays(arrays(ids, list(found)), names=names)

    return rows.mapInArrow(run, schema)


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run: the id, ``start`` (word number from 0), ``length`` and ``period``.

    Words are what stands between ASCII blanks. A null or empty text has no words and no runs. Rows
    are searched one by one, so repeated rows repeat theirs; an empty table gives an empty one; other
    columns are not read. A text is held by one task, whatever its length; memory and time grow with
    its words.
    """

    def arrays(ids: pa.Array, found: list):
        at = pa.array([i for i, (_, r) in enumerate(found) for _ in r], pa.int64())
        flat = [x for _, r in found for x in r]
        return [ids.take(at), *(pa.array([x[k] for x in flat], pa.int64()) for k in range(3))]

    return _mapped(df, id_col, text_col, _long("start", "length", "period"), arrays, None)


def collapsed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``collapsed``, the words without the repetitions of their runs, joined by blanks.

    Rows as in :func:`runs`; a null text gives an empty one.
    """

    def arrays(ids: pa.Array, found: list):
        return [ids, pa.array([b" ".join(collapse(w, r)) for w, r in found], pa.binary()).cast(pa.string())]

    return _mapped(df, id_col, text_col, [T.StructField("collapsed", T.StringType())], arrays, None)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Change | None = None) -> DataFrame:
    """Per row: ``n_runs``, the strongest run, and SHA-256 digests of all runs and of the collapsed words.

    ``start``, ``length``, ``period`` and ``exponent_milli`` are null without a run. The runs are hashed as
    ``start,length,period`` and a newline each. ``change`` alters a row's words first, given its id.
    Rows as in :func:`runs`.
    """
    fields = [
        *_long("n_runs", "start", "length", "period", "exponent_milli"),
        T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType()),
    ]

    def arrays(ids: pa.Array, found: list):
        best = [strongest(r) or (None, None, None) for _, r in found]
        milli = [1000 * length // period if period else None for _, length, period in best]
        listed = ["".join(f"{s},{n},{p}\n" for s, n, p in r).encode() for _, r in found]
        numbers = [[len(r) for _, r in found], *zip(*best), milli] if best else [[]] * 5
        return [
            ids, *(pa.array(v, pa.int64()) for v in numbers),
            pa.array([hashlib.sha256(x).hexdigest() for x in listed], pa.string()),
            pa.array([hashlib.sha256(b" ".join(collapse(w, r))).hexdigest() for w, r in found], pa.string()),
        ]

    return _mapped(df, id_col, text_col, fields, arrays, change)
