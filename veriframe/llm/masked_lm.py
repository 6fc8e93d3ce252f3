"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network predicts every word from the words on both sides of it: their
embeddings go through one hidden layer, and the word's two-digit code is predicted
digit by digit, so that a vocabulary of BASE * BASE words costs two small softmaxes.
A document's score is the sum of the conditional log-probabilities of its words.

The WORDS most frequent words have a code of their own. All others take one of RARE codes
and further digits, all by hash; the number of further digits follows the number of distinct
words. As context such a word is its code's embedding plus those of its digits. As target the
further digits are predicted on top of their counted shares, and a word has its counted share
among the words with the same digits, which is joined from the table of all word counts.

Word counts come from the whole corpus. Training passes over the whole corpus, too:
the documents are dealt to ROUNDS shares; in each round every task starts from the
common weights, trains on every position of its documents in numpy, and the
results are averaged, weighted by examples, in a tree of tasks. Weights, the frequent words and
the counted shares of digits pass the driver; all are bounded. Counts of words stay in Spark.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.llm.common import id_and_text, importable, slices
from veriframe.llm.decontaminate import _FOLD
from veriframe.session import durable

BASE = 64  # digits of a word's code
RARE = 256  # codes shared by the words beyond the vocabulary, by hash
WORDS = BASE * BASE - RARE
DEEPEST = 2  # further digits of a rare word's code at most; their counted shares are broadcast
UNSEEN = 1e-3  # what digits that no counted word has weigh beside counts
CODE_BITS = 13  # a word's number holds its code in the low bits and further digits above
SIDE = 2  # words seen on either side
EMBEDDING, HIDDEN = 12, 24
ROUNDS = 3
RATE = 0.15
BATCH = 1_024
SLICES = 16  # parts the weights are averaged in
FAN_IN = 64  # results added up by one task

SHAPES = {
    "embedding": (BASE * BASE + 1, EMBEDDING),  # the last row stands beyond a text's ends
    "hidden": (2 * SIDE * EMBEDDING, HIDDEN),
    "hidden_bias": (HIDDEN,),
    "first": (HIDDEN, BASE),
    "first_bias": (BASE,),
    "given": (BASE, HIDDEN),  # shifts the hidden layer by the first digit
    "second": (HIDDEN, BASE),
    "second_bias": (BASE,),
}
N_WEIGHTS = sum(math.prod(s) for s in SHAPES.values())
OUTSIDE = BASE * BASE
FLOOR = np.float32(math.log(1e-30))  # least log-probability of a code or digit
_ONES = np.ones(BASE, np.float32)
_STARTS = np.arange(0, BATCH * BASE, BASE)
_OFFSETS = np.array([d for d in range(-SIDE, SIDE + 1) if d])


def shapes(depth: int) -> dict[str, tuple[int, ...]]:
    """The weights of a network whose rare words have ``depth`` further digits."""
    out = dict(SHAPES)
    for k in range(depth):
        out[f"digit_{k}"] = (BASE, EMBEDDING)  # a rare word as context
        out[f"given_{k}"] = (BASE, HIDDEN)  # shifts the hidden layer by the digit before
        out[f"deep_{k}"] = (HIDDEN, BASE)  # moves the digit's counted shares
    return out


def n_weights(depth: int) -> int:
    return sum(math.prod(s) for s in shapes(depth).values())


def depth_for(n_rare: int) -> int:
    """Further digits for so many distinct rare words."""
    depth = 0
    while depth < DEEPEST and n_rare > RARE * BASE**depth:
        depth += 1
    return depth


def digit_shares(leaves: np.ndarray) -> list[np.ndarray]:
    """Per further digit its log shares given the digits before, from counts by (code, digits)."""
    depth = round(math.log(leaves.size // RARE, BASE))
    out = []
    for k in range(depth):
        n = leaves.reshape(RARE * BASE**k, BASE, -1).sum(2) + UNSEEN
        out.append(np.log(n / n.sum(1, keepdims=True)).astype(np.float32))
    return out


class Network:
    """Weights as one flat array, seen through named views."""

    def __init__(self, flat: np.ndarray | None = None, priors: list[np.ndarray] | None = None):
        self.priors = priors or []  # of digit_shares()
        self.shapes = shapes(len(self.priors))
        if flat is None:
            rng = np.random.default_rng(5)
            flat = rng.normal(0, 0.1, n_weights(len(self.priors))).astype(np.float32)
            at = self._views(flat)
            for k in range(len(self.priors)):
                at[f"deep_{k}"][:] = 0  # the counted shares alone
        self.flat = flat.astype(np.float32).copy()
        self.w = self._views(self.flat)

    def _views(self, flat: np.ndarray, skip: int = 0) -> dict[str, np.ndarray]:
        """Views of an array of all weights but the first ``skip``; ``_all`` is a matrix with its bias as last row."""
        out, at = {}, 0
        for name, shape in list(self.shapes.items())[skip:]:
            n = math.prod(shape)
            out[name] = flat[at : at + n].reshape(shape)
            if f"{name}_bias" in self.shapes:  # follows at once
                out[f"{name}_all"] = flat[at : at + n + shape[1]].reshape(-1, shape[1])
            at += n
        return out

    def start(self) -> np.ndarray:
        """Sums of squares to train from; those of the counted shares' shifts keep first steps small."""
        seen = np.full(self.flat.size, 1e-6, np.float32)
        at = self._views(seen)
        for k in range(len(self.priors)):
            at[f"deep_{k}"][:] = 1e-2
        return seen

    def _embedded(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """(codes, where words have further digits, those digits, embeddings) of a flat array of words."""
        w = self.w
        code = around & (1 << CODE_BITS) - 1
        x = w["embedding"].take(code, 0)
        rare, digits = None, []
        if self.priors:
            rare = np.flatnonzero((code >= WORDS) & (code < OUTSIDE))
            further = around[rare] >> CODE_BITS
            digits = [further // BASE**k % BASE for k in range(len(self.priors))]
            more = w["digit_0"].take(digits[0], 0)
            for k in range(1, len(digits)):
                more += w[f"digit_{k}"].take(digits[k], 0)
            more += x.take(rare, 0)
            x[rare] = more
        return code, rare, digits, x

    def _activated(self, z: np.ndarray) -> np.ndarray:
        """The hidden layer from its weighted inputs, and a last column of ones, which meets the biases."""
        z += self.w["hidden_bias"]
        h = np.empty((len(z), HIDDEN + 1), np.float32)
        h[:, HIDDEN] = 1
        np.tanh(z, out=h[:, :HIDDEN])
        return h

    def _further(self, g: np.ndarray, target: np.ndarray):
        """Per further digit (layer, digit before, digit, scores) of rare targets with the layer ``g``."""
        goal, further = target & (1 << CODE_BITS) - 1, target >> CODE_BITS
        prefix, last = goal - WORDS, goal % BASE
        for k, prior in enumerate(self.priors):
            digit = further // BASE**k % BASE
            g = g + self.w[f"given_{k}"].take(last, 0)
            z = g @ self.w[f"deep_{k}"]
            z += prior.take(prefix, 0)
            yield g, last, digit, z
            prefix, last = prefix * BASE + digit, digit

    def _log_probability(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Per target its log-probability; the hidden layers ``h`` are overwritten."""
        w = self.w
        goal = target & (1 << CODE_BITS) - 1
        one, two = goal // BASE, goal % BASE
        out = _log_shares(h @ w["first_all"], one)
        h[:, :HIDDEN] += w["given"].take(one, 0)
        out += _log_shares(h @ w["second_all"], two)
        np.maximum(out, FLOOR, out=out)
        if self.priors:
            at = np.flatnonzero(goal >= WORDS)
            if len(at):
                more = np.zeros(len(at), np.float32)
                for _, _, digit, z in self._further(h[:, :HIDDEN].take(at, 0), target[at]):
                    more += np.maximum(_log_shares(z, digit), FLOOR)
                out[at] += more
        return out

    def log_probability(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        x = self._embedded(around.ravel())[3].reshape(len(target), -1)
        return self._log_probability(self._activated(x @ self.w["hidden"]), target)

    def along(self, line: np.ndarray) -> np.ndarray:
        """The log-probabilities of all words of a line but the SIDE outer ones, 0 for gaps: neighbours share embeddings."""
        n = len(line) - 2 * SIDE
        x = self._embedded(line)[3]
        parts = self.w["hidden"].reshape(-1, EMBEDDING, HIDDEN)
        z = x[:n] @ parts[0]
        for d, part in zip(_OFFSETS[1:].tolist(), parts[1:]):
            z += x[SIDE + d : SIDE + d + n] @ part
        target = line[SIDE : SIDE + n]
        gap = target == OUTSIDE
        out = self._log_probability(self._activated(z), np.where(gap, 0, target))
        out[gap] = 0
        return out

    def train(self, around: np.ndarray, target: np.ndarray, seen: np.ndarray) -> None:
        """One Adagrad step on a batch; ``seen`` holds the sums of squares."""
        w, n = self.w, len(target)
        goal = target & (1 << CODE_BITS) - 1
        order = goal.astype(np.int16).argsort(kind="stable")  # equal first digits side by side, rare words last
        around, target, goal = around[order], target[order], goal[order]
        one, two = goal // BASE, goal % BASE
        code, rare, digits, x = self._embedded(around.ravel())
        x = x.reshape(n, -1)
        h = self._activated(x @ w["hidden"])
        g = h.copy()
        g[:, :HIDDEN] += w["given"].take(one, 0)
        p1 = _errors(h @ w["first_all"], one, n)
        p2 = _errors(g @ w["second_all"], two, n)
        grad = np.zeros(self.flat.size - w["embedding"].size, np.float32)
        v = self._views(grad, 1)
        dg = p2 @ w["second"].T
        start = int(goal.searchsorted(WORDS))
        if self.priors and start < n:
            deep = list(self._further(g[start:, :HIDDEN], target[start:]))
            du = None
            for k in range(len(deep) - 1, -1, -1):
                u, last, digit, z = deep[k]
                p = _errors(z, digit, n)
                own = p @ w[f"deep_{k}"].T
                du = own if du is None else du + own
                np.matmul(u.T, p, out=v[f"deep_{k}"])
                v[f"given_{k}"][:] = _row_sums(last, np.ascontiguousarray(du.T), BASE).T
            dg[start:] += du
        dh = p1 @ w["first"].T
        dh += dg
        dh *= (1 - h * h)[:, :HIDDEN]
        np.matmul(h.T, p1, out=v["first_all"])
        np.matmul(g.T, p2, out=v["second_all"])
        begin = np.append(0, np.flatnonzero(one[1:] != one[:-1]) + 1)
        v["given"][one[begin]] = np.add.reduceat(dg, begin, axis=0)
        np.matmul(x.T, dh, out=v["hidden"])
        np.matmul(np.ones(n, np.float32), dh, out=v["hidden_bias"])
        # A row per component of the embeddings, all words at the first offset in front: sums then run along whole rows.
        back = w["hidden"].reshape(-1, EMBEDDING, HIDDEN).transpose(1, 0, 2).reshape(-1, HIDDEN)
        dx = (back @ dh.T).reshape(EMBEDDING, -1)
        code = code.reshape(n, -1).T.ravel()
        if len(digits):
            offset = 2 * SIDE
            more = dx.take(rare % offset * n + rare // offset, 1)
            for k, digit in enumerate(digits):
                v[f"digit_{k}"][:] = _row_sums(digit, more, BASE).T
        met = np.zeros(BASE * BASE + 1, bool)
        met[code] = True
        rows = np.flatnonzero(met)
        d = _row_sums(code, dx, BASE * BASE + 1).take(rows, 1).T.astype(np.float32, order="C")
        rest = w["embedding"].size
        squares = seen[:rest].reshape(-1, EMBEDDING)
        sums = squares.take(rows, 0)
        sums += d * d
        squares[rows] = sums
        w["embedding"][rows] = w["embedding"].take(rows, 0) - np.float32(RATE) * d / np.sqrt(sums)
        sums = seen[rest:]
        sums += grad * grad
        self.flat[rest:] -= np.float32(RATE) * grad / np.sqrt(sums)


def _row_sums(index: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``columns`` by the index of their places, as a table of ``n`` columns."""
    width = len(columns)
    at = np.arange(0, width * n, n)[:, None] + index
    return np.bincount(at.ravel(), columns.ravel(), n * width).reshape(width, n)


def _exponentials(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(z) and its row sums; rows of ``z`` are first shifted by their maxima if float32 is too narrow."""
    e = np.exp(z)
    total = e @ _ONES
    if len(z) and not (np.minimum.reduce(total) > 1e-30 and np.maximum.reduce(total) < 1e30):
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=e)
        total = e @ _ONES
    return e, total


def _places(z: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return (_STARTS[: len(z)] if len(z) <= BATCH else np.arange(0, z.size, BASE)) + chosen


def _log_shares(z: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Per row of ``z`` the log of the softmax at the chosen column."""
    _, total = _exponentials(z)
    return z.ravel()[_places(z, chosen)] - np.log(total)


def _errors(z: np.ndarray, chosen: np.ndarray, n: int) -> np.ndarray:
    """The softmax of the rows of ``z`` less one at the chosen columns, over ``n``."""
    e, total = _exponentials(z)
    e *= (1 / (total * np.float32(n)))[:, None]
    e.ravel()[_places(z, chosen)] -= np.float32(1 / n)
    return e


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words in turn, words per text): decontaminate.words_of() of all texts at once."""
    texts = pa.compute.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = memoryview(texts.buffers()[2] or b"")[ends[0] : ends[-1]]
    folded = np.frombuffer(bytes(data).translate(_FOLD), np.uint8)
    edges = ends - ends[0]
    inside = folded != 32
    # Where a word begins, and the place behind each word's end; words never span two texts.
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    inner = edges[(edges > 0) & (edges < len(folded))]
    begins[inner] = inside[inner]
    closes[inner - 1] = inside[inner - 1]
    at = np.flatnonzero(begins)
    sizes = np.flatnonzero(closes) + 1 - at
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
    words = pa.Array.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(folded[inside])]
    )
    return words, np.diff(np.searchsorted(at, edges))


class Coder:
    """Numbers of words; words beyond the vocabulary share RARE codes and have ``depth`` digits, by hash."""

    def __init__(self, vocabulary: dict[bytes, int], depth: int = 0):
        self.frequent = pa.array(list(vocabulary), pa.large_binary())
        self.codes = np.array([*vocabulary.values(), -1], np.int32)
        self.depth = depth

    def known(self, words: pa.Array) -> np.ndarray:
        """Codes of the vocabulary's words, -1 for others."""
        return self.codes[pa.compute.fill_null(pa.compute.index_in(words, value_set=self.frequent), -1).to_numpy()]

    def __call__(self, words: pa.Array) -> np.ndarray:
        ids = self.known(words)
        beyond = np.flatnonzero(ids < 0)
        if len(beyond):
            _, offsets, data = words.buffers()
            offsets, data = np.frombuffer(offsets, np.int64), data.to_pybytes()
            spans = zip(offsets[beyond].tolist(), offsets[beyond + 1].tolist())
            crc = np.array([zlib.crc32(data[a:b]) for a, b in spans], np.int64)
            ids[beyond] = WORDS + crc % RARE + ((crc // RARE % BASE**self.depth) << CODE_BITS)
        return ids


def word_ids(text: str | None, vocabulary: dict[bytes, int], depth: int = 0) -> np.ndarray:
    """Numbers of a text's words."""
    texts = pa.array([None if text is None else text.encode("utf-8", "surrogatepass")], pa.binary())
    return Coder(vocabulary, depth)(words_in(texts)[0])


def laid_out(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all words with gaps, positions of words) from the words of texts in turn: windows never leave a text."""
    position = np.arange(len(ids)) + SIDE * np.repeat(np.arange(1, len(sizes) + 1), sizes)
    line = np.full(len(ids) + SIDE * (len(sizes) + 1), OUTSIDE, np.int64)
    line[position] = ids
    return line, position


def scores(ids: list[np.ndarray], net: Network) -> np.ndarray:
    """Per text the sum of log-probabilities of codes and digits."""
    return sums_along(np.concatenate(ids), np.array([len(i) for i in ids]), net)


def sums_along(ids: np.ndarray, sizes: np.ndarray, net: Network) -> np.ndarray:
    """scores() of texts given as all their words in turn and the words per text."""
    line, _ = laid_out(ids, sizes)
    value = np.zeros(len(line))
    with np.errstate(over="ignore"):  # looked at by _exponentials()
        for a in range(SIDE, len(line) - SIDE, BATCH):
            b = min(a + BATCH, len(line) - SIDE)
            value[a:b] = net.along(line[a - SIDE : b + SIDE])
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes + SIDE), value[SIDE:], len(sizes))


# ---- jobs ----------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts in ``_text``, counted per slice of texts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 16 << 20):
                met = words_in(part.column("_text"))[0].value_counts()
                yield pa.RecordBatch.from_arrays([met.field(0).cast(pa.binary()), met.field(1)], names=["word", "n"])

    return texts.select("_text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _added(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of ``values`` (float64 bytes) and ``n`` per key, each read as a stream."""
    dealt = parts.select(*keys, "n", "values").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n, total = None, 0, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*(pa.array([k], pa.int32()) for k in current), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                names=[*keys, "n", "values"],
            )

        for batch in batches:
            for *key, m, values in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(values, np.float64)
                if key != current:
                    if current is not None:
                        yield row()
                    current, n, total = key, 0, np.zeros_like(own)
                n += m
                total += own
        if current is not None:
            yield row()

    return dealt.mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", n bigint, values binary")


def _round(texts: DataFrame, net: Network, vocabulary: dict[bytes, int], number: int) -> Network:
    """The weights after one round over ``texts``."""
    shared = texts.sparkSession.sparkContext.broadcast((net.flat, net.priors, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        flat, priors, words = shared.value
        own, examples, coder = Network(flat, priors), 0, Coder(words, len(priors))
        seen = own.start()
        task = TaskContext.get().partitionId()
        rng = np.random.default_rng((number, task))
        for batch in batches:
            for part in slices(batch, "_text", 4 << 20):
                found, sizes = words_in(part.column("_text"))
                line, position = laid_out(coder(found), sizes)
                chosen = rng.permutation(position)
                with np.errstate(over="ignore"):  # looked at by _exponentials()
                    for a in range(0, len(chosen), BATCH):
                        at = chosen[a : a + BATCH]
                        own.train(line[at[:, None] + _OFFSETS], line[at], seen)
                examples += len(chosen)
        if examples:
            parts = np.array_split(own.flat.astype(np.float64) * examples, SLICES)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(SLICES), pa.int32()), pa.array([task] * SLICES, pa.int32()),
                    pa.array([examples] * SLICES, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=["slice", "task", "n", "values"],
            )

    # Written, so that the tree below does not train again.
    made = durable(texts.mapInArrow(run, "slice int, task int, n bigint, values binary"), "weights")
    widest = made.agg(F.max("task")).first()[0]
    while widest is not None and widest >= FAN_IN:
        made = _added(made.withColumn("task", (F.col("task") / FAN_IN).cast("int")), ["slice", "task"])
        widest //= FAN_IN
    rows = sorted(_added(made, ["slice"]).collect(), key=lambda r: r["slice"])  # SLICES rows of fixed size
    if not rows:
        return net
    return Network(np.concatenate([np.frombuffer(r["values"], np.float64) / r["n"] for r in rows]), net.priors)


def _leaf(depth: int) -> F.Column:
    """A rare word's code and further digits, first digit first, as one number."""
    crc = F.crc32("word")
    out = F.pmod(crc, F.lit(RARE))
    for k in range(depth):
        out = out * BASE + F.pmod(F.floor(crc / F.lit(RARE * BASE**k)), F.lit(BASE))
    return out.cast("int")


def _rare_words(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(word, keys, alsos, counts): the words beyond the vocabulary and, per slice of texts, the rows that hold them."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            for part in slices(batch, "_text", 8 << 20):
                words, sizes = words_in(part.column("_text"))
                beyond = np.flatnonzero(coder.known(words) < 0)
                rare = words.take(pa.array(beyond)).dictionary_encode()
                text = np.repeat(np.arange(len(sizes)), sizes)[beyond]
                # Pairs of a word and a text, by word; equal ones are counted.
                pairs = rare.indices.to_numpy().astype(np.int64) * len(sizes) + text
                pairs, n = np.unique(pairs, return_counts=True)
                word, text = np.divmod(pairs, max(len(sizes), 1))
                begin = np.flatnonzero(np.diff(word, prepend=-1))
                ends = pa.array(np.append(begin, len(word)), pa.int32())
                text = pa.array(text)
                columns = [part.column("_key").take(text), part.column("_also").take(text), pa.array(n, pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [
                        rare.dictionary.cast(pa.binary()),
                        *(pa.ListArray.from_arrays(ends, c) for c in columns),
                    ],
                    names=["word", "keys", "alsos", "counts"],
                )

    return rows.select("_key", "_also", "_text").mapInArrow(
        run, "word binary, keys array<bigint>, alsos array<int>, counts array<int>"
    )


class Model:
    """Trained weights and the vocabulary they belong to.

    ``shares`` holds, per word beyond the vocabulary, the log of its counted share (``share``) among the
    words with its code and digits. A word that was never counted has the ``rare_share``-th part.
    """

    def __init__(
        self, net: Network, vocabulary: dict[bytes, int], rare_share: float, shares: DataFrame | None = None
    ):
        self.net, self.vocabulary, self.rare_share, self.shares = net, vocabulary, rare_share, shares


def fitted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> Model:
    """Count words over all texts and train over all of them, each in one of ``rounds`` rounds."""
    importable(df.sparkSession)
    rows = id_and_text(df, id_col, text_col)
    counts = durable(word_counts(rows), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    vocabulary = {bytes(r["word"]): i for i, r in enumerate(top)}
    n_rare = counts.count() - len(vocabulary)
    depth = depth_for(n_rare)
    n_leaves = RARE * BASE**depth
    rare_share = max(1.0, n_rare / n_leaves)
    shares, leaves = None, np.zeros(n_leaves)
    if n_rare:
        # The last of the frequent words, in the order they were picked in, ends them.
        n, word = F.lit(top[-1]["n"]), F.lit(bytes(top[-1]["word"]))
        rare = counts.filter((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))
        rare = rare.withColumn("leaf", _leaf(depth))
        sums = durable(rare.groupBy("leaf").agg(F.sum("n").alias("n_leaf")), "leaves")
        table = sums.toArrow()  # at most RARE * BASE ** DEEPEST rows of two numbers
        leaves[table.column("leaf").to_numpy()] = table.column("n_leaf").to_numpy()
        shares = rare.join(sums, "leaf").select("word", F.log(F.col("n") / F.col("n_leaf")).alias("share"))
    net = Network(priors=digit_shares(leaves))
    for k in range(rounds):
        share = rows.filter(F.pmod(F.xxhash64("_id", "_text"), F.lit(rounds)) == k)
        net = _round(share.select("_text"), net, vocabulary, k)
    return Model(net, vocabulary, rare_share, shares)


def score(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None
) -> DataFrame:
    """Per row: the id, ``n_words``, ``log_likelihood`` and ``per_word`` (null without words).

    ``log_likelihood`` is the masked pseudo-log-likelihood: every word's log-probability given
    the SIDE words before and after it, summed. Null and empty texts have no words and score 0.
    Rows are scored one by one: repeated rows repeat; other columns are not read; an empty table
    gives an empty one. Without a ``model`` one is fitted to the table itself; its weights depend
    slightly on how the table is partitioned.
    """
    importable(df.sparkSession)
    model = model or fitted(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast((model.net.flat, model.net.priors, model.vocabulary))
    rows = id_and_text(df, id_col, text_col)
    rows = rows.withColumns({"_key": F.xxhash64("_id", "_text"), "_also": F.hash("_text", "_id")})
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, priors, words = shared.value
        net, coder = Network(flat, priors), Coder(words, len(priors))
        for batch in batches:
            for part in slices(batch, "_text", 4 << 20):
                found, sizes = words_in(part.column("_text"))
                ids = coder(found)
                rare = np.bincount(np.repeat(np.arange(len(sizes)), sizes), (ids & (1 << CODE_BITS) - 1) >= WORDS, len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"), part.column("_key"), part.column("_also"),
                        pa.array(sizes, pa.int64()), pa.array(rare.astype(np.int64)),
                        pa.array(sums_along(ids, sizes, net), pa.float64()),
                    ],
                    names=["_id", "_key", "_also", "n_words", "n_rare", "value"],
                )

    made = rows.mapInArrow(
        run, f"_id {kind}, _key bigint, _also int, n_words bigint, n_rare bigint, value double"
    )
    unseen = F.lit(-math.log(model.rare_share))
    if model.shares is None:
        total = F.col("value") + F.col("n_rare") * unseen
    else:
        # A word's share meets a row per slice of texts, not one per text; shares are few beside the words met.
        part = _rare_words(rows, model.vocabulary).join(model.shares.hint("shuffle_hash"), "word", "left")
        part = part.select("share", "alsos", "counts", F.posexplode("keys").alias("at", "_key")).select(
            "_key", F.col("alsos")[F.col("at")].alias("_also"), F.col("counts")[F.col("at")].alias("n"), "share"
        )
        # Repeated rows meet here under one key; their words then count as often as the rows repeat.
        part = part.groupBy("_key", "_also").agg(
            F.sum("n").alias("n_met"), F.sum(F.col("n") * F.coalesce("share", unseen)).alias("rare")
        )
        made = made.join(part, ["_key", "_also"], "left")
        total = F.col("value") + F.coalesce(F.col("rare") * F.col("n_rare") / F.col("n_met"), F.lit(0.0))
    made = made.withColumn("log_likelihood", total)
    return made.select(
        F.col("_id").alias(id_col), "n_words", "log_likelihood",
        F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("per_word"),
    )
