"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised (blanks become U+2581, one is put in front), split into
symbols and merged by a score-ordered agenda: of all adjacent pairs whose
concatenation is a piece, the one with the highest score is merged, the leftmost
on ties, until none is left. Symbols outside the vocabulary become byte pieces,
or the unknown piece where the vocabulary has no bytes.

Texts are cut where no piece of the vocabulary spans the border, so that no merge
can cross it: before a run of U+2581, before punctuation, and around characters
that occur in no piece. Each cut is encoded once and remembered, up to a fixed
number of cuts per worker. Every cut that is encoded is also given to the
sentencepiece library, in one call per slice of an Arrow batch; a difference
stops the job.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from veriframe.llm.common import col, free_name, id_and_text, slices

SPACE = "▁"
REMEMBERED = 200_000  # cuts a worker keeps, in two generations; some 80 MB
SLICE = 1 << 20  # bytes of text encoded at once
REMEMBERED_CHARS = 48  # longer cuts are encoded each time
SCANNED = 40  # symbols up to which scanning an agenda is quicker than a heap
NEVER = float("inf")
CHECKED = 1_000  # cuts joined for one text of the comparison
PUNCTUATION = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
OUTSIDERS = "\n\t\x01\x02"  # characters that rarely belong to a vocabulary


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """Where the installed collection of public tokenizers keeps a model."""
    import public_tokenizers

    return public_tokenizers.path(name)


class MergeVocabulary:
    """Pieces, scores and settings of a model file; refuses what it cannot encode exactly."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp = self.library
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = {
            i for i in range(len(self.pieces))
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        }
        self.bytes = {
            int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces)) if sp.is_byte(i)
        }
        self.values = {i: b for b, i in self.bytes.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.scores = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.costs = {p: -c for p, c in self.scores.items()}
        self.unknown, self.end, self.controls = sp.unk_id(), sp.eos_id(), special - set(self.bytes.values())
        self.aside = self.controls | set(self.values)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece spans a word border; texts cannot be cut there")
        if len(self.bytes) not in (0, 256):
            raise ValueError("byte pieces are incomplete")
        self._find_borders()
        probe = "  Aﬁ  b\tc\n "
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only identity normalisation with a blank in front is supported")

    def normalise(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def _find_borders(self) -> None:
        """Compile the pattern of parts that no piece reaches beyond."""
        used = set().union(*self.ids)
        outside = [c for c in OUTSIDERS if c not in used]
        if not outside:
            raise ValueError("no character is left to set cuts apart in the comparison")
        self.apart = outside[0]
        marks, size = set(PUNCTUATION), 0
        while size != len(marks):
            size = len(marks)
            for p in self.ids:
                marks.update(a for a, b in zip(p, p[1:]) if b in marks and a != SPACE)
        if any(c.isascii() and c.isalnum() for c in marks):
            marks = set()  # pieces join words and punctuation: cut at blanks only
        y, m = (re.escape("".join(sorted(x))) for x in (outside, marks))
        parts = [f"[{y}]+", f"{SPACE}*[{m}]*[^{SPACE}{m}{y}]+", f"{SPACE}*[{m}]+", f"{SPACE}+"]
        if not marks:
            parts = [f"[{y}]+", f"{SPACE}*[^{SPACE}{y}]+", f"{SPACE}+"]
        self.cuts = re.compile("|".join(parts)).findall

    def merge(self, cut: str) -> list[str]:
        """The symbols of ``cut`` after all merges."""
        symbols = list(cut)
        n = len(symbols)
        if n <= SCANNED:
            return self._merge_scanned(symbols)
        scores = self.scores
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in scores:
                agenda.append((-scores[pair], i, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            left = symbols[i]
            j = after[i]
            # Stale unless both parts still stand as they were.
            if not left or j >= n or len(left) + len(symbols[j]) != len(pair) or left + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                joined = pair + symbols[k]
                if joined in scores:
                    heapq.heappush(agenda, (-scores[joined], i, joined))
            h = before[i]
            if h >= 0:
                joined = symbols[h] + pair
                if joined in scores:
                    heapq.heappush(agenda, (-scores[joined], h, joined))
        return [s for s in symbols if s]

    def _merge_scanned(self, symbols: list[str]) -> list[str]:
        """The same with a short agenda kept in text order and scanned for its best pair."""
        get = self.costs.get
        agenda = [get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)  # the leftmost of equals
            pair = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = get(pair + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = get(symbols[i - 1] + pair, NEVER)
        return symbols

    def encode_cut(self, cut: str) -> list[int]:
        symbols = self.merge(cut)
        out = [self.ids.get(s) for s in symbols]
        if None not in out:
            return out
        out = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in s.encode("utf-8")]
            else:
                out.append(self.unknown)
        return out

    def check(self, cuts: list[str], encoded: list[list[int]]) -> None:
        """Compare with the library on texts of many cuts, each after a character that sets it apart."""
        apart, first = self.encode_cut(self.apart), self.encode_cut(SPACE)
        runs = range(0, len(cuts), CHECKED)
        texts = [self.apart + self.apart.join(cuts[i : i + CHECKED]).replace(SPACE, " ") for i in runs]
        for i, theirs in zip(runs, self.library.encode(texts, num_threads=1)):
            own = list(first)
            for e in encoded[i : i + CHECKED]:
                own += apart
                own += e
            if own != theirs:
                raise ValueError(f"the library encodes one of {cuts[i : i + CHECKED]!r:.200} otherwise")

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: controls vanish, byte runs are UTF-8, one leading blank is dropped."""
        if self.aside.isdisjoint(ids):
            return "".join([self.pieces[i] for i in ids]).replace(SPACE, " ")[self.starts_blank(ids) :]
        parts: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.values:
                run.append(self.values[i])
                continue
            if run:
                parts.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if i == self.unknown:
                parts.append(" ⁇ ")
            elif i not in self.controls:
                parts.append(self.pieces[i].replace(SPACE, " "))
        if run:
            parts.append(run.decode("utf-8", "replace"))
        text = "".join(parts)
        return text[self.starts_blank(ids) :]

    def starts_blank(self, ids: list[int]) -> bool:
        first = next((i for i in ids if i not in self.controls), None)  # an end id decodes to nothing
        return first is not None and self.pieces[first].startswith(SPACE)


class Codec:
    """Encodes and decodes texts cut by cut, remembering what it has seen."""

    def __init__(self, path: str):
        self.vocabulary = MergeVocabulary(path)
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}  # the generation before; what is used of it moves on

    def entries(self, texts: list[str]) -> list[list[tuple[str, str]]]:
        """Per text its cuts as (ids in decimal, decoded text)."""
        v = self.vocabulary
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        cuts = [v.cuts(v.normalise(t)) for t in texts]
        wanted = {c for of_text in cuts for c in of_text}.difference(known)
        known.update((c, older[c]) for c in wanted if c in older)
        new = list(wanted.difference(known))
        encoded = [v.encode_cut(c) for c in new]
        v.check(new, encoded)
        blank = v.encode_cut(SPACE)  # in front, so that no blank of the cut itself is dropped
        known.update((c, (" ".join(map(str, e)), v.decode(blank + e))) for c, e in zip(new, encoded))
        out = [[known[c] for c in of_text] for of_text in cuts]
        for c in new:
            if len(c) > REMEMBERED_CHARS:
                del known[c]
        return out


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec; what it remembers serves later tasks too."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _mapped(df: DataFrame, path: str, schema: T.StructType, arrays) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                texts = [t or "" for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), *arrays(c, texts)], names=schema.fieldNames()
                )

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``ids``, the token ids with the end id last.

    A null text counts as empty and gives the end id alone. Rows are encoded one by one, so
    repeated rows repeat; an empty table gives an empty one; other columns are not read.
    ``model`` is the path of a merge-type model file, the same on every executor.
    """
    rows = id_and_text(df, id_col, text_col)
    schema = T.StructType([
        T.StructField(id_col, rows.schema["_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
    ])

    def arrays(c: Codec, texts: list[str]):
        end = str(c.vocabulary.end)
        ids = [list(map(int, " ".join([*(i for i, _ in e), end]).split(" "))) for e in c.entries(texts)]
        return [pa.array(ids, pa.list_(pa.int32()))]

    return _mapped(rows, model, schema, arrays)


def decode(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id and ``decoded``, the text of its token ids; null ids give an empty text."""
    rows = df.select(col(id_col).alias("_id"), col(ids_col).cast("array<int>").alias("_ids"))
    schema = T.StructType([
        T.StructField(id_col, rows.schema["_id"].dataType), T.StructField("decoded", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = codec(model).vocabulary
        for batch in batches:
            texts = [v.decode(i or []) for i in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def digests(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: number of ids, SHA-256 of the ids and of the text decoded from them.

    The same as hashing :func:`encode` and :func:`decode`, without carrying the ids about:
    a text's ids are those of its cuts, and its decoded text is theirs, less the leading blank.
    """
    rows = id_and_text(df, id_col, text_col)
    schema = T.StructType([
        T.StructField(id_col, rows.schema["_id"].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def arrays(c: Codec, texts: list[str]):
        end = str(c.vocabulary.end)
        counts, ids_hex, text_hex = [], [], []
        for e in c.entries(texts):
            joined = " ".join([*(ids for ids, _ in e), end])
            counts.append(joined.count(" ") + 1)
            ids_hex.append(hashlib.sha256(joined.encode()).hexdigest())
            text = "".join([t for _, t in e])
            text_hex.append(hashlib.sha256(text[1:].encode()).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(text_hex)]

    return _mapped(rows, model, schema, arrays)


def with_ids(df: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``ids`` (end id last), ``n_tokens`` and ``decoded_sha256``, all other columns kept.

    Where ``df`` has a column of such a name, the new one gets underscores behind its name.
    """
    at = df.columns.index(text_col)
    schema = T.StructType(list(df.schema))
    for name, kind in (
        ("ids", T.ArrayType(T.IntegerType())), ("n_tokens", T.LongType()), ("decoded_sha256", T.StringType()),
    ):
        schema = schema.add(free_name(df, name), kind)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        end = str(c.vocabulary.end)
        for batch in batches:
            for part in slices(batch, at, SLICE):
                ids, hexes = [], []
                for e in c.entries([t or "" for t in part.column(at).to_pylist()]):
                    ids.append(list(map(int, " ".join([*(i for i, _ in e), end]).split(" "))))
                    hexes.append(hashlib.sha256("".join([t for _, t in e])[1:].encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns, pa.array(ids, pa.list_(pa.int32())),
                        pa.array([len(i) for i in ids], pa.int64()), pa.array(hexes, pa.string()),
                    ],
                    names=names,
                )

    return df.mapInArrow(run, schema)
