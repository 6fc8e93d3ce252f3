import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import brief

from veriframe.llm import packing as P
from veriframe.llm import queries

PATH = P.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def one_by_one(lengths, size):
    """Best-fit decreasing, piece by piece over a plain list of rooms."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            i = min(fits, key=lambda i: rooms[i])
        else:
            i = len(rooms)
            rooms.append(size)
        rooms[i] -= n
    return sorted(rooms)


def laid_out(slots):
    """(sequence, offset, length) of every piece, checking that the pieces of a length are numbered through."""
    placed, numbers = [], {}
    for s in slots:
        assert s.first == numbers.get(s.length, 0)
        numbers[s.length] = s.first + s.n
        for k in range(s.n):
            placed.append((s.sequence + k // s.per_sequence, s.offset + k % s.per_sequence * s.length, s.length))
    return sorted(placed)


def rooms_of(placed, size):
    ends = {}
    for sequence, offset, length in placed:
        assert offset == ends.get(sequence, 0)  # no gap, no overlap
        ends[sequence] = offset + length
    assert all(e <= size for e in ends.values()) and sorted(ends) == list(range(len(ends)))
    return sorted(size - e for e in ends.values())


def test_equals_piece_by_piece():
    rng = random.Random(3)
    for _ in range(400):
        size = rng.choice([1, 2, 7, 16, 31, 100])
        lengths = [min(size, max(1, int(rng.expovariate(3 / size)))) for _ in range(rng.randint(0, 150))]
        lengths += [rng.randint(1, size)] * rng.choice([0, 0, 40])
        histogram = {n: lengths.count(n) for n in set(lengths)}
        placed = laid_out(P.best_fit_decreasing(histogram, size))
        assert sorted(n for _, _, n in placed) == sorted(lengths)
        assert rooms_of(placed, size) == one_by_one(lengths, size)


def test_tightest():
    for size in (1, 5, 8, 100):
        tree, rng = P.Capacities(size), random.Random(size)
        for _ in range(300):
            room = rng.randint(0, size)
            if tree.open[room] and rng.random() < 0.6:
                tree.take(room)
            else:
                tree.put(room, 0, 1)
            need = rng.randint(1, size)
            assert tree.tightest(need) == next((r for r in range(need, size + 1) if tree.open[r]), None)


def test_slots_do_not_grow_with_the_corpus():
    histogram = {n: 3 + n % 50 for n in range(1, P.SIZE + 1)}
    many = {n: 100_000 * c for n, c in histogram.items()}
    assert len(P.best_fit_decreasing(many)) < 30_000
    with pytest.raises(ValueError):
        P.best_fit_decreasing({5: 1}, 4)


TEXTS = ["", " ", "Hello, World! it's 42nd's don't", "ÅNGSTRÖM é́   x　y ΣΑΣ İi", "a<|endoftext|>b <|startoftext|> c",
         "́ ́ e ́", "H̱ẖ İİ̱ J̌ T̈ Ẅ", "WORD. Word, word); end.\") e.g. a.b ... .a ,,", "ré,%%% word's' it's' a<|endoftext|>, x>' y|. don't't' ''s ñ'",  "<|ENDOFTEXT|> <|EndOfText|>.", "日本語テキスト😀 한글 각", "\x00\x01 \x1c\x85 tab\tnew\nline\r\x0b\x0c.", "x" * 5_000, "it 's '", "½²①"]


def test_words_equal_the_library(library):
    texts = [*TEXTS, " ".join(TEXTS)]
    for text, ids in zip(texts, P.Words(PATH).encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_equals_the_library(library, text):
    (ids,) = P.words(PATH).encode([text.encode()])
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_case_and_marks(library):
    """Lowering first changes no ids: every ASCII letter with every mark that may compose with it, and every other letter."""
    marks = [chr(m) for m in range(0x300, 0x370)]
    texts = [f"{a}{m}" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for m in marks]
    texts += [t for c in range(0x41, 0x530) for t in (chr(c), f"a{chr(c)}", f"{chr(c)}b{chr(c)}")]
    texts += [f"A{chr(c)}Z." for c in range(0x21, 0x3100) if chr(c).isprintable()]
    found = P.Words(PATH).encode([t.encode() for t in texts])
    wanted = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(i, "<u4").tolist() for i in found] == [w.ids for w in wanted]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 10)
    own = P.Words(PATH)
    own.encode([b" ".join(b"word%d" % i for i in range(50))])
    own.encode([b"word1 others " + b"y" * 100 + b" " + b"z" * 90 + b"."])
    assert len(own.known) <= 5 and b"word1" in own.known and len(own.older) == 50


ROWS = [*enumerate(TEXTS), (None, None), (3, "again"), (3, "again"), (99, "long text " * 3_000), *((i, "word " * (i % 40)) for i in range(200, 400))]


def wanted(library, rows, size):
    """(doc_id, piece, start, length, crc) of every piece."""
    out = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), size):
            part = ids[k : k + size]
            out.append((i, k // size, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("size", [2048, 64, 1])
def test_tables(spark, docs, library, size):
    rows = ROWS if size > 1 else ROWS[:12]
    packed = P.pack(P.pieces(docs(rows).repartition(7), PATH, size), size)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = packed.collect()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    want = wanted(library, rows, size)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    placed = sorted((r.sequence_id, r.offset, r.length) for r in got)
    assert rooms_of(placed, size) == one_by_one([w[3] for w in want], size)


def test_sequences(docs, library):
    cut = P.pieces(docs(ROWS), PATH, 256, with_ids=True)
    packed = P.pack(cut, 256)
    made = {r[0]: (r[1], r[2]) for r in P.sequences(packed).collect()}
    assert sum(n for n, _ in made.values()) == packed.count()
    for r in packed.collect():
        own = made[r.sequence_id][1][r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32 and len(made[r.sequence_id][1]) <= 256


def test_empty(docs):
    cut = P.pieces(docs([]), PATH)
    assert brief(P.pack(cut)) == [] and P.sequences(P.pack(P.pieces(docs([]), PATH, with_ids=True))).count() == 0
    with pytest.raises(ValueError):
        P.pieces(docs([]), PATH, 0)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, library, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op12_packing"](spark, sf).collect()
    want = wanted(library, docs, 2048)
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    placed = sorted((r.sequence_id, r.offset, r.length) for r in got)
    assert rooms_of(placed, 2048) == one_by_one([w[3] for w in want], 2048)
