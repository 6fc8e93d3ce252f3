import hashlib
import random

import pytest
from tests.llm.conftest import brief

from veriframe.llm import sentencepiece_bpe as S

MODEL = S.model_path()


@pytest.fixture(scope="module")
def codec():
    return S.Codec(MODEL)


TEXTS = ["", " ", "  two  blanks ", "a▁▁b ▁", "Zeile\nzwei\t\tTab\r\n", "日本語テキスト😀é́ \x00\x01", "x" * 3_000, " " * 200,
         "<s> </s> <unk> <0x41> <|im_end|>", "THE!! the,the. of... (a)[b]{c} don't ².5 ½", "Ünïcödé ñandú œuvre"]


def test_equals_the_library(codec):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(" \n.,!aeinrtsTHé▁²文'") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    library = codec.vocabulary.library
    for text, entries in zip(texts, codec.entries(texts)):
        ids = [int(i) for part, _ in entries for i in part.split()]
        assert ids == library.encode(text)
        assert "".join(t for _, t in entries)[1:] == library.decode(ids) == codec.vocabulary.decode([*ids, 2])


def test_heap_and_scan_agree(codec):
    v = codec.vocabulary
    rng = random.Random(2)
    for _ in range(200):
        cut = "".join(rng.choice("▁thenandio") for _ in range(rng.randint(41, 120)))
        assert v.merge(cut) == v._merge_scanned(list(cut))


def test_a_difference_stops(codec):
    with pytest.raises(ValueError, match="otherwise"):
        codec.vocabulary.check(["▁the"], [[5]])


def test_memory_is_bounded(codec, monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED", 10)
    own = S.Codec(MODEL)
    own.entries([" ".join(f"word{i}" for i in range(50))])
    own.entries(["word1 another text " + "y" * 100])
    assert len(own.known) <= 5 and all(len(c) <= S.REMEMBERED_CHARS for c in own.known)
    assert "▁word1" in own.known and len(own.older) == 50  # one slice may go beyond the bound
    own.entries(["three more words", "and seven others that are new here"])
    own.entries(["x"])
    assert len(own.older) < 20


def test_tables(spark, docs, codec):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, "again"), (3, "again"), (99, "long text " * 20_000)]
    library = codec.vocabulary.library
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert brief(S.digests(docs(rows), MODEL)) == sorted(want, key=key)
    encoded = S.encode(docs(rows).drop("ids"), MODEL)
    decoded = S.decode(encoded, MODEL)
    assert brief(decoded) == sorted([(i, (t or "").replace("▁", " ")) for i, t in rows], key=key)
    more = S.with_ids(docs(rows), MODEL)
    assert more.columns == [*docs(rows).columns, "ids_", "n_tokens", "decoded_sha256"]
    assert brief(more.select("doc_id", "n_tokens")) == sorted([w[:2] for w in want], key=key)


def test_empty(docs):
    assert S.digests(docs([]), MODEL).count() == 0 and S.with_ids(docs([]), MODEL).count() == 0
