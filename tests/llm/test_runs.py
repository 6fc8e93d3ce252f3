import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from tests.llm.conftest import brief

from veriframe.llm import queries
from veriframe.llm import runs as R


def brute(words):
    """Every stretch that no neighbour extends, tried period by period."""
    n, out = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            part = words[s : i + q]
            if len(part) >= max(6, 4 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.append((s, len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbered(words):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def messy(rng):
    """Words over few letters, with planted repetitions inside repetitions."""
    out = []
    for _ in range(rng.randint(0, 6)):
        block = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 25))]
        if rng.random() < 0.4:
            block = block[: rng.randint(1, 4)] * rng.randint(2, 6) + block
        out += (block * 7)[: rng.randint(1, 7 * len(block))]
        out += [f"w{rng.random()}" for _ in range(rng.randint(0, 3))]
    return out


def test_equals_brute_force():
    rng = random.Random(5)
    for _ in range(600):
        words = messy(rng)
        assert R.find_runs(numbered(words)) == brute(words), words


def test_many_texts_at_once():
    rng = random.Random(6)
    texts = [" ".join(messy(rng)).encode() for _ in range(40)] + [None, b"", b"a a a a a a"]
    found = list(R._searched([None] * len(texts), texts, None))
    assert [r for _, r in found] == [brute((t or b"").split()) for t in texts]


def test_classes_cover_every_lag_once():
    lags = [q for low, high, _ in R.lag_classes(10_000) for q in range(low, high + 1)]
    assert lags[:2_500] == list(range(1, 2_501))
    assert all(k >= high and k <= max(6, 4 * low) - low for low, high, k in R.lag_classes(10_000))


def test_pairs_stay_linear(monkeypatch):
    """One word ten thousand times: one extension, not one per pair."""
    calls = []
    real = R._first_difference
    monkeypatch.setattr(R, "_first_difference", lambda *a: calls.append(a) or real(*a))
    assert R.find_runs(np.zeros(10_000, np.int64)) == [(0, 10_000, 1)]
    assert len(calls) == 1


def test_strongest():
    assert R.strongest([]) is None
    assert R.strongest([(5, 12, 3), (9, 8, 2), (2, 4 * 10, 10)]) == (2, 40, 10)
    assert R.strongest([(0, 13, 3), (20, 9, 2)]) == (20, 9, 2)


def expected(doc_id, text):
    words = R.planted(doc_id, (text or "").encode().split())
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


ROWS = [
    (1, "go go go go go go on"), (2, "a b a b a b a b c"), (3, ""), (4, None), (None, "x x x x x x"), (5, " x\tx\x0bx x\x1cx x x x x x"),
    (6, "one two"), (6, "one two"), (7, "z " * 4_000), (8, "a b c " * 3), *((i, "p q r s t u v w x y " * (i % 9)) for i in range(100, 160)),
]


def test_tables(docs):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    small = [(i, t) for i, t in ROWS if t is None or len(t) < 2_000]
    assert brief(R.digests(docs(small), change=R.planted)) == sorted((expected(*r) for r in small), key=key)
    found = brief(R.runs(docs(ROWS)))
    assert (7, 0, 4_000, 1) in found and (1, 0, 6, 1) in found and (None, 0, 6, 1) in found
    texts = dict(brief(R.collapsed(docs([(1, "go go go go go go on"), (2, None), (7, "z " * 4_000)]))))
    assert texts == {1: "go on", 2: "", 7: "z"}


def test_empty(docs):
    assert R.digests(docs([])).count() == R.runs(docs([])).count() == R.collapsed(docs([])).count() == 0


def test_planting():
    doc_id = next(i for i in range(10_000) if zlib.crc32(str(i).encode()) % 10 == 0)
    g = zlib.crc32(str(doc_id).encode()) // 10
    words = [str(i).encode() for i in range(97)]
    a, got = g % 97, R.planted(doc_id, words)
    p = 1 + (97 - a) // (3 + g % 8)
    assert got == [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    assert R.planted(None, words) == words and R.planted(doc_id, []) == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r) for r in queries.QUERIES["op11_runs"](spark, sf).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        if len((text or "").split()) <= 300:
            assert got[doc_id] == expected(doc_id, text)
