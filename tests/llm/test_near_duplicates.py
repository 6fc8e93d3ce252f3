import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from tests.llm.conftest import brief

from veriframe.llm import near_duplicates as N
from veriframe.llm.components import components
from veriframe.llm.decontaminate import words_of
from veriframe.llm.shingles import set_id, shingle_sets


def prose(rng, n):
    return [rng.choice("abcdefghij") + rng.choice("klmnopqrst") + rng.choice("uvwxyz") for _ in range(n)]


def corpus(seed, groups=12, size=6):
    rng = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        base = prose(rng, rng.choice([3, 6, 30, 120, 300]))
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                own[rng.randrange(len(own))] = "edit" + str(rng.random())[2:6]
            rows.append((i, " ".join(own).upper() if i % 5 == 0 else ", ".join(own)))
            i += 1
    return rows


def brute(rows):
    sets = {}
    copies = defaultdict(list)
    for i, t in rows:
        w = words_of(t)
        s = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None
        sets.setdefault(s, len(sets))
        copies[s].append(i)
    keys = [s for s in sets if s is not None]
    links = {s: {u for u in keys if u != s and 10 * len(s & u) >= 8 * len(s | u)} for s in keys}
    root = {}
    for s in keys:
        if s not in root:
            todo, seen = [s], {s}
            while todo:
                new = links[todo.pop()] - seen
                seen |= new
                todo += new
            ids = [i for u in seen for i in copies[u] if i is not None]
            root |= {u: min(ids, default=None) for u in seen}
    out = []
    for s, ids in copies.items():
        out += [(i, i if s is None else root[s], 0 if s is None else len(links[s]), 1 if s is None else len(ids)) for i in ids]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


EDGES = [(900, None), (901, None), (902, ""), (903, " ... "), (904, "one"), (905, "One!"), (906, "one two"), (None, "null id text here now"),
         (907, "null id text here now"), (None, "only null ids in this class"), (908, "again and again the same"), (908, "again and again the same")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, docs, seed):
    rows = corpus(seed) + EDGES
    assert brief(N.classes(docs(rows))) == brute(rows)


def test_blocks_and_hot_groups(spark, docs, monkeypatch):
    """Groups cut into many blocks give the same result; modules reach the workers by reference, so the frames are run here."""
    rng = random.Random(9)
    base = prose(rng, 200)
    rows = []
    for i in range(60):
        own = list(base)
        own[rng.randrange(200)] = f"e{i}"
        rows.append((i, " ".join(own)))
    monkeypatch.setattr(N, "BLOCK", 8)  # used in plans made on the driver
    assert brief(N.classes(docs(rows))) == brute(rows)


def test_one_of_each(spark, docs):
    rows = corpus(5) + EDGES
    kept = N.one_of_each(docs(rows))
    assert kept.columns == docs(rows).columns
    want = {r[1] for r in brute(rows) if r[1] is not None}
    got = [r[0] for r in brief(kept.select("doc_id"))]
    assert sorted(x for x in got if x is not None) == sorted(want) and got.count(None) == 1


def test_empty(docs):
    assert N.classes(docs([])).count() == 0 and N.one_of_each(docs([])).count() == 0


def test_stop_depth():
    assert N.stop_depth(0.8, 0.9995, 16, 8) == 4 and N.stop_depth(0.8, 0.5, 16, 8) == 8
    with pytest.raises(ValueError):
        N.stop_depth(0.1, 0.999, 4, 8)


def test_trie_links_join_what_is_alike():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**32, N.TREES * N.DEPTH, dtype=np.uint32)
    near = np.stack([np.where(rng.random(len(base)) < 0.1, rng.integers(0, 2**32, len(base), dtype=np.uint32), base) for _ in range(30)])
    far = rng.integers(0, 2**32, (30, len(base)), dtype=np.uint32)
    far[:, : N.DEPTH] = near[:, : N.DEPTH] = base[: N.DEPTH]
    roots = N.trie_links(np.concatenate([near, far]), 0, 4, 0.55)
    assert (roots[:30] == 0).all() and (roots[30:] == np.arange(30, 60)).all()


def test_exact_links():
    rng = random.Random(1)
    sets = [np.array(sorted(rng.sample(range(40), rng.randint(1, 20))), np.uint64) for _ in range(40)]
    want = np.array([[a is not b and 10 * len(set(a) & set(b)) >= 8 * len(set(a) | set(b)) for b in sets] for a in sets])
    assert (N.exact_links(sets, None, Fraction(4, 5)) == want).all()
    assert (N.exact_links(sets[:15], sets[15:], Fraction(4, 5)) == want[:15, 15:]).all()


def test_shingles_tell_texts_apart():
    rng = random.Random(8)
    texts = [" ".join(prose(rng, rng.randint(0, 12))) for _ in range(400)] + ["a", "aa", "a a", "ab a", "a ba", "é", "x" * 5_000, "x" * 4_999]
    by_set, by_words = {}, {}
    for t, s in zip(texts, shingle_sets(texts)):
        w = words_of(t)
        key = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None
        assert len(s) == (len(key) if key else 0)
        assert by_set.setdefault(set_id(s), key) == key and by_words.setdefault(key, set_id(s)) == set_id(s)
    alone = [set_id(shingle_sets([t])[0]) for t in texts]
    assert alone == [set_id(s) for s in shingle_sets(texts)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200)]
    got = brief(components(spark.createDataFrame(chain, "a bigint, b bigint")))
    assert got == sorted([(i, 0) for i in range(41)] + [(100, 100), (101, 100)], key=str)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
