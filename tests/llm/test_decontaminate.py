import hashlib
import random

import pyarrow as pa
import pytest
from tests.llm.conftest import brief

from veriframe.llm import decontaminate as D


def brute(text, items, window=10):
    words = D.words_of(text)
    hit, found = set(), set()
    for name, item in items:
        w = D.words_of(item)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            for j in range(len(words) - m + 1):
                if words[j : j + m] == w[i : i + m]:
                    hit |= set(range(j, j + m))
                    if name is not None:
                        found.add(str(name))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(30))
def test_search_equals_brute_force(seed):
    rng = random.Random(seed)
    letters = "abc" if seed % 2 else "abcdefghij"
    text = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    items = [(i, text(rng.randint(0, 14))) for i in range(8)] + [(None, text(3)), (3, text(11))]
    texts = [text(rng.randint(0, 60)) for _ in range(20)] + [None, ""]
    texts += [f"{items[0][1]} {items[9][1]}", text(3000)]
    counts, spans, found = D.Searcher.build(items, 10).search(texts)
    for k, t in enumerate(texts):
        n, n_hit, names = brute(t, items)
        assert counts[k] == n
        assert sum(b - a for a, b in zip(spans[k][::2], spans[k][1::2])) == n_hit
        assert found[k] == names


def test_words():
    assert D.words_of("Ab,cÉ\x00d_9 ß") == ["ab".encode(), "cÉ".encode(), b"d", b"9", "ß".encode()]


def test_edges_and_blocks(spark, docs):
    long = "w " * 30_000 + "one two three four five six seven eight nine ten " + "v " * 30_000
    rows = [(1, "A one two THREE four five six seven eight nine ten b"), (2, None), (2, None), (3, ""), (4, long),
            (5, "short item here"), (None, "short, item"), (1, "A one two THREE four five six seven eight nine ten b")]
    bench = spark.createDataFrame(
        [(7, "one two three four five six seven eight nine ten"), (8, "short item"), (9, ""), (10, None), (None, "b")],
        "item_id bigint, text string",
    )
    none = hashlib.sha256(b"").hexdigest()
    seven = hashlib.sha256(b"7").hexdigest()
    eight = hashlib.sha256(b"8").hexdigest()
    want = sorted([
        (1, 12, 11, 1, seven, True), (1, 12, 11, 1, seven, True), (2, 0, 0, 0, none, False), (2, 0, 0, 0, none, False),
        (3, 0, 0, 0, none, False), (4, 60_010, 10, 1, seven, True), (5, 3, 2, 1, eight, True),
    ]) + [(None, 2, 2, 1, eight, True)]
    assert brief(D.contamination(docs(rows), bench)) == want
    # Every item a block of its own gives the same.
    split = D.contaminated_words(docs(rows), bench, block_bytes=1)
    whole = D.contaminated_words(docs(rows), bench)
    assert brief(split) == brief(whole)
    left = D.clean(docs(rows), bench)
    assert left.columns == docs(rows).columns
    assert brief(left.select("doc_id")) == [(2,), (2,), (3,)]
    assert brief(D.clean(docs(rows), bench, block_bytes=1).select("doc_id")) == [(2,), (2,), (3,)]


@pytest.mark.parametrize("kept", [1, 100])
def test_many_blocks_equal_brute_force(spark, docs, monkeypatch, kept):
    rng = random.Random(kept)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    items = [(i % 9, text(rng.randint(0, 14))) for i in range(40)]
    rows = [(i, text(rng.randint(0, 80))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id bigint, text string").repartition(5)
    blocks = D.Blocks.write(bench, "item_id", "text", 10, 40)
    assert len(blocks.rows) > 4 and sum(blocks.rows.values()) == len({w for _, t in items for w in D.windows_of(t, 10)})
    monkeypatch.setattr(D, "KEPT", kept)
    monkeypatch.setattr(D, "SLICE_BYTES", 200)
    monkeypatch.setattr(D, "RELOAD_BYTES", 900)
    D._searchers.clear()
    batch = pa.RecordBatch.from_pydict({"_text": [t for _, t in rows]})
    got = [(p.column(0)[i].as_py(), *(x[i] for x in found)) for p, *found in blocks.search(batch, 0) for i in range(p.num_rows)]
    assert [g[0] for g in got] == [t for _, t in rows]
    for t, n, spans, found in got:
        assert (n, sum(b - a for a, b in zip(spans[::2], spans[1::2])), found) == brute(t, items)
    assert len(D._searchers) == min(kept, len(blocks.rows))
    # The same through Spark, in any layout.
    spread = D.contaminated_words(docs(rows).repartition(3), bench, block_bytes=40)
    assert brief(spread) == brief(D.contaminated_words(docs(rows), bench))


def test_a_block_that_lost_files_is_refused(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    blocks = D.Blocks.write(bench, "item_id", "text", 2, 100)
    (block, n), = blocks.rows.items()
    with pytest.raises(OSError, match="holds 2 windows of 3"):
        D.Blocks(blocks.path, {block: n + 1}).searcher(block)


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert brief(D.contamination(docs([]), bench)) == []
    got = brief(D.contamination(docs([(1, "a b")]), bench))
    assert got == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert D.clean(docs([(1, "a b")]), bench).count() == 1
