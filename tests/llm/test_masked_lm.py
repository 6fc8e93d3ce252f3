import random

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.conftest import brief

from veriframe.llm import masked_lm as M
from veriframe.llm.decontaminate import words_of


def prose(rng, n):
    """Words that follow from their neighbours: a cycle of ten, with noise."""
    at = rng.randrange(10)
    out = []
    for _ in range(n):
        at = (at + 1) % 10 if rng.random() < 0.9 else rng.randrange(10)
        out.append(f"word{at}")
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    return [(i, " ".join(prose(rng, 400))) for i in range(240)]


@pytest.fixture
def model(spark, docs, rows):
    return M.fitted(docs(rows[:200]).repartition(3))


def test_held_out_and_shuffled(spark, docs, rows, model):
    """Far better than word frequencies on new texts; order matters, on both sides."""
    held = rows[200:]
    mean = lambda r: np.mean([x["per_word"] for x in M.score(docs(r), model=model).collect()])
    rng = random.Random(2)
    shuffled = [(i, " ".join(rng.sample(t.split(), 400))) for i, t in held]
    assert mean(held) > -1.6 and mean(held) > mean(shuffled) + 1.0  # a uniform guess among ten is -2.3


def test_scores_equal_brute_force(spark, docs, model):
    text = "word1 word2 unheard word3 word3 Word4"
    ids = M.word_ids(text, model.vocabulary)
    padded = [M.OUTSIDE] * M.SIDE + list(ids) + [M.OUTSIDE] * M.SIDE
    total = 0.0
    for i, t in enumerate(ids):
        around = np.array([[padded[i + M.SIDE + d] for d in range(-M.SIDE, M.SIDE + 1) if d]])
        total += float(model.net.log_probability(around, np.array([t]))[0])
        total -= np.log(model.rare_share) if t >= M.WORDS else 0
    rows = [(1, text), (2, None), (3, ""), (3, ""), (None, "!!"), (4, "word1"), (5, text + " word1" * 30_000), (1, text)]
    got = M.score(docs(rows), model=model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert by[1]["log_likelihood"] == pytest.approx(total, rel=1e-4) and by[1]["n_words"] == 6
    assert (by[2]["n_words"], by[2]["log_likelihood"], by[2]["per_word"]) == (0, 0.0, None) and by[None]["n_words"] == 0
    assert by[5]["n_words"] == 30_006


def test_gradient():
    rng = np.random.default_rng(1)
    net = M.Network()
    around, target = rng.integers(0, M.OUTSIDE + 1, (64, 2 * M.SIDE)), rng.integers(0, M.OUTSIDE, 64)
    before = net.log_probability(around, target).mean()
    seen = np.full(M.N_WEIGHTS, 1e-6, np.float32)
    for _ in range(40):
        net.train(around, target, seen)
    assert net.log_probability(around, target).mean() > before + 1
    p = np.array([[net.log_probability(around[:1], np.array([t]))[0] for t in range(M.BASE * M.BASE)]])
    assert np.exp(p).sum() == pytest.approx(1, abs=1e-3)


def test_counts_cover_all_texts(spark, docs):
    df = docs([(1, "a b a"), (2, "A c"), (3, None)]).select("text").withColumnRenamed("text", "_text")
    assert brief(M.word_counts(df.repartition(3))) == [(bytearray(b"a"), 3), (bytearray(b"b"), 1), (bytearray(b"c"), 1)]


def test_weights_are_averaged_in_a_tree(spark):
    rows = [(s, t, t + 1, np.array([float((t + 1) * (s + 1))]).tobytes()) for s in range(2) for t in range(300)]
    df = spark.createDataFrame(rows, "slice int, task int, n bigint, values binary")
    small = M._added(df.selectExpr("slice", "cast(task / 64 as int) as task", "n", "values"), ["slice", "task"])
    got = {r["slice"]: (r["n"], np.frombuffer(r["values"])[0]) for r in M._added(small, ["slice"]).collect()}
    n = 300 * 301 // 2
    assert small.count() == 10 and got == {0: (n, n), 1: (n, 2 * n)}


def test_empty(docs):
    assert M.score(docs([])).count() == 0
    assert M.score(docs([(1, None)])).first()["log_likelihood"] == 0.0


def test_rare_words_have_their_counted_share(spark, docs):
    """Words beyond the vocabulary score by how often they were counted; the shares of a code's words sum to one."""
    common = " ".join(f"w{i}" for i in range(M.WORDS) for _ in range(30))
    n = {f"r{i}": 2 + 18 * (i < 50) for i in range(1_000)}
    words = [w for w, k in n.items() for _ in range(k // 2)]
    random.Random(3).shuffle(words)
    rows = [(1, common), (2, " ".join(words)), (2, " ".join(words)), (3, "r0 r999 w5 never"), (4, None)]
    model = M.fitted(docs(rows[:3]))
    depth = len(model.net.priors)
    assert depth == 1 == M.depth_for(1_000) and M.depth_for(M.RARE) == 0 and M.depth_for(280_000) == 2
    leaf = {w: int(M.word_ids(w, model.vocabulary, depth)[0]) for w in n}
    shares = {bytes(r["word"]).decode(): r["share"] for r in model.shares.collect()}
    assert shares.keys() == n.keys()
    for w, k in n.items():
        assert shares[w] == pytest.approx(np.log(k / sum(n[x] for x in n if leaf[x] == leaf[w])))
    got = M.score(docs(rows), model=model).collect()
    assert len(got) == len(rows)
    for r, text in zip(sorted(got, key=lambda r: r["doc_id"]), [t for _, t in rows]):
        ids = M.word_ids(text, model.vocabulary, depth)
        rare = [w for w in (text or "").split() if w not in shares and w == "never" or w in shares]
        total = M.scores([ids], model.net)[0] + sum(shares.get(w, -np.log(model.rare_share)) for w in rare)
        assert r["log_likelihood"] == pytest.approx(total, rel=1e-4) and r["n_words"] == len(ids)


def test_digits_tell_rare_words_apart():
    """Digits start at their counted shares, sum to one, are learnt, and count as context."""
    leaves = np.random.default_rng(1).integers(1, 9, M.RARE * M.BASE)
    net = M.Network(priors=M.digit_shares(leaves))
    rare = M.WORDS + (np.arange(M.BASE) << M.CODE_BITS)
    around = np.full((M.BASE, 2 * M.SIDE), 3)
    code = M.Network(net.flat[: M.N_WEIGHTS]).log_probability(around, np.full(M.BASE, M.WORDS))
    own = net.log_probability(around, rare) - code
    assert np.exp(own) == pytest.approx(leaves[: M.BASE] / leaves[: M.BASE].sum(), abs=1e-4)
    seen = np.full(len(net.flat), 1e-6, np.float32)
    sides = np.repeat(rare[:, None], 2 * M.SIDE, 1)  # each word stands among its own kind
    before = net.log_probability(sides, rare).mean()
    for _ in range(80):
        net.train(sides, rare, seen)
    assert net.log_probability(sides, rare).mean() > before + 1
    assert np.exp(net.log_probability(sides[:1].repeat(M.BASE, 0), rare)).sum() <= 1 + 1e-4
    assert len({round(float(v), 5) for v in net.log_probability(sides, np.full(M.BASE, 7))}) > M.BASE // 2


def test_every_position_is_trained_on(docs, rows, monkeypatch):
    """A round's examples are all the words of its texts."""
    made, durable = [], M.durable
    monkeypatch.setattr(M, "durable", lambda *a: made.append(durable(*a)) or made[-1])
    M._round(docs(rows).selectExpr("text as _text").repartition(3), M.Network(), {b"word1": 0}, 0)
    assert made[0].filter("slice = 0").agg({"n": "sum"}).first()[0] == 240 * 400


def test_rare_words_meet_their_share_once_per_slice(docs):
    """50 texts that share a rare word are one row with 50 entries; a word's repeats in a text are counted."""
    rows = docs([(i, "common rare" + " rare" * (i == 7)) for i in range(50)]).coalesce(1)
    rows = rows.selectExpr("doc_id as _key", "cast(doc_id as int) as _also", "text as _text")
    (row,) = M._rare_words(rows, {b"common": 0}).collect()
    assert bytes(row["word"]) == b"rare" and row["keys"] == row["alsos"] == list(range(50))
    assert row["counts"] == [1 + (i == 7) for i in range(50)]


def test_words_of_many_texts_at_once():
    texts = [None, "", " ", "a", "b", "Ab,cÉ\x00d_9 ß", "!!", " y", "z ", None, "word " * 3, ""]
    for kind in (pa.string(), pa.large_string()):
        words, sizes = M.words_in(pa.array(["x", *texts], kind)[1:])
        assert words.to_pylist() == [w for t in texts for w in words_of(t)]
        assert sizes.tolist() == [len(words_of(t)) for t in texts]


def test_a_line_scores_like_its_windows():
    """Gaps score 0; softmaxes beyond float32's exponentials are shifted, not lost."""
    rng = np.random.default_rng(1)
    net = M.Network(priors=M.digit_shares(rng.integers(1, 9, M.RARE * M.BASE)))
    ids = [rng.integers(0, M.OUTSIDE, n) for n in (5, 0, 1, 2_500)]
    line, at = M.laid_out(np.concatenate(ids), np.array([len(i) for i in ids]))
    assert line[at].tolist() == np.concatenate(ids).tolist() and (np.delete(line, at) == M.OUTSIDE).all()
    for times in (1, 500):
        net.w["first"][:] *= times
        with np.errstate(over="ignore"):
            own = net.log_probability(line[at[:, None] + M._OFFSETS], line[at])
        assert np.isfinite(own).all()
        assert M.scores(ids, net) == pytest.approx([p.sum(dtype=float) for p in np.split(own, [5, 5, 6])], rel=1e-4)
