import random
import re

import pytest
from tests.llm.conftest import brief

from veriframe.llm import quality as Q

BLANK = "[ \t\n\x0b\x0c\r]"


def brute(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            repeated |= {i, i + 1, i + 2}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
        len(repeated),
    )


def test_measures_equal_brute_force(spark, docs):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, "a a a"), (6, "a a a a"), (7, "é ß 😀 　x"), (6, "a a a a")]
    for i in range(60):
        n = rng.choice([0, 1, 2, 3, 5, 20, 80, 300])
        rows.append((100 + i, "".join(rng.choice(["a", "b", "the", "#", "x<y"]) + rng.choice([" ", "\n", "\r\n", "  "]) for _ in range(n))))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = brief(Q.judge(docs(rows)).select(*names))
    want = []
    for i, t in rows:
        m = brute(t)
        want.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_rules_and_passing(spark, docs):
    rng = random.Random(5)
    good = " ".join(rng.choice(["the", "of", "house", "tree", "and", "river", "stone", "walks"]) + str(i % 7) * (i % 3 == 0) for i in range(90))
    rows = [(1, good), (1, good), (2, good.replace(" ", "### ")), (3, "the of " * 60), (4, "lorem ipsum"), (None, good), (5, None)]
    judged = {r["doc_id"]: r for r in Q.judge(docs(rows)).collect()}
    assert judged[1]["kept"] and judged[1]["failed_rules"] == []
    assert "symbols" in judged[2]["failed_rules"] and not judged[2]["base_failed"]
    assert judged[3]["base_failed"] and judged[4]["failed_rules"][0] == "too_short"
    kept = Q.passing(docs(rows))
    assert kept.columns == docs(rows).columns
    assert brief(kept.select("doc_id")) == [(1,), (1,), (None,)]


def test_very_long_text(spark, docs):
    words = [f"w{i}" for i in range(150_000)]
    text = " ".join([*words, *words[:100]])
    row = Q.judge(docs([(1, text)])).collect()[0]
    assert (row["n_words"], row["n_repeat_words"]) == (150_100, 200)


def test_empty(docs):
    assert Q.judge(docs([])).count() == 0 and Q.passing(docs([])).count() == 0


@pytest.mark.parametrize("name", [r.name for r in Q.RULES])
def test_rule_borders(spark, name):
    rule = next(r for r in Q.RULES if r.name == name)
    base = {m: 0 for m in Q.MEASURES}
    limit = rule.high if rule.high is not None else rule.low
    for shift, fails in ((0, False), (1 if rule.high is not None else -1, True)):
        row = dict(base) | ({rule.base: 100} if rule.base else {})
        row[rule.measure] = limit * (100 if rule.base else 1) // rule.scale + shift
        df = spark.createDataFrame([row], ", ".join(f"{m} bigint" for m in row))
        assert (df.select(Q.compiled([rule]).alias("f")).first()["f"] == [name]) == fails
