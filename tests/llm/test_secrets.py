import random
from string import ascii_letters, digits

from pyspark.sql import functions as F
from tests.llm.conftest import brief

from veriframe.llm import secrets as S


def findings(seed, n):
    """(text, is secret) with keys, and with paths, digits, placeholders and words that are none."""
    rng = random.Random(seed)
    pick = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    hexa, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    out = []
    for i in range(n):
        kind = i % 8
        text, secret = (
            (f'token = "{pick(hexa, 40)}"', True), (f"the key AKIA{pick(alnum[:26] + alnum[52:], 16)} works", True),
            (f"password={pick(hexa, 18)}", True), (f"api_key: '{pick(alnum, 32)}9'", True),
            (f"number {pick('0123456789', 16)} was", False), (f"see /home/user/files/page{rng.randint(1, 9)}/index.html", False),
            (f"password={rng.choice('ax')}{'1' * 20}", False), (f"chapter-name-and-the-section-{rng.randint(1, 99)} of", False),
        )[kind]
        out.append((i, f"some words before {text} and after", secret))
    return out


def test_candidates(spark, docs):
    rows = [(1, "a " + "x1" * 10 + "  " + "y2" * 8 + "== end"), (2, None), (3, ""), (4, "short1 words"), (5, "z" * 40), (1, "q9" * 50_000), (None, "k3" * 9)]
    got = brief(S.candidates(docs(rows)).select("_id", "ordinal", "value", F.length("before"), F.length("after")))
    assert got == sorted([
        (1, 0, "x1" * 10, 2, 2), (1, 1, "y2" * 8 + "==", 2, 4), (1, 0, "q9" * 50_000, 0, 0), (None, 0, "k3" * 9, 0, 0)
    ], key=lambda r: tuple((v is None, str(v)) for v in r))


def test_values_assigned_to_a_name_at_any_length(spark, docs):
    texts = {
        'x password = "Tr0ub4dor&3" y': ["Tr0ub4dor&3"], "pwd: hunter2, then": ["hunter2"], "secret=correcthorsebatterystaple": ["correcthorsebatterystaple"],
        "{'API_KEY': 'a.b-c+d='}": ["a.b-c+d="], "token=": [], "auth: x": ["x"], "colour = blue": [], "Passwd:abc Bearer=Q": ["abc", "Q"],
        "token == abc": [], "the password is abc": [], "secret =    far": [], "pwd=" + "é" * 70_000: ["é" * 70_000],
        "token=ab/cd" + "e5" * 10 + "!f": ["ab/cd" + "e5" * 10 + "!f"],
    }
    got = S.candidates(docs(list(enumerate(texts)))).groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("ordinal", "value"))).alias("v"))
    found = {r["_id"]: [v["value"] for v in r["v"]] for r in got.collect()}
    assert [found.get(i, []) for i in range(len(texts))] == list(texts.values())


def by_hand(text):
    """Candidates by walking through the text."""
    key, stop, out, i = set(ascii_letters + digits + "+/_-"), set(" \t\n\"'`,;<>()[]{}"), [], 0

    def quote(k):
        return k - 1 if k and text[k - 1] in "\"'`" else k

    def blanks(k):
        return next(k - n for n in range(4) if n == 3 or k - n == 0 or not text[k - n - 1].isspace())

    def named(k):
        for q in {k, quote(k)}:
            for b in range(q, blanks(q) - 1, -1):
                if b and text[b - 1] in "=:":
                    for c in range(b - 1, blanks(b - 1) - 1, -1):
                        if any(text[:e].lower().endswith(n) for e in {c, quote(c)} for n in ("token", "password", "passwd", "pwd", "secret", "api_key", "apikey")):
                            return True
        return False

    while i < len(text):
        e = i
        if text[i] not in stop and text[i] not in "=:" and named(i):
            while e < len(text) and text[e] not in stop:
                e += 1
        elif not (i and text[i - 1] in key):
            while e < len(text) and text[e] in key:
                e += 1
            if e - i < 16 or not set(text[i:e]) & set(digits):
                e = i
            else:
                e += len(text[e : e + 2]) - len(text[e : e + 2].lstrip("="))
        if e > i:
            out.append(text[i:e])
        i = max(e, i + 1)
    return out


def test_candidates_equal_a_walk_through_the_text(spark, docs):
    rng = random.Random(5)
    bits = ["token", "pwd", "API_KEY", "secret", "=", ":", " ", "  ", '"', "'", "ab1", "Z9" * 8, "word", ",", "/x", "==", "é", "{", "q" * 17, "-7", "!"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(600)]
    got = S.candidates(docs(list(enumerate(texts)))).groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("ordinal", "value"))).alias("v"))
    found = {r["_id"]: [v["value"] for v in r["v"]] for r in got.collect()}
    for i, t in enumerate(texts):
        assert found.get(i, []) == by_hand(t), t
    assert sum(map(len, found.values())) > 300


def test_features_equal_counts_by_hand(spark, docs):
    texts = [t for _, t, _ in findings(4, 80)]
    for r in S.described(S.candidates(docs(list(enumerate(texts))))).collect():
        v = r["value"]
        near = list(zip(v, v[1:]))
        kinds = [[c.isdigit(), c.isupper(), c.islower(), c.isalpha()] for c in v]
        want = {
            "length": len(v), "digit_share": sum(k[0] for k in kinds) / len(v), "upper_share": sum(k[1] for k in kinds) / len(v),
            "changes": sum((a.isdigit() and b.isalpha()) or (a.isalpha() and b.isdigit()) for a, b in near) / len(v),
            "case_changes": sum((a.islower() and b.isupper()) or (a.isupper() and b.islower()) for a, b in near) / len(v),
            "distinct_share": len(set(v)) / min(len(v), 64), "slashes": v.count("/") / len(v), "digits_only": float(set(v) <= set(digits + "-")),
            "dashes": (v.count("-") + v.count("_")) / len(v), "in_path": float(r["before"][-1:] in ("/", "\\", ".") or r["after"][:1] in ("/", "\\")),
        }
        assert {k: round(r[k], 9) for k in want} == {k: round(x, 9) for k, x in want.items()}, v


def test_held_out_accuracy(spark, docs):
    train, held = findings(1, 400), findings(2, 400)
    labelled = S.described(S.candidates(docs([(i, t) for i, t, _ in train])))
    truth = spark.createDataFrame([(i, float(s)) for i, _, s in train], "_id bigint, label double")
    labelled = labelled.join(truth, "_id")
    got = S.scan(docs([(i, t) for i, t, _ in held]), labelled=labelled).groupBy("doc_id").agg(F.max("secret").alias("s")).collect()
    verdict = {r["doc_id"]: r["s"] for r in got}
    wrong = sum(verdict.get(i, False) != s for i, _, s in held)
    assert wrong <= 0.05 * len(held)


def test_own_findings_and_repeated_rows(spark, docs):
    rows = [(i, t) for i, t, _ in findings(3, 160)] * 2
    found = S.scan(docs(rows))
    assert found.columns == ["doc_id", "ordinal", "value", "before", "after", "probability", "secret"]
    counts = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("secret").alias("d")).collect()
    assert all(r["n"] % 2 == 0 and r["d"] == 1 for r in counts)
    assert found.filter("secret").count() > 0 and found.filter("not secret").count() > 0


def test_nothing_to_learn_from(spark, docs):
    assert S.scan(docs([])).count() == 0
    only = S.scan(docs([(1, 'token = "' + "a1b2c3d4e5f6" * 3 + '"')])).collect()
    assert [(r["secret"], r["probability"]) for r in only] == [(True, 1.0)]


def test_no_python(spark, docs):
    plan = S.described(S.candidates(docs([(1, "x")])))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
