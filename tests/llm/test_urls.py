import random

from tests.llm.conftest import brief

from veriframe.llm import urls as U


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h) + len(p), len(h), h + p, a) for a, h, p in rules
        if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p) and "://" in (url or "")
    ]
    won = max(fits, default=None)
    return host, path, won and won[2], won[3] if won else "allow"


def test_equals_brute_force(spark):
    rng = random.Random(6)
    rules = [*U.RULES, ("block", "a.com", ""), ("allow", "a.com", ""), ("block", "b.a.com", "/x"), ("allow", "com", "/x/long"),
             ("block", "com", "/x/long"), ("block", None, "/"), ("allow", "org", None), ("block", "org", "/"), ("allow", "example.org", "/es/")]
    hosts = ["a.com", "b.a.com", "xa.com", "com", "ORG", "www.Example.org", "", "a..com", "é.org"]
    paths = ["", "/", "/x", "/x/long/er", "/fr/1", "/de/", "/es/?q=/x", "/en/1#/de/", "?a=/fr/", "#x", "/en/12", "/x\n/y"]
    urls = [f"{s}{rng.choice(hosts)}{rng.choice(paths)}" for s in ["http://", "https://", "", "x://y://"] for _ in range(60)] + [None, "", "://", None]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, urls[0]), (None, urls[1])]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    # Extra columns: one named like a result is replaced, one like a temporary column is kept.
    df = df.selectExpr("*", "'x' as rule", "'y' as _full", "'z' as _short", "'q' as action")
    got = U.judge(df, U.rules_frame(spark, rules))
    assert got.columns == ["page_id", "url", "_full", "_short", "action", "host", "path", "rule", "verdict"]
    want = [(i, u, *brute(u, rules)) for i, u in rows]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert brief(got.select("page_id", "url", "host", "path", "rule", "verdict")) == sorted(want, key=key)


def test_long_path_and_empty_tables(spark):
    long = "http://a.example.org/es/" + "p" * 100_000
    df = spark.createDataFrame([(1, long)], "page_id bigint, url string")
    assert U.judge(df, U.rules_frame(spark)).first()["verdict"] == "block"
    none = spark.createDataFrame([], "action string, host string, path string")
    assert U.judge(df, none).first()["rule"] is None
    assert U.judge(df.limit(0), U.rules_frame(spark)).count() == 0


def test_no_python_and_no_cross_join(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    plan = U.judge(df, U.rules_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
