import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import brief

from veriframe.llm import chat as C

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(3_000):
        text = "".join(rng.choice(["<|", "|>", "\\", "n", "\n", "im_end", "im_start", "a", "<", "|", C.END, C.START]) for _ in range(rng.randint(0, 12)))
        assert C.unescape(C.escape(text)) == text and "<|" not in C.escape(text)
        whole, start, end = C.format_turn(text, text)
        (turn,) = C.read_turns(whole)
        assert (turn.role, turn.text, turn.start, turn.end) == (text, text, start, end)
        assert C.unescape(whole[start:end]) == text


def test_many_turns_read_back():
    turns = [("user", C.HOSTILE), ("", ""), ("assistant", "x\n"), ("a\nb", "\\")]
    assert [(t.role, t.text) for t in C.read_turns("".join(C.format_turn(*t)[0] for t in turns))] == turns
    for bad in ("x", C.START + "user\nabc", C.START + "user" + C.END + "\n", C.format_turn("a", "b")[0][:-1] + "x"):
        with pytest.raises((ValueError, IndexError)):
            list(C.read_turns(bad))


def test_fingerprints():
    a = {"messages": [{"role": "user", "content": "x"}, {"content": None, "role": "y"}]}
    b = {"messages": [{"content": "other", "role": "z"}]}
    assert C.fingerprint(C.field_paths(a)) == C.fingerprint(C.field_paths(b))
    assert C.fingerprint(C.field_paths(a)) != C.fingerprint(C.field_paths({"messages": []}))
    assert C.field_paths({"a": {"b": [1, {"c": 2}]}, "d": {}}) == {"a.b[]", "a.b[].c", "d{}"}
    with pytest.raises(ValueError):
        C.catalogue([*C.LAYOUTS, C.LAYOUTS[0]])


RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "system and messages": {"system": "s", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "conversations": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "exchanges": {"turns": [{"user": "q", "assistant": "a"}]},
    "instruction": {"instruction": "q", "output": "a"},
    "instruction and input": {"input": "i", "instruction": "q", "output": "a"},
    "prompt and response": {"prompt": "q", "response": "a"},
    "prompt and completion": {"completion": "a", "prompt": "q"},
    "question and answer": {"question": "q", "answer": "a"},
}


def test_layouts(spark):
    rows = [(i, json.dumps(r)) for i, r in enumerate(RECORDS.values())] + [(50, None), (51, "{"), (52, "[1]"), (53, '{"odd": 1}'), (54, '{"messages": []}')]
    df = spark.createDataFrame(rows, "conv_id bigint, record string").withColumn("role", F.lit("x")).withColumn("_order", F.lit(1))
    out = C.format_records(df, "record")
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["conv_id"], r["position"])):
        got.setdefault(r["conv_id"], []).append((r["layout"], r["role"], r["formatted"], r["loss_start"]))
    for i, name in enumerate(RECORDS):
        turns = [t for piece in got[i] for t in C.read_turns(piece[2])]
        assert {p[0] for p in got[i]} == {name}
        assert [(t.role, t.text) for t in turns][-1] == ("assistant", "a") and ("user", "q") in [(t.role, t.text) for t in turns]
        assert [p[3] is not None for p in got[i]] == [t.role == "assistant" for t in turns]
    assert all(got[i] == [(None, None, None, None)] for i in range(50, 55))
    back = {r["conv_id"]: r for r in C.read_back(out).collect()}
    assert back[53]["n_turns"] == 0 and back[0]["n_turns"] == 2 and back[0]["loss_sha256"] == sha("a")


def test_no_record_is_lost(spark):
    """Names that spell joints of paths, empty objects, half a character pair, and deep nesting."""
    records = [
        {"messages[].role": "user", "messages[].content": "hi"}, {"messages": [{"role.x": "user"}]}, {"prompt": {}, "response": "a"},
        {"a": {"b": 1}}, {"a.b": 1}, {"a\\": {"b": 1}}, {},
    ]
    texts = [json.dumps(r) for r in records]
    texts += ['{"role": "\\ud800", "text": "x"}', '{"role": "user", "text": "\\ud83d\\ude00"}', '{"\\udfff": 1}', "[" * 100_000, '{"a":' * 100_000, "1" * 5_000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "conv_id bigint, record string")
    got = sorted(C.format_records(df, "record").collect(), key=lambda r: r["conv_id"])
    assert [r["conv_id"] for r in got] == list(range(len(texts)))
    assert [r["conv_id"] for r in got if r["layout"]] == [8] and C.unescape(got[8]["formatted"]).count("\U0001f600") == 1
    keys = [C.fingerprint(C.field_paths(r)) for r in records]
    assert len(set(keys)) == len(keys) and not set(keys) & set(C.catalogue())


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, C.format_turn(role or "", text or "")[0], role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[:3])
        loss = "".join(t[4] for t in turns if t[3] == "assistant")
        out.append((conv, len(turns), sha("".join(f"{t[3]}\n{t[4]}\n" for t in turns)), len(loss), sha(loss), sum(len(t[2]) for t in turns)))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_query_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 6), rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", "system", None, "a\nb"]),
             rng.choice([None, "", "x", C.HOSTILE, "\\n<|", "é😀", "y" * 5_000])) for _ in range(300)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = C.read_back(C.format_records(C.conversations_with_hostile(df), "record", order_col="turn"))
    extra = [(-1, 0, "user", C.HOSTILE), (-1, 1, "assistant", C.HOSTILE)]
    assert brief(got) == brute(rows + extra)
    assert brief(C.read_back(C.format_records(C.conversations_with_hostile(df.limit(0)), "record", order_col="turn"))) == brute(extra)


def test_hot_conversation_streams(spark):
    df = spark.range(20_000).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t', id) as text")
    row = C.read_back(C.format_records(C.conversations_with_hostile(df), "record", order_col="turn")).filter("conv_id = 1").first()
    assert row["n_turns"] == 20_000
    assert row["turns_sha256"] == sha("".join(f"{'assistant' if i % 2 else 'user'}\nt{i}\n" for i in range(20_000)))
