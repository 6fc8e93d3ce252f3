import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from veriframe.llm import conversation_repair as C
from veriframe.llm import queries

LEGAL = re.compile("(s?(ua)+)?")


def enumerated(codes):
    """Every sequence of edits with at most two inserts in a gap; the cheapest, then ASCII-least initials."""
    def row(code):
        initial, must_go, cut = code
        yield 2, "D", ""
        if not must_go:
            yield 5 * cut, "K", initial
            for r in "ua":
                yield 1 + 5 * cut, "R", r

    gaps = [(5 * n, "I" * n, "".join(r)) for n in range(3) for r in itertools.product("ua", repeat=n)]
    parts = [gaps]
    for code in codes:
        parts += [list(row(code)), gaps]
    best = None
    for way in itertools.product(*parts):
        if LEGAL.fullmatch("".join(w[2] for w in way)):
            found = (sum(w[0] for w in way), "".join(w[1] for w in way), "".join(w[2] for w in way))
            best = min(best or found, found)
    return best


def tabulated(codes):
    """The same over a full table of (cost, initials, roles); no checkpoint, no greedy walk."""
    @cache
    def best(i, state, inserts):
        ways = []
        if i == len(codes) and state in (C.START, C.ANSWERED):
            ways.append((0, "", ""))
        if inserts < 3:
            ways.append(then(5, "I", C.OWN_ROLE[state][0], best(i, C.OWN[state], inserts + 1)))
        if i < len(codes):
            initial, must_go, cut = codes[i]
            ways.append(then(2, "D", "", best(i + 1, state, 0)))
            if not must_go:
                if (state, initial) in C.NEXT:
                    ways.append(then(5 * cut, "K", initial, best(i + 1, C.NEXT[state, initial], 0)))
                ways.append(then(1 + 5 * cut, "R", C.OWN_ROLE[state][0], best(i + 1, C.OWN[state], 0)))
        return min(ways, default=(10**9, "", ""))

    def then(cost, letter, role, rest):
        return cost + rest[0], letter + rest[1], role + rest[2]

    return best(0, C.START, 0)


def checkpointed(codes):
    """Cost, initials and roles by the operator's own classes, with checkpoints in front or without."""
    out = []
    for ahead in (False, True):
        c = C.Conversation("g", 1)
        if ahead:
            marks = C.Checkpoints()
            for code in reversed(codes):
                marks.read(code)
            for mark in marks.kept + [(marks.n, marks.costs)] * (marks.kept[-1][0] != marks.n):
                c.checkpoint(*mark)
        edits = []
        for i, (initial, must_go, cut) in enumerate(codes):
            edits += c.add(i, initial + "x", "t", str(i), must_go, False, cut)
        edits += c.end()
        out.append((c.cost, "".join(e.initial for e in edits), "".join((e.role or "")[:1] for e in edits)))
    assert out[0] == out[1]
    return out[0]


def drawn(rng, n, faults=0.3):
    return [(rng.choice("uauauasx"), rng.random() < faults, rng.random() < faults) for _ in range(n)]


def test_equals_enumeration():
    rng = random.Random(1)
    for n in (0, 1, 2):
        for _ in range(60 if n else 1):
            codes = drawn(rng, n)
            assert checkpointed(codes) == tabulated(codes) == enumerated(codes), codes


def test_equals_full_table():
    rng = random.Random(2)
    for _ in range(500):
        codes = drawn(rng, rng.randint(0, 40), rng.choice([0, 0.2, 0.6]))
        assert checkpointed(codes) == tabulated(codes), codes
        assert LEGAL.fullmatch(checkpointed(codes)[2])


def test_checkpoints_grow_with_the_root():
    marks = C.Checkpoints()
    for code in drawn(random.Random(3), 10_000):
        marks.read(code)
    assert len(marks.kept) < 150
    assert max(b[0] - a[0] for a, b in itertools.pairwise(marks.kept)) < 150


# -- tables ---------------------------------------------------------------

def hurt(rows):
    """Rows (conv, turn, role, text) after damage, per conversation and in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if k == 4 else role
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        kept += [(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    sha = lambda r: hashlib.sha256(f"{r[1]}\n{r[2]}".encode()).hexdigest()
    return {c: sorted(r, key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r))) for c, r in out.items()}


def expected(rows):
    for conv, own in hurt(rows).items():
        seen, codes, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in own:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            codes.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit, roles = tabulated(codes)
        full = iter(own)
        lines, k = [], 0
        for letter in audit:
            row = next(full) if letter != "I" else (None, "", "")
            if letter != "D":
                role = row[1] if letter == "K" else {"u": "user", "a": "assistant"}[roles[k]]
                lines.append(f"{role}:{row[2]}")
                k += 1
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        yield (conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def key(r):
    return tuple((v is None, str(v)) for v in r)


def table(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for name in ("_id", "_text", "drawn", "cost", "audit", "col"):
        df = df.withColumn(name, F.lit("other"))
    return df


def sample(rng, conversations=60):
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Same?", "cut", "cut", None, "", " \t", f"Text {rng.random()}.", "end. \x0b", "a\x1c", "long " * 500 + "."])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), role, text))
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (None, 1, "assistant", "Yes."), (None, 1, "assistant", "Yes.")]
    return rows


@pytest.mark.parametrize("in_memory", [C.IN_MEMORY, 3, 0])
def test_tables(spark, in_memory):
    rows = sample(random.Random(4))
    got = C.audit(C.damaged(table(spark, rows)), in_memory=in_memory)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows), key=key)


def test_one_long_conversation(spark, no_broadcast):
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No.", f"t{i}.", f"t{i}"])) for i in range(200)]
    rows += [(8, 0, "user", "Hi."), (8, 1, "assistant", "Hello.")]
    got = C.audit(C.damaged(table(spark, rows)), in_memory=20)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows), key=key)


def test_repaired_rows(spark):
    rows = C.turns(table(spark, [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (1, 3, "assistant", "And?"), (2, 0, "system", "Be.")]))
    got = sorted(map(tuple, C.repaired(rows).collect()))
    assert got == [(1, 0, "K", "user", "Hi."), (1, 1, "K", "assistant", "And?")]
    assert {r[0]: (r.cost, r.audit) for r in C.audit(rows).collect()} == {1: (4, "KDDK"), 2: (2, "D")}
    everything = C.repaired(C.damaged(table(spark, sample(random.Random(6)))), in_memory=5)
    for conv, roles in everything.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("position", "role")))).collect():
        assert [r.position for r in roles] == list(range(len(roles))) and LEGAL.fullmatch("".join(r.role[0] for r in roles))


def test_all_dropped(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = C.audit(C.damaged(table(spark, [(conv, 0, "user", "Hi.")]))).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty(spark):
    rows = C.damaged(table(spark, []))
    assert C.audit(rows).count() == C.repaired(rows).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op13_repair"](spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows), key=key)
