import random
import re
import sys

import pytest
from tests.llm.conftest import brief

from veriframe.llm import pii as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if {
                "email": True, "ip": kind == "ip" and all(int(x) < 256 for x in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and P.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]:
                out.append(P.Span(kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("alphabet", ["a1@. -", "0123. ", "+1234 ()-.", "4 -1", "a.@é-"])
def test_base_equals_the_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(4_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
        assert P.base_spans(text) == brute(text)


def test_linear_on_hostile_texts():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "1 " * 100_000, "@" * 300_000):
        P.base_spans(text)


def windows(seed, n=300):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 8)))
    out = []
    for i in range(n):
        body = [word() for _ in range(12)]
        card = [rng.randint(0, 9) for _ in range(15)]
        card = "".join(map(str, [4, *card[1:]]))
        card += next(c for c in "0123456789" if P.luhn(card + c))
        body.insert(6, (
            f"{word()}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com", ".".join(str(rng.randint(1, 250)) for _ in range(4)),
            card, f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", str(rng.randint(1000, 2100)), word(), f"v{rng.randint(1, 9)}.{rng.randint(0, 99)}",
        )[i % 7])
        out.append(" ".join(body))
    return out


@pytest.fixture(scope="module")
def field():
    return P.fitted(windows(1))


def test_held_out_variants(field):
    """Spellings the base patterns do not know, on texts the field has not seen."""
    right = total = extra = 0
    for k, w in enumerate(windows(2)):
        spans = P.base_spans(w)
        text, moved = P.written_otherwise(w, spans, 1 + k % 3)
        base, more = P.all_spans(text, field)
        found = set(base) | set(more)
        total += len(moved)
        right += len(found & set(moved))
        extra += len(found - set(moved))
    assert right >= 0.9 * total and extra <= 0.05 * total


def test_clean_text_stays_clean(field):
    text = "In 1999 and 2004 it cost 1,200,000 or 3.14 each; see chapter 12.4, page 1024, on 2024-01-05 at 10:30."
    assert P.all_spans(text, field) == ([], [])


def test_best_equals_enumeration(field):
    """The programme against all segmentations of short texts."""

    def value(tokens, at, cands):
        if at == len(tokens):
            return 0.0
        best = value(tokens, at + 1, cands)
        for c in cands:
            if c.start == at:
                best = max(best, field.score(c) + value(tokens, c.end, cands))
        return best

    rng = random.Random(4)
    for _ in range(60):
        tokens, _ = P.tokenise("".join(rng.choice(["415", "555", "1234", "-", " ", ".", "a", "@", "b.de", "4111111111111111"]) for _ in range(9)))
        cands = P.candidates(tokens)
        assert abs(sum(field.score(c) for c in field.best(tokens)) - value(tokens, 0, cands)) < 1e-9


def test_islands_change_nothing(field):
    text = "word " * 200 + "call (415) 555-1234 or a [at] b.example.com " + "word " * 200
    tokens, borders = P.tokenise(text)
    whole = {(c.kind, borders[c.start], borders[c.end]) for c in field.best(tokens)}
    assert whole and whole == {tuple(s) for s in P.all_spans(text, field)[1]}


@pytest.mark.parametrize("address", [
    "name [at] some-long-department-name (dot) long-university-name (dot) example (dot) org",
    "a.local.part.of.many.words.that.reaches.beyond.the.usual.context [at] b.example.com",
    "long" * 40 + " [at] " + "host" * 40 + ".com",
    "x7" + "long" * 20 + "9@" + "host" * 40 + "-" + "host" * 40 + " (dot) com",
])
def test_islands_hold_whole_addresses(field, address):
    text = "word " * 50 + address + "; " + "word " * 50
    stretches = list(P.islands(text))
    assert any(a <= 250 and 250 + len(address) <= b for a, b in stretches)
    assert all(x[1] < y[0] for x, y in zip(stretches, stretches[1:]))
    tokens, borders = P.tokenise(text)
    whole = {(c.kind, borders[c.start], borders[c.end]) for c in field.best(tokens)}
    base = P.base_spans(text)
    assert {tuple(s) for s in P.all_spans(text, field)[1]} == {
        w for w in whole if not any(s.start < w[2] and w[1] < s.end for s in base)
    }


def test_tables(spark, docs):
    rows = [(i, w) for i, w in enumerate(windows(3, 60))] + [(None, None), (5, ""), (7, "a@b.de"), (7, "a@b.de"), (8, "x " * 50_000 + "1.2.3.4")]
    got = {r["doc_id"]: r for r in P.find(docs(rows)).collect()}
    assert P.find(docs(rows)).count() == len(rows)
    for i, t in rows[-5:]:
        base = brute(t or "")
        assert got[i]["base"] == P.written(base)
        assert all(got[i][f"n_{k}"] == sum(s.kind == k for s in base) for k in P.KINDS)
    assert P.digests(docs(rows)).columns == ["doc_id", *(f"n_{k}" for k in P.KINDS), "base_sha256", "spans"]
    masked = P.masked(docs(rows))
    assert masked.columns == docs(rows).columns
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert texts[7] == "<email>" and texts[None] is None and texts[5] == ""
    assert not any(P.base_spans(t) for t in texts.values() if t)


def test_mask_overlaps():
    assert P.mask("0123456789", [P.Span("ip", 2, 5), P.Span("card", 2, 7), P.Span("phone", 8, 9)]) == "01<card>7<phone>9"


def test_empty(docs):
    assert P.find(docs([])).count() == 0 and P.masked(docs([])).count() == 0
    assert brief(P.find(docs([(1, "no numbers")])).select("doc_id", "spans")) == [(1, "")]


def test_other_digits_are_no_numbers():
    """Every character that counts as a digit without being 0 to 9, at either end of a number and inside it."""
    field = P.fitted(["mail a.b@mail.example.org now", "from 10.0.0.1 to 10.0.0.255", "card 4111 1111 1111 1111 ok", "call +1 (202) 555-0123 today"])
    odd = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isdigit() and not chr(c).isascii()]
    assert len([c for c in odd if not c.isdecimal()]) > 100
    for c in odd:
        for text in (f"note {c}4111111111111111", f"4111111111111111{c}", f"+1 202{c}5550123 x", f"10.0{c}.0.1"):
            base, _ = P.all_spans(text, field)
            assert base == brute(text)
