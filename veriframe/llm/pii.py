"""Personal data by fixed patterns and a semi-Markov conditional random field.

The base patterns give e-mail addresses, IP addresses, card and phone numbers in
their plain forms. The random field adds written variants: it scores whole
candidate segments (their shape, digit groups, checksum, neighbours) and a dynamic
programme over segments of bounded length chooses boundaries and kinds jointly.

Every candidate holds a digit or an at sign, so stretches of text without either
consist of plain words under any weights. The programme therefore runs on the
stretches around such characters only, which changes no result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.llm.common import col, id_and_text, per_batch, slices

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 600  # windows of text the field is trained on at most
MAX_TOKENS = 24  # tokens of one entity at most
SIZE = 1 << 14  # weights
EPOCHS = 5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The contract's patterns, anchored at the start of a digit run and without backtracking.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def is_number(text: str) -> bool:
    """Whether it is digits 0 to 9 alone; other digits, such as raised or circled ones, are no numbers."""
    return text.isascii() and text.isdigit()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Local part, at sign, dotted domain; found from the at signs, so in linear time."""
    out: list[Span] = []
    free = 0  # end of the last address
    local = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in local:
                start -= 1
            if start < at:
                out.append(Span("email", start, domain.end()))
                free = domain.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind and start."""
    out = emails(text) if "@" in text else []
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(Span("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(Span("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(Span("phone", m.start(), m.end()))
    return out


# ---- the random field ----------------------------------------------------------------

_TOKEN = re.compile(r"[0-9]+| ?[\[(](?:at|dot)[\])] ?|[^\W\d_]+|\s+|.", re.S)
_TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]")
_REACH = 48  # characters of context around a trigger
_DOMAIN_WRITTEN = re.compile(r" ?(?:[^\W_]| ?[\[(]dot[\])] ?|[.-])*+")  # what may follow an at sign
_JOINTS = {" ", "-", ".", "(", ")", ") ", "/"}
_AT = {"@", "[at]", "(at)"}
_DOT = {".", "[dot]", "(dot)"}
_LOCAL_MARKS = {".", "_", "%", "+", "-"}


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold all characters an entity may need, apart from each other.

    Digits of one number stand closer than _REACH. An address goes on from its sign as far as
    characters that an address may hold do.
    """
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = m.span()
        if not is_number(m.group()):
            a -= a > 0 and text[a - 1] == " "
            while a > 0 and (text[a - 1].isalnum() or text[a - 1] in _LOCAL_MARKS):
                a -= 1
            b = _DOMAIN_WRITTEN.match(text, b).end()
        a, b = max(a - _REACH, 0), b + _REACH
        while out and a <= out[-1][1]:
            start, end = out.pop()
            a, b = min(a, start), max(b, end)
        out.append((a, b))
    for a, b in out:
        yield a, min(b, len(text))


class Candidate(NamedTuple):
    start: int  # tokens, end exclusive
    end: int
    kind: str
    features: tuple[int, ...]


def _slot(feature: str) -> int:
    h = 2166136261
    for b in feature.encode("utf-8", "replace"):
        h = ((h ^ b) * 16777619) & 0xFFFFFFFF
    return h % SIZE


def _shape(token: str) -> str:
    t = token.strip()
    if not t:
        return "_"
    if is_number(t):
        return "9" * min(len(t), 5)
    return "a" if t.isalpha() else t


def _features(kind: str, tokens: list[str], i: int, j: int) -> tuple[int, ...]:
    inner = tokens[i:j]
    before = tokens[i - 1] if i else "^"
    after = tokens[j] if j < len(tokens) else "$"
    word_before = next((t.lower() for t in reversed(tokens[max(0, i - 3) : i]) if t.isalpha()), "^")
    groups = [t for t in inner if is_number(t)]
    digits = "".join(groups)
    names = [
        "bias",
        f"before={_shape(before)}",
        f"after={_shape(after)}",
        f"joined={_shape(before)[:1] in 'a9' and before.strip() != ''}{_shape(after)[:1] in 'a9' and after.strip() != ''}",
        f"word={word_before}" if len(word_before) <= 12 else "word=long",
    ]
    if kind == "email":
        at = next(k for k, t in enumerate(inner) if t.strip() in _AT)
        names += [
            f"last={len(inner[-1])}" if inner[-1].isalpha() else "last=mark",
            f"dots={min(3, sum(t.strip() in _DOT for t in inner[at:]))}",
            f"local={min(6, at)}",
            f"sign={inner[at].strip()}",
        ]
    else:
        names += [
            "groups=" + "-".join(str(min(len(g), 20)) for g in groups),
            "joints=" + "".join(t.strip() or "_" for t in inner if not is_number(t)),
            f"digits={len(digits)}",
            f"first={digits[0]}",
            f"plus={inner[0] == '+'}",
        ]
        if kind == "ip":
            names.append(f"bytes={all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
        if kind == "card":
            names.append(f"luhn={luhn(digits)}{12 < len(digits) < 20}")
    return tuple(_slot(f"{kind}:{n}") for n in names)


def candidates(tokens: list[str]) -> list[Candidate]:
    """All segments that may be an entity, whatever the weights."""
    out = []
    n = len(tokens)
    for i, first in enumerate(tokens):
        if is_number(first) or first in ("+", "("):
            digits = groups = dots = 0
            others = False
            for j in range(i, min(n, i + MAX_TOKENS)):
                t = tokens[j]
                if is_number(t):
                    digits += len(t)
                    groups += 1
                    if digits > 19:
                        break
                    if groups == 4 and dots == 3 and not others:
                        out.append(Candidate(i, j + 1, "ip", _features("ip", tokens, i, j + 1)))
                    if 12 <= digits and first not in ("+", "("):
                        out.append(Candidate(i, j + 1, "card", _features("card", tokens, i, j + 1)))
                    if 9 <= digits <= 15:
                        out.append(Candidate(i, j + 1, "phone", _features("phone", tokens, i, j + 1)))
                elif j == i or t in _JOINTS:
                    dots += t == "."
                    others |= t not in (".", " ")
                else:
                    break
        if first.isalnum():
            sign = None
            for j in range(i, min(n, i + MAX_TOKENS)):
                t = tokens[j].strip()
                if t in _AT and t:
                    if sign is not None:
                        break
                    sign, dotted = j, False
                elif t in _DOT and (sign is not None or t == "."):
                    dotted = sign is not None
                elif t.isalnum() and tokens[j] == t:
                    if sign is not None and dotted:
                        out.append(Candidate(i, j + 1, "email", _features("email", tokens, i, j + 1)))
                elif t not in _LOCAL_MARKS or (sign is not None and t != "-"):
                    break
    return out


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


class Field:
    """Weights of the semi-Markov random field. A plain token scores nothing."""

    def __init__(self, weights: list[float] | None = None):
        self.weights = weights or [0.0] * SIZE

    def score(self, c: Candidate) -> float:
        w = self.weights
        return sum(w[f] for f in c.features)

    def best(self, tokens: list[str]) -> list[Candidate]:
        """The best segmentation's entities; on equal scores fewer entities win."""
        ending: dict[int, list[Candidate]] = {}
        for c in candidates(tokens):
            ending.setdefault(c.end, []).append(c)
        if not ending:
            return []
        value, choice = [0.0], [None]
        for j in range(1, len(tokens) + 1):
            top, by = value[j - 1], None
            for c in ending.get(j, ()):
                s = value[c.start] + self.score(c)
                if s > top:
                    top, by = s, c
            value.append(top)
            choice.append(by)
        out, j = [], len(tokens)
        while j:
            if choice[j] is None:
                j -= 1
            else:
                out.append(choice[j])
                j = choice[j].start
        return out[::-1]

    def train(self, examples: list[tuple[list[str], set[tuple[int, int, str]]]]) -> None:
        """Ascend the conditional log-likelihood of the given entities (Adagrad)."""
        w, seen = self.weights, [1e-8] * SIZE
        prepared = [(len(t), candidates(t), gold) for t, gold in examples]
        for _ in range(EPOCHS):
            for n, cands, gold in prepared:
                starting: dict[int, list[tuple[Candidate, float]]] = {}
                ending: dict[int, list[tuple[Candidate, float]]] = {}
                for c in cands:
                    pair = (c, self.score(c))
                    starting.setdefault(c.start, []).append(pair)
                    ending.setdefault(c.end, []).append(pair)
                ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
                for j in range(1, n + 1):
                    total = ahead[j - 1]
                    for c, s in ending.get(j, ()):
                        total = _log_add(total, ahead[c.start] + s)
                    ahead[j] = total
                for i in range(n - 1, -1, -1):
                    total = behind[i + 1]
                    for c, s in starting.get(i, ()):
                        total = _log_add(total, behind[c.end] + s)
                    behind[i] = total
                gradient: dict[int, float] = {}
                for pairs in starting.values():
                    for c, s in pairs:
                        g = ((c.start, c.end, c.kind) in gold) - math.exp(
                            ahead[c.start] + s + behind[c.end] - ahead[n]
                        )
                        if abs(g) > 1e-6:
                            for f in c.features:
                                gradient[f] = gradient.get(f, 0.0) + g
                for f, g in gradient.items():
                    g -= 1e-3 * w[f]
                    seen[f] += g * g
                    w[f] += 0.5 * g / math.sqrt(seen[f])


def tokenise(text: str) -> tuple[list[str], list[int]]:
    """Tokens and their borders."""
    borders, tokens = [0], []
    for m in _TOKEN.finditer(text):
        tokens.append(m.group())
        borders.append(m.end())
    return tokens, borders


def written_otherwise(text: str, spans: list[Span], turn: int) -> tuple[str, list[Span]]:
    """``text`` with its entities written another way, and where they then stand."""
    out, moved, at = [], [], 0
    length = 0
    for k, (kind, start, end) in enumerate(sorted(spans, key=lambda s: s.start)):
        if start < at:
            continue
        value, way = text[start:end], (turn + k) % 4
        digits = "".join(c for c in value if is_number(c))
        if kind == "email":
            name, _, host = value.partition("@")
            value = (value, f"{name} [at] {host}", f"{name} (at) {host.replace('.', ' (dot) ')}", value)[way]
        elif kind == "card" and len(digits) == 16:
            parts = [digits[i : i + 4] for i in range(0, 16, 4)]
            value = (value, ".".join(parts), "  ".join(parts).replace("  ", " "), "/".join(parts))[way]
        elif kind == "phone" and len(digits) == 11:
            a, b, c = digits[1:4], digits[4:7], digits[7:]
            value = (value, f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}")[way]
        elif kind == "ip":
            value = (value, value, value.replace(".", " . "), value)[way]
        out.append(text[at:start])
        length += start - at
        moved.append(Span(kind, length, length + len(value)))
        out.append(value)
        length += len(value)
        at = end
    return "".join(out) + text[at:], moved


#: Number-like text that is not personal data, put between the halves of training windows.
COUNTER_EXAMPLES = (
    "2024-01-05 2023-11-30", "12.04.2024 13.05.2024", "1 200 000 350 000", "1.2.3.4567", "v10.2.14.300",
    "2024-01-05 10 15 30", "0.1234567890", "1234567890", "10-20 30-40 50-60", "20240105123000",
)


def fitted(windows: list[str]) -> Field:
    """A field trained on windows of text, labelled by the base patterns, in several spellings.

    Digit runs and words that no pattern labels are the counter-examples. Without windows
    the field has no weights and adds nothing.
    """
    examples = []
    for k, window in enumerate(windows):
        other = COUNTER_EXAMPLES[k % len(COUNTER_EXAMPLES)]
        if not base_spans(window) and not base_spans(other):
            half = len(window) // 2
            examples.append((tokenise(f"{window[:half]} {other} {window[half:]}")[0], set()))
        spans = base_spans(window)
        for turn in range(4 if spans else 1):
            text, moved = written_otherwise(window, spans, turn) if turn else (window, spans)
            tokens, borders = tokenise(text)
            at = {b: i for i, b in enumerate(borders)}
            gold = {(at[s], at[e], k) for k, s, e in moved if s in at and e in at}
            examples.append((tokens, gold))
    field = Field()
    field.train(examples)
    return field


def training_windows(df: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> list[str]:
    """At most ``sample`` short windows around digits and at signs.

    They come from the at most ``sample`` texts with the smallest hashes of those that hold
    such characters, so all rows are looked at, but windows are cut from the chosen texts only.
    """
    text = col(text_col).cast("string")
    rows = df.select(text.alias("_text"), F.xxhash64(text).alias("_hash")).filter(
        F.col("_text").rlike(r"@|[0-9]{4}|[0-9]\.[0-9]")
    )
    chosen = [r["_hash"] for r in rows.select("_hash").distinct().orderBy("_hash").limit(sample).collect()]
    windows = F.regexp_extract_all(
        "_text", F.lit(r"(?s).{0,40}(?:@|\+[0-9]|[0-9]{4}|[0-9]\.[0-9]).{0,60}"), F.lit(0)
    )
    found = rows.filter(F.col("_hash").isin(chosen)).select(F.explode(windows).alias("w")).distinct()
    return [r["w"] for r in found.orderBy(F.xxhash64("w"), "w").limit(sample).collect()]


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, spans the field adds beside them)."""
    base = base_spans(text)
    taken = sorted((s.start, s.end) for s in base)
    extra = []
    for a, b in islands(text):
        tokens, borders = tokenise(text[a:b])
        for c in field.best(tokens):
            s, e = a + borders[c.start], a + borders[c.end]
            if not any(x < e and s < y for x, y in taken):
                extra.append(Span(c.kind, s, e))
    return base, extra


def written(spans: list[Span]) -> str:
    """kind:start:end, by kind as listed and start, joined by commas."""
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (order[x.kind], x.start, x.end)))


SCHEMA = pa.schema([
    ("_id", pa.null()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base", pa.string()), ("spans", pa.string()),
])


def find(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """Per row: id, number of base spans per kind, ``base`` and ``spans`` as text (code points).

    A null text counts as empty and has no spans. Rows are judged one by one, so repeated
    rows repeat; an empty table gives an empty one; other columns are not read. Without a
    ``field`` one is fitted to at most ``sample`` windows of the table itself.
    """
    if field is None:
        field = fitted(training_windows(df, text_col, sample))
    shared = df.sparkSession.sparkContext.broadcast(field.weights)  # SIZE numbers
    rows = id_and_text(df, id_col, text_col)
    names = [f.name for f in SCHEMA][1:]

    def run(batches):
        own = Field(shared.value)

        def judge(ids, texts):
            out: dict[str, list] = {n: [] for n in names}
            for text in texts:
                base, extra = all_spans(text or "", own)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s.kind == k for s in base))
                out["base"].append(written(base))
                out["spans"].append(written(base + extra))
            return {"_id": ids, **out}

        for batch in batches:
            schema = pa.schema([batch.schema.field("_id"), *list(SCHEMA)[1:]])
            yield from per_batch(judge, schema)([batch])

    kind = rows.schema["_id"].dataType.simpleString()
    made = rows.mapInArrow(
        run, f"_id {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base string, spans string"
    )
    return made.withColumnRenamed("_id", id_col)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`find` with the base spans as a digest."""
    found = find(df, id_col, text_col)
    return found.select(
        col(id_col), *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlaps are covered together."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s.start, -s.end)):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def masked(df: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``df`` with the personal data in ``text_col`` masked; null stays null, other columns as they are."""
    field = fitted(training_windows(df, text_col, sample))
    shared = df.sparkSession.sparkContext.broadcast(field.weights)
    at = [c for c in df.columns].index(text_col)

    def run(batches):
        own = Field(shared.value)
        for batch in batches:
            for part in slices(batch, at, 2 << 20):
                texts = [
                    t if t is None else mask(t, [s for found in all_spans(t, own) for s in found])
                    for t in part.column(at).to_pylist()
                ]
                columns = list(part.columns)
                columns[at] = pa.array(texts, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return df.mapInArrow(run, df.schema)
