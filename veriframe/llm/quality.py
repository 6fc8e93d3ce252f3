"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a column expression over the words and lines of a text and every
rule compares two measures in whole numbers, so the verdict is one projection of
built-in functions: no user function, no shuffle, no second pass.

Words are maximal runs of characters other than blank, tab, newline, vertical tab,
form feed and carriage return; lines are split at newlines.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.llm.common import col

SYMBOLS = r"[#*$%&|<>]"
# Common short words of the languages in the corpus; prose of some length has several of them.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "as", "was", "on", "be",
    "der", "die", "und", "das", "ist", "nicht", "mit", "auf", "den", "zu", "von", "ein", "eine", "im",
    "le", "la", "les", "et", "des", "un", "une", "du", "est", "que", "dans", "pour", "qui", "sur",
    "el", "los", "las", "y", "en", "de", "del", "una", "por", "con", "para", "se", "no", "es",
)


class Rule(NamedTuple):
    """Fails a document where ``scale * measure`` lies outside [low * base, high * base].

    ``base`` None stands for the constant 1. Whole numbers on both sides keep borders exact.
    """

    name: str
    measure: str
    base: str | None = None
    low: int | None = None
    high: int | None = None
    scale: int = 1


#: The contract's own conditions.
BASE_RULES = (
    Rule("too_short", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=50, scale=100),
)
#: The threshold table: length, symbol, stop-word and line ratios.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2, high=20),
    Rule("symbols", "n_symbols", "n_words", high=10, scale=100),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50, scale=100),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=30, scale=100),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=90, scale=100),
    Rule("no_letters", "n_letterless_words", "n_words", high=30, scale=100),
)


def compiled(rules: Sequence[Rule]) -> Column:
    """Array of the names of the rules a row fails; empty where it passes all."""
    failed = []
    for r in rules:
        value = F.col(r.measure) * r.scale
        base = F.col(r.base) if r.base else F.lit(1).cast("bigint")
        outside = F.lit(False)
        if r.low is not None:
            outside = outside | (value < base * r.low)
        if r.high is not None:
            outside = outside | (value > base * r.high)
        failed.append(F.when(outside, F.lit(r.name)))
    return F.array_compact(F.array(*failed))


def _windows() -> Column:
    """The 3-word windows as sorted numbers: hash bits on top, the position in the low bits."""
    return F.expr(
        "case when n_words < 4 then cast(array() as array<bigint>) else "
        "sort_array(transform(sequence(0, cast(n_words as int) - 3), i -> "
        "(xxhash64(_words[i], _words[i + 1], _words[i + 2]) & ~_mask) | cast(i as bigint))) end"
    )


def _repeats() -> Column:
    """Positions of windows that equal another one, in order.

    Equal windows are neighbours in ``_windows``. Neighbours that share the hash bits are
    compared word by word, so different windows never count as equal. (Equal ones could be
    overlooked only if a third, different window shared their hash bits and stood between.)
    """
    words = " and ".join(
        f"get(_words, cast(x & _mask as int) + {k}) = get(_words, cast(get(_windows, k {{}}) & _mask as int) + {k})"
        for k in range(3)
    )
    equal = f"(x & ~_mask = get(_windows, k {{}}) & ~_mask and {words})"
    near = " or ".join(f"coalesce({equal.format(*[d] * 4)}, false)" for d in ("- 1", "+ 1"))
    return F.expr(
        f"sort_array(filter(transform(_windows, (x, k) -> if({near}, x & _mask, -1L)), x -> x >= 0))"
    )


def measures(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the measures of ``text``; a null text counts as empty.

    Intermediate columns start with an underscore; ``df`` must hold none of these names.
    """
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return (
        df.withColumn("_text", F.coalesce(text, F.lit("")))
        .withColumn("_words", F.regexp_extract_all("_text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
        .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")))
        .withColumns({
            "n_words": F.size("_words").cast("bigint"),
            "_mask": F.expr("shiftleft(1L, length(bin(size(_words)))) - 1"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint"),
            "n_stop_words": F.size(F.array_intersect("_words", stop)).cast("bigint"),
            "n_letterless_words": F.regexp_count(
                "_text", F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])")
            ).cast("bigint"),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_ellipsis_lines": F.size(
                F.filter("_lines", lambda l: l.rlike(r"(\.\.\.|\u2026)[\x20\x09-\x0D]*$"))
            ).cast("bigint"),
            "n_bullet_lines": F.size(
                F.filter("_lines", lambda l: l.rlike(r"^[\x20\x09-\x0D]*[-*\u2022]"))
            ).cast("bigint"),
        })
        .withColumn("_windows", _windows())
        .withColumn("_repeats", _repeats())
        .withColumn("n_repeat_words", F.expr(
            "aggregate(zip_with(_repeats, slice(_repeats, 2, size(_repeats)), "
            "(a, b) -> least(3L, b - a)), 0L, (n, x) -> n + x)"
        ))
        # The optimiser moves no filter below a projection that names the partition. Moved there,
        # a filter would hold the definitions of the arrays inside one another, evaluated per word.
        .withColumns({m: F.when(F.spark_partition_id() >= 0, F.col(m)) for m in MEASURES})
    )


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_stop_words", "n_letterless_words", "n_ellipsis_lines", "n_bullet_lines",
)


def judge(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Per row: the id, the measures, ``base_failed``, ``failed_rules`` and ``kept``.

    A null or empty text has no words and fails as too short. Rows are judged one by one:
    repeated rows repeat, order plays no part. Other columns are not read; an empty table
    gives an empty one.
    """
    rows = df.select(col(id_col).alias("_id"), col(text_col).cast("string").alias("_given"))
    judged = measures(rows, F.col("_given"))
    return (
        judged.select(
            F.col("_id").alias(id_col),
            *MEASURES,
            (F.size(compiled(BASE_RULES)) > 0).alias("base_failed"),
            compiled((*BASE_RULES, *rules)).alias("failed_rules"),
        )
        .withColumn("kept", F.size("failed_rules") == 0)
    )


def passing(df: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``df`` that fail no rule, with all their columns, whatever those are called."""
    rows = df.select(
        F.struct(*[col(c) for c in df.columns]).alias("_row"), col(text_col).cast("string").alias("_given")
    )
    judged = measures(rows, F.col("_given"))
    return judged.filter(F.size(compiled((*BASE_RULES, *rules))) == 0).select("_row.*")
