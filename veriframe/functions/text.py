"""String columns: slugs, stable check ids, tags and name clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Database suffixes that are not part of a rule id.
RULE_ID_SUFFIXES = (
    "SF", "sf", "DB", "db", "BQ", "bq", "PG", "pg",
    "SNOW", "snow", "SNOWFLAKE", "snowflake",
)


def strip_blanks(col: Column) -> Column:
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def slugify(col: Column) -> Column:
    """Lower case, runs of anything else than a-z0-9 become one ``_``, ends trimmed."""
    runs = F.regexp_replace(F.lower(col), "[^a-z0-9]+", "_")
    return F.btrim(runs, F.lit("_"))


def rule_and_fields(rule_type: Column, fields: Column) -> Column:
    """``rule__field1_field2``: fields are sorted first and slugged afterwards."""
    slugs = F.array_join(F.transform(F.sort_array(fields), slugify), "_")
    return F.concat_ws("__", slugify(rule_type), F.when(F.size(fields) > 0, slugs))


def check_uid(container: Column, rule_type: Column, fields: Column) -> Column:
    """``container__rule__sorted_fields``; without fields the last part is left out."""
    head = slugify(F.coalesce(container, F.lit("")))
    return F.concat_ws("__", head, rule_and_fields(F.coalesce(rule_type, F.lit("")), fields))


def rule_id(col: Column) -> Column:
    """Drop one trailing database suffix such as ``_SF``."""
    return F.regexp_replace(col, f"_(?:{'|'.join(RULE_ID_SUFFIXES)})$", "")


def parse_tags(col: Column) -> Column:
    """Split on ``,`` or ``;``, trim, drop blanks; null gives an empty array."""
    parts = F.split(F.coalesce(col, F.lit("")), "[;,]")
    return F.filter(F.transform(parts, strip_blanks), lambda t: t != "")


def name_key(col: Column) -> Column:
    """Comparison key of a name: lower case, no punctuation, single blanks."""
    bare = F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}\s]+", "")
    return strip_blanks(F.regexp_replace(bare, r"\s+", " "))


def _term_pattern(term: str) -> str:
    """One dropped term, ignoring case and any ``.`` or ``,`` written inside it."""
    words = [w for w in re.sub(r"[.,]", "", term).split() if w]
    return r"\s+".join(
        "[.,]*" + "".join(re.escape(ch) + "[.,]*" for ch in word) for word in words
    )


def cleaned_name(
    col: Column,
    terms_to_drop: list[str],
    terms_to_ignore: list[str] = (),
    suffix: bool = True,
    prefix: bool = False,
    interior: bool = False,
) -> Column:
    """Strip business terms at the end, the start or strictly inside a name.

    End and start are stripped repeatedly, but never the last remaining word.
    A comma left hanging by a dropped ending goes with it.
    """

    def plain(term: str) -> str:
        return " ".join(re.sub(r"[.,]", "", term).lower().split())

    ignored = {plain(t) for t in terms_to_ignore}
    terms = [t for t in terms_to_drop if plain(t) and plain(t) not in ignored]
    out = F.regexp_replace(strip_blanks(col), r"\s+", " ")
    if not terms:
        return out
    any_term = "(?:" + "|".join(_term_pattern(t) for t in sorted(terms, key=len, reverse=True)) + ")"
    # Matching case beyond ASCII is slow, and needed only for such terms.
    case = "(?i)" if any_term.isascii() else "(?iu)"
    if suffix:
        out = F.regexp_replace(out, rf"{case}(?<=[^\s,]),*(?:\s+{any_term})+$", "")
    if prefix:
        out = F.regexp_replace(out, rf"{case}^(?:{any_term}\s+)+(?=\S)", "")
    if interior:
        out = F.regexp_replace(out, rf"{case}(?<=\S )(?:{any_term} )+(?=\S)", "")
    return out


def formatted_number(col: Column) -> Column:
    """Numeric value of a formatted string; anything else gives null.

    Currency signs, grouping commas and blanks go, ``(x)`` is negative and a
    trailing ``%`` divides by 100.
    """
    text = strip_blanks(col)
    negative = text.rlike(r"^\(.*\)$")
    percent = F.regexp_replace(text, r"[()\s]", "").endswith("%")
    digits = F.regexp_replace(text, r"[$€£¥,\s()%]", "")
    is_number = digits.rlike(r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$")
    value = F.when(is_number, digits.try_cast("double"))
    value = F.when(percent, value / 100).otherwise(value)
    return F.when(negative, -value).otherwise(value)
