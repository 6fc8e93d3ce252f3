import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veriframe.functions.text import (
    check_uid, cleaned_name, formatted_number, name_key, parse_tags, rule_id, slugify,
)


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "text, want",
    [("Order ID", "order_id"), ("  My--Table!! ", "my_table"), ("a__b", "a_b"), ("é", ""), ("", "")],
)
def test_slugify(spark, text, want):
    assert one(spark, text, slugify) == want


@pytest.mark.parametrize(
    "container, rule, fields, want",
    [
        ("orders", "notNull", ["order_id"], "orders__notnull__order_id"),
        ("orders", "unique", ["b", "a"], "orders__unique__a_b"),
        ("orders", "volumetric", [], "orders__volumetric"),
        ("My Orders", "between", ["Total Amount"], "my_orders__between__total_amount"),
        # Sorted before slugging: upper case comes first.
        ("t", "unique", ["a", "B"], "t__unique__b_a"),
    ],
)
def test_check_uid(spark, container, rule, fields, want):
    df = spark.createDataFrame([(container, rule, fields)], "c string, r string, f array<string>")
    got = df.select(check_uid(F.col("c"), F.col("r"), F.col("f")).alias("u")).first()["u"]
    assert got == want


@pytest.mark.parametrize(
    "name, want",
    [
        ("4711_SF", "4711"), ("4712_sf", "4712"), ("price_7_DB", "price_7"),
        ("plain_7", "plain_7"), ("x_Sf", "x_Sf"), ("x_SF_DB", "x_SF"), ("x_SNOWFLAKE", "x"),
    ],
)
def test_rule_id(spark, name, want):
    assert one(spark, name, rule_id) == want


@pytest.mark.parametrize(
    "text, want",
    [("a, b;c", ["a", "b", "c"]), ("", []), (None, []), (" ; ,x,, ", ["x"]), ("one", ["one"])],
)
def test_parse_tags(spark, text, want):
    assert one(spark, text, parse_tags) == want


TERMS = ["Inc.", "Corp.", "LLC", "The", "Limited Partnership"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Acme, Inc.", "Acme"), ("Acme INC", "Acme"), ("Acme Corp. LLC", "Acme"), ("Acme l.l.c.", "Acme"),
        ("Inc. LLC", "Inc."), ("Incorporated Acme", "Incorporated Acme"), ("Acme Limited  Partnership", "Acme"),
        ("The Acme", "The Acme"), ("Acme Inc. Trading", "Acme Inc. Trading"), (None, None), ("", ""),
    ],
)
def test_cleaned_suffix(spark, text, want):
    assert one(spark, text, lambda c: cleaned_name(c, TERMS)) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("The Acme LLC Trading Inc.", "Acme Trading"), ("the the Acme", "Acme"), ("The", "The"),
        ("Acme Inc. Corp. Trading", "Acme Trading"), ("LLC Inc", "LLC"),
    ],
)
def test_cleaned_everywhere(spark, text, want):
    got = one(spark, text, lambda c: cleaned_name(c, TERMS, suffix=True, prefix=True, interior=True))
    assert got == want


def test_terms_beyond_ascii(spark):
    assert one(spark, "Müller GRÜN", lambda c: cleaned_name(c, ["grün"])) == "Müller"
    assert one(spark, "Müller gmbh", lambda c: cleaned_name(c, ["GmbH"])) == "Müller"


def test_ignored_terms_stay(spark):
    assert one(spark, "Acme Inc.", lambda c: cleaned_name(c, TERMS, ["inc"])) == "Acme Inc."
    assert one(spark, "Acme Inc.", lambda c: cleaned_name(c, [])) == "Acme Inc."


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["Acme", "Inc.", "llc", "Blue", "CORP"]), min_size=1, max_size=5), min_size=1, max_size=30))
def test_suffix_property(spark, names):
    def model(words):
        words = list(words)
        while len(words) > 1 and re.sub("[.,]", "", words[-1]).lower() in ("inc", "llc", "corp"):
            words.pop()
        return " ".join(words)

    df = spark.createDataFrame([(" ".join(w),) for w in names], "t string")
    got = [r["o"] for r in df.select(cleaned_name(F.col("t"), TERMS).alias("o")).collect()]
    assert got == [model(w) for w in names]


@pytest.mark.parametrize(
    "text, want",
    [
        ("$1,234.50", 1234.5), ("(12.5)", -12.5), ("15%", 0.15), ("( 15 % )", -0.15), ("€ 1 000", 1000.0),
        ("-3", -3.0), ("1e3", 1000.0), ("abc", None), ("", None), (None, None), ("1.2.3", None), ("NaN", None),
    ],
)
def test_formatted_number(spark, text, want):
    assert one(spark, text, formatted_number) == pytest.approx(want) if want is not None else one(spark, text, formatted_number) is None


def test_name_key(spark):
    assert one(spark, "  ACME,  Inc. ", name_key) == "acme inc"


def test_keys_do_not_collide(spark):
    from veriframe.functions.keys import hash_slot, is_covered, record_key

    pairs = [("x\\", "y|z"), ("x|y\\", "z"), ("\\N", "z"), (None, "z"), ("x\\|y\\", "z")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.select(record_key(df, ["a", "b"]).alias("k")).distinct().count() == 5
    assert df.select(record_key(df, ["a"]).alias("k")).distinct().count() == 5
    maps = spark.sql("select map('a', 1, 'b', 2) m, array(map('x', 1, 'y', 2)) l union all select map('b', 2, 'a', 1), array(map('y', 2, 'x', 1))")
    assert maps.select(record_key(maps).alias("k")).distinct().count() == 1
    n = spark.range(200_000).select(F.col("id").cast("string").alias("id"))
    drawn = n.filter(is_covered(F.col("id"), 0.0004)).count()
    assert 40 < drawn < 130
    assert n.filter(is_covered(F.col("id"), 0.9996)).count() < 200_000
    assert n.agg(F.max(hash_slot(F.col("id")))).first()[0] > 1 << 31
