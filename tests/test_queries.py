"""Every registered query against its SQL counterpart on the smallest data."""

import glob
import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The library's own; the training-data operators are tested in tests/llm.
QUERIES = {k: q for g in entry._GROUPS for k, q in entry._group(g).QUERIES.items()}
ORACLES = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(pdf):
    def cell(v):
        if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)):
            return "NULL"
        return repr(float(v)) if isinstance(v, float) else str(v)

    cols = sorted(pdf.columns)
    return cols, sorted(tuple(cell(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None))


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = canonical(QUERIES[name](spark, SF).toPandas())
    want = canonical(duck.execute(ORACLES[name]).df())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
