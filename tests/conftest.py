import pytest

from veriframe.functions import skew
from veriframe.session import session


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__sql__adaptive__coalescePartitions__enabled="true",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Every join as on data too large to broadcast, and nearly every key hot."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(skew, "SLOTS", 40)
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 2)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df, *cols):
    """Rows as sorted tuples."""
    out = (df.select(*cols) if cols else df).collect()
    return sorted((tuple(r) for r in out), key=lambda r: tuple((v is None, str(v)) for v in r))
