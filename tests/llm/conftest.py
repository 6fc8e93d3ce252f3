import pytest
from pyspark.sql import functions as F

from veriframe.llm.common import importable


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    importable(spark)


@pytest.fixture
def docs(spark):
    """Rows (id, text) as a table with extra columns named like results and temporary columns."""

    def make(rows, id_name="doc_id"):
        df = spark.createDataFrame(rows, f"{id_name} bigint, text string")
        for name in ("_id", "_text", "kept", "spans", "ids", "n_words", "set_id", "class_id", "host"):
            df = df.withColumn(name, F.lit("other"))
        return df

    return make


def brief(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
