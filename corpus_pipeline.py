"""The document pipeline: STAGES, in order, each on all rows the one before kept.

Quality rules drop documents, the n-gram Jaccard join keeps one document of each group
of near copies, benchmark decontamination drops documents that hold a benchmark window,
personal data is masked, and SentencePiece encodes what is left.

Every stage reads and returns the columns of documents (the last adds its own), whatever
further columns there are; no rows give no rows. Null texts have no words and are dropped
by the first stage; the others let them pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.llm import decontaminate, near_duplicates, pii, quality, sentencepiece_bpe
from veriframe.llm.common import col, importable, table
from veriframe.session import durable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule, judged row by row."""
    importable(spark)
    kept = quality.passing(docs, "text")
    return kept.select(*[col(c) for c in docs.columns])


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the smallest id.

    See :func:`veriframe.llm.near_duplicates.one_of_each` for ties, nulls and repeated rows.
    """
    importable(spark)
    return near_duplicates.one_of_each(docs, "doc_id", "text")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), "text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    importable(spark)
    masked = pii.masked(docs, "text")
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and the digest of the text decoded from them."""
    importable(spark)
    return sentencepiece_bpe.with_ids(docs, sentencepiece_bpe.model_path(), "text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate_documents),
    ("decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", encoded),
]
#: SQL cannot express the random field of the fourth stage or the merges of the fifth.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
