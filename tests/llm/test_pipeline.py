import random

import corpus_pipeline as C
import sentencepiece
from pyspark.sql import functions as F

from veriframe.llm import decontaminate as D
from veriframe.llm import pii as P
from veriframe.llm import quality as Q
from veriframe.llm.sentencepiece_bpe import model_path


def clean(rng, n=120):
    stop = ["the", "of", "and", "to", "in"]
    return [rng.choice(stop) if i % 4 == 0 else "".join(rng.choice("abcdehilnorstu") for _ in range(rng.randint(3, 8))) for i in range(n)]


def test_planted_cases(spark, tmp_path):
    rng = random.Random(11)
    item = clean(rng, 40)
    good = [clean(rng) for _ in range(30)]
    rows = [(i, " ".join(w)) for i, w in enumerate(good)]
    rows += [(100 + i, " ".join(w)) for i, w in enumerate(good[:5])]  # exact copies
    near = [list(w) for w in good[5:10]]
    for w in near:
        w[60] = "changed"
    rows += [(110 + i, " ".join(w).upper() if i == 0 else " ".join(w)) for i, w in enumerate(near)]
    leak = clean(rng)
    rows += [(200, " ".join([*leak[:50], *item[5:20], *leak[50:]])), (201, "too short"), (202, None), (203, ""), (204, "the of " * 200)]
    rows += [(300, " ".join([*clean(rng), "mail", "joe.doe@example.com", "or", "+1 (415) 555-1234"])), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "'en' as lang", "'s' as source", "cast(length(text) as bigint) as n_chars", "1 as ids", "2 as _row", "3 as _failed", "4 as set_id"
    )
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    out = C.run(spark, sf)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(got) and set(got) == {*range(30), 300}
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    for i, w in enumerate(good):
        assert got[i]["text"] == " ".join(w)
    assert got[300]["text"].endswith("mail <email> or <phone>") and got[300]["n_chars"] == len(got[300]["text"])
    assert all(r["ids_"] == library.encode(r["text"], add_eos=True) and r["n_tokens"] == len(r["ids_"]) for r in got.values())
    assert out.columns[: len(docs.columns)] == docs.columns


def test_stages_one_by_one(spark):
    """Each stage against a plain version of its decision, on given tables."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    stages = dict(C.STAGES)
    first = stages["quality_rules"](spark, docs, sf)
    kept = {r["doc_id"] for r in Q.judge(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in first.collect()} == kept and first.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    _, spans, _ = D.Searcher.build(benchmark).search(list(texts.values()))
    third = stages["decontamination"](spark, docs, sf)
    assert {r["doc_id"] for r in third.collect()} == {i for i, s in zip(texts, spans) if not s}
    fourth = {r["doc_id"]: r["text"] for r in stages["personal_data"](spark, docs, sf).collect()}
    assert set(fourth) == set(texts) and not any(P.base_spans(t) for t in fourth.values() if t)
    assert all(fourth[i] == t for i, t in texts.items() if t and not any(c.isdigit() or c == "@" for c in t))


def test_empty_and_nulls(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    nulls = docs.limit(3).select(*[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
    for rows, left in ((docs.limit(0), 0), (nulls, 0)):
        out = rows
        for _, stage in C.STAGES:
            out = stage(spark, out, sf)
        assert out.count() == left
    for name, stage in C.STAGES[1:]:
        assert stage(spark, nulls, sf).count() == (1 if name == "near_duplicates" else 3)


def test_contract():
    assert 4 <= len(C.STAGES) <= 5 and C.ORACLE_SQL is None and C.QUERIES == {"pipeline": C.run}
