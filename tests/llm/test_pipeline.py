from fractions import Fraction

import corpus_pipeline
from sqlsieve.llm import queries

from .test_jaccard_join import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_their_decisions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())

    kept = stages["toxicity"](spark, docs, FOLDER)
    assert kept.columns == docs.columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    left = {r["doc_id"] for r in kept.collect()}
    right = sum((k in left) == (not toxic) for k, toxic in labels.items())
    assert right >= 0.9 * len(labels)

    kept = stages["near_duplicates"](spark, docs, FOLDER)
    assert kept.columns == docs.columns
    want = [k for k, n, c in brute(rows, 5, Fraction(4, 5)) if n == 0 or k == c]
    assert sorted(r["doc_id"] for r in kept.collect()) == want

    kept = stages["decontamination"](spark, docs, FOLDER)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    exact = {k for k, text in rows if any(i in text for i in items)}
    assert not exact & left and len(left) >= len(rows) - 2 * len(exact) - 2

    kept = stages["secrets"](spark, docs, FOLDER)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert kept.where("n_chars <> length(text)").count() == 0
    assert kept.where("text rlike 'AKIA[A-Z0-9]{16}'").count() == 0

    coded = stages["bpe"](spark, docs, FOLDER)
    assert coded.where("n_tokens <> size(ids)").count() == 0 and coded.count() == len(rows)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "bpe"]
