"""A training corpus out of the documents: five stages, each on what the one before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of the documents. Between stages the rows are written as Parquet to the shared folder, so that
a lost executor costs no more than the tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlsieve.llm import bpe, decontamination, jaccard_join, secrets, toxicity
from sqlsieve.llm.common import others, read
from sqlsieve.session import delete_path, new_table_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier holds toxic go."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group that five-word shingles link at a similarity of 0.8."""
    return jaccard_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; their secrets are replaced by a mark, and their lengths follow."""
    redacted = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return redacted.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids."""
    coded = bpe.encode(docs.select(*others(docs, "n_tokens")), ids="ids")
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("secrets", secret_spans),
    ("bpe", tokens),
]

#: No SQL: a trained classifier and edit distances are beyond it. tests/llm holds the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. What one stage wrote goes once the next has been written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_table_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
