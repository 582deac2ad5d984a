"""The corpus table: kept files of both collectors in one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.dialect import feature_tags, is_modern
from ..functions.quality import is_quality, reject_reason

CORPUS_SCHEMA = (
    "content string, path string, repo_name string, license array<string>, size bigint, "
    "stars bigint, modern_tsql boolean, tsql_features array<string>, source string"
)


def small_enough(rows: DataFrame) -> DataFrame:
    """Index rows worth fetching, by metadata alone; a missing flag counts as false.

    Plain comparisons on columns, so the bounds reach the file scan.
    """
    return rows.where(
        (F.col("length_bytes") > rules.MIN_CHARS)
        & (F.col("length_bytes") < rules.MAX_CHARS)
        & ~F.coalesce("is_vendor", F.lit(False))
        & ~F.coalesce("is_generated", F.lit(False))
    )


def with_blob(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("blob_id") != "")


def with_content(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("content") != "")


def judged(files: DataFrame) -> DataFrame:
    """Add ``reject_reason``, null for kept files."""
    return files.withColumn("reject_reason", reject_reason("content", "path"))


def kept(files: DataFrame, *after: str) -> DataFrame:
    """Files that pass the quality rules, judged once the columns ``after`` are joined."""
    return files.where(is_quality("content", "path", *after))


def _or_empty(name: str, empty: Column) -> Column:
    return F.coalesce(F.col(name), empty).alias(name)


def dataset_records(files: DataFrame) -> DataFrame:
    """Records of dataset files; expects content, path, repo_name, detected_licenses and size."""
    return files.select(
        "content",
        _or_empty("path", F.lit("")),
        _or_empty("repo_name", F.lit("")),
        F.col("detected_licenses").alias("license"),
        _or_empty("size", F.lit(0).cast("bigint")),
        F.lit(rules.DATASET_SOURCE).alias("source"),
        feature_tags("content").alias("tsql_features"),
    )


def repo_records(files: DataFrame) -> DataFrame:
    """Records of repository files; expects content, path, repo_name, stars and license."""
    return files.select(
        "content",
        "path",
        "repo_name",
        F.col("stars").cast("bigint").alias("stars"),
        F.coalesce("license", F.lit(rules.UNKNOWN_LICENSE)).alias("license"),
        is_modern("content").alias("modern_tsql"),
        feature_tags("content").alias("tsql_features"),
        F.lit(rules.REPO_SOURCE).alias("source"),
    )


def modern_only(records: DataFrame) -> DataFrame:
    return records.where("modern_tsql")


def corpus(dataset: DataFrame, repos: DataFrame, backfill_modern: bool = False) -> DataFrame:
    """Both kinds of records in the corpus schema.

    Dataset records come without the modern flag and rank below every modern repository record;
    ``backfill_modern`` computes the flag for them as well.
    """
    if backfill_modern:
        dataset = dataset.withColumn("modern_tsql", is_modern("content"))
    both = dataset.unionByName(
        repos.withColumn("license", F.array("license")), allowMissingColumns=True
    )
    names = [field.split()[0] for field in CORPUS_SCHEMA.split(", ")]
    return both.select(*names)
