"""Rank corpus records: modern first, then repository files, feature weight and stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.dialect import feature_score
from .numbering import number_rows

RANK_COLUMNS = ["is_modern", "is_repo", "feature_score", "n_stars"]
# Make the order total; files are told apart by repository and path, else by content.
TIE_COLUMNS = ["repo_name", "path", "content_hash"]


def with_rank_key(records: DataFrame) -> DataFrame:
    return records.select(
        "*",
        F.coalesce("modern_tsql", F.lit(False)).cast("int").alias("is_modern"),
        F.coalesce(F.col("source") == rules.REPO_SOURCE, F.lit(False)).cast("int").alias("is_repo"),
        feature_score("tsql_features").alias("feature_score"),
        F.coalesce("stars", F.lit(0)).cast("bigint").alias("n_stars"),
        F.xxhash64("content").alias("content_hash"),
    )


def rank_order() -> list[Column]:
    return [F.desc(c) for c in RANK_COLUMNS] + [F.asc(c) for c in TIE_COLUMNS]


def ranked(records: DataFrame) -> DataFrame:
    """Records in rank order, with their key columns.

    A range-partitioned sort: partitions follow each other in rank order and none of them has to
    hold a whole group of equal scores, because the order goes on to repository and path.
    """
    return with_rank_key(records).orderBy(*rank_order())


def numbered_ranks(records: DataFrame) -> DataFrame:
    """Records without their content, with ``rank`` from 1 on. Contents stay out of the shuffle."""
    narrow = with_rank_key(records).drop("content")
    return number_rows(narrow, [], rank_order(), "rank")
