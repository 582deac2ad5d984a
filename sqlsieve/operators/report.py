"""Counts of what was seen, kept, skipped and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import rules


def funnel(judged: DataFrame) -> DataFrame:
    """Files per reason of rejection; ``kept`` for those without one."""
    return judged.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_files")
    )


def pass_rate(judged: DataFrame) -> DataFrame:
    seen = F.count(F.lit(1))
    kept = F.count_if(F.col("reject_reason").isNull())
    return judged.agg(
        seen.alias("seen"), kept.alias("kept"), (kept / F.greatest(seen, F.lit(1))).alias("rate")
    )


def observed(judged: DataFrame, name: str = "funnel") -> tuple[DataFrame, Observation]:
    """The same rows, counting seen and kept as a side effect of the write that follows."""
    seen = Observation(name)
    rows = judged.observe(
        seen,
        F.count(F.lit(1)).alias("seen"),
        F.count_if(F.col("reject_reason").isNull()).alias("kept"),
    )
    return rows, seen


def collection_totals(visited: DataFrame, records: DataFrame) -> DataFrame:
    """Repositories seen, before their gates, and files kept."""
    return visited.agg(F.count_distinct("repo_name").alias("n_repos")).select(
        "n_repos", records.agg(F.count(F.lit(1))).scalar().alias("n_files")
    )


def generation_totals(chunks: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Chunks per outcome, the short ones that were never sent included."""
    short = chunks.where(F.length("chunk") < rules.MIN_SENT_CHUNK)
    return (
        outcomes.select("outcome")
        .unionByName(short.select(F.lit("short_chunk").alias("outcome")))
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("n_chunks"))
    )
