"""Joins on keys of which a few may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SPLIT = 1_000_000

JOINS = ("inner", "left", "left_semi", "left_anti")


def hot_keys(df: DataFrame, key: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows, and how many ``_splits`` each needs.

    An exact count with partial sums; of a table of n rows at most n / ``rows_per_split`` keys
    can be hot.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    splits = F.ceil(F.col("_rows") / F.lit(rows_per_split)).cast("int")
    return counts.where(F.col("_rows") > rows_per_split).select(key, splits.alias("_splits"))


def frequent_keys(df: DataFrame, key: str, rows_per_split: int = ROWS_PER_SPLIT) -> list:
    """Keys that more than ``rows_per_split`` rows share, or one row in 10,000 if that is more.

    Candidates come from bounded counters inside the tasks, at most 10,000 of them, so that near-unique
    keys are not shuffled to find none; the candidates are then counted exactly.
    """
    n = df.count()
    if n <= rows_per_split:
        return []
    support = max(rows_per_split / n, 1.01e-4)
    found = df.stat.freqItems([key], support).first()[0]
    counts = df.where(F.col(key).isin(list(found))).groupBy(key).count()
    return [r[key] for r in counts.where(F.col("count") > rows_per_split).collect()]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    spread_by: Sequence[str],
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Equi-join in which rows of hot left keys are spread over several tasks.

    ``right`` has few rows per key. A left row of a hot key gets a salt from a hash of its
    ``spread_by`` columns, which tell rows of one key apart; the right rows of hot keys are
    repeated once per salt. The table of hot keys is broadcast: its size is bounded by the
    left rows over ``rows_per_split``.
    """
    if how not in JOINS:
        raise ValueError(f"how must be one of {JOINS}")
    hot = F.broadcast(hot_keys(left, key, rows_per_split))
    n_splits = F.coalesce("_splits", F.lit(1))
    salt = F.pmod(F.xxhash64(*spread_by), n_splits).cast("int")
    salted = left.join(hot, key, "left").withColumn("_salt", salt).drop("_splits")
    repeated = (
        right.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), n_splits - 1)))
        .drop("_splits")
    )
    joined = salted.join(repeated, [key, "_salt"], how).drop("_salt")
    return joined.select(*left.columns, *[c for c in joined.columns if c not in left.columns])
