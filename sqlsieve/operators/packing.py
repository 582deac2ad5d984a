"""Whole groups packed into shards one after the other, without one task that walks over all groups.

A shard takes groups in order until it has enough rows, so where it ends depends on where it began.
Running sums give, for every group, the group that a shard which began there would end with; jumps of
one shard are then composed to jumps of 2, 4, 8 … shards, and those mark all beginnings that the first
group leads to in as many rounds as the number of shards has binary digits. All tables are narrow, a
row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .numbering import first_at_or_after, number_rows, running_sum


def group_shards(sizes: DataFrame, group: str, least: int, order: list[str] | None = None) -> DataFrame:
    """``sizes`` (``group`` and ``n_rows``, which is positive) with the ``shard`` of each group.

    Shards are numbered from 0. Each has ``least`` rows or more, but for the last one, and no more
    than it needs; ``order`` and the group's name say which groups come first.
    """
    keys = [*(order or []), group]
    placed = number_rows(sizes, [], keys, "_no")
    placed = cut_lineage(running_sum(placed, ["_no"], "n_rows", "_end"))
    total = placed.agg(F.sum("n_rows")).first()[0] or 0
    # A shard that begins with group i ends with the first group whose end is no less than this.
    wanted = placed.select(F.col("_no").alias("i"), (F.col("_end") - F.col("n_rows") + least).alias("_end"))
    ends = first_at_or_after(placed.select("_end", F.col("_no").alias("to")), wanted, "_end", "to")
    jumps = ends.select("i", (F.col("to") + 1).alias("to")).where(F.col("to").isNotNull())
    jumps = cut_lineage(jumps)
    starts = placed.where("_no = 1").select(F.col("_no").alias("i"))
    for _ in range((total // least).bit_length()):
        reached = starts.join(jumps, "i").select(F.col("to").alias("i"))
        starts = cut_lineage(starts.union(reached).distinct())
        onward = jumps.select(F.col("i").alias("to"), F.col("to").alias("far"))
        jumps = cut_lineage(jumps.join(onward, "to").select("i", F.col("far").alias("to")))
    marked = placed.join(starts.select(F.col("i").alias("_no"), F.lit(1).alias("_new")), "_no", "left")
    marked = running_sum(marked.withColumn("_new", F.coalesce("_new", F.lit(0))), ["_no"], "_new", "_shard")
    return marked.select(*sizes.columns, (F.col("_shard") - 1).alias("shard"))


def pack_groups(rows: DataFrame, group: str, least: int, order: list[str] | None = None) -> DataFrame:
    """``rows`` with a ``shard`` that begins and ends between groups; a null group is one of its own.

    ``order``: columns of ``rows`` whose least value in a group says when it comes.
    """
    first = [F.min(c).alias(c) for c in order or []]
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), *first)
    shards = group_shards(sizes, group, least, order)
    shards = shards.select(F.col(group).alias("_group"), "shard")
    return rows.join(shards, rows[group].eqNullSafe(shards["_group"])).drop("_group")
