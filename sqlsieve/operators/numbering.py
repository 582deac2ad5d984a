"""Row numbers in a total order, without one task that sees a whole group.

``row_number`` over a window brings each group to one task. Here a group may span any number of
tasks: a row's number is its place within its piece of the group plus the rows in earlier pieces.
Only one small row per piece is aggregated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id: task number above, row number below


def _with_place(df: DataFrame) -> DataFrame:
    """Add ``_place``, rising with each task's row order, and fix it.

    Whatever drew the tasks' bounds, a sample or a file listing, is not repeated.
    """
    return cut_lineage(df.withColumn("_place", F.monotonically_increasing_id()))


def _number_placed(placed: DataFrame, group: list[str], piece: str, name: str) -> DataFrame:
    """Number rows whose pieces lie unbroken in ``_place`` and follow each other by ``piece``."""
    sizes = placed.groupBy(*group, piece).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = W.partitionBy(*group).orderBy(piece).rowsBetween(W.unboundedPreceding, -1)
    keys = [*group, piece]
    starts = sizes.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1 - F.col("_first")).alias("_shift"),
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    numbered = placed.join(starts, same, "inner")
    return numbered.withColumn(name, F.col("_place") + F.col("_shift"))


def number_rows(
    df: DataFrame, group: list[str], order: list[Column | str], name: str = "row_no"
) -> DataFrame:
    """Add ``name``: 1, 2, 3, … within each group in the given order.

    Group and order together must tell rows apart; the numbers follow them alone then, however
    the rows are spread. Order entries may be columns with ``.desc()``. The range bounds take a
    first pass over ``df``, so costly columns should come from a written table.
    """
    keys = [F.col(g) for g in group] + [F.col(o) if isinstance(o, str) else o for o in order]
    placed = _with_place(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    placed = placed.withColumn("_task", F.shiftright("_place", _ROW_BITS))
    return _number_placed(placed, group, "_task", name).select(*df.columns, name)


def running_sum(
    df: DataFrame, order: list[Column | str], value: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows up to this one in a total order.

    Each task sums its range of the order; only the totals of the tasks are added up in one place.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    placed = _with_place(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    placed = placed.withColumn("_task", F.shiftright("_place", _ROW_BITS))
    totals = placed.groupBy("_task").agg(F.sum(value).alias("_total"))
    earlier = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select("_task", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    own = F.sum(value).over(W.partitionBy("_task").orderBy("_place"))
    summed = placed.withColumn("_own", own).join(before, "_task")
    return summed.withColumn(name, F.col("_own") + F.col("_before")).select(*df.columns, name)


def first_at_or_after(points: DataFrame, queries: DataFrame, at: str, found: str) -> DataFrame:
    """``queries`` with the ``found`` of the first of ``points`` whose ``at`` is no less than theirs.

    Both are sorted together over any number of tasks; a task without a point for its last queries
    takes the first one of the tasks after it. ``points`` has ``at`` and ``found``.
    """
    names = queries.columns
    both = queries.withColumn(found, F.lit(None).cast(points.schema[found].dataType)).withColumn(
        "_point", F.lit(False)
    ).unionByName(points.select(at, found).withColumn("_point", F.lit(True)), allowMissingColumns=True)
    placed = _with_place(both.repartitionByRange(at, "_point").sortWithinPartitions(at, "_point"))
    placed = placed.withColumn("_task", F.shiftright("_place", _ROW_BITS))
    firsts = placed.where("_point").groupBy("_task").agg(F.min_by(found, "_place").alias("_first"))
    tasks = placed.select("_task").distinct().join(firsts, "_task", "left")
    later = W.orderBy("_task").rowsBetween(1, W.unboundedFollowing)
    tasks = tasks.select("_task", F.first("_first", ignorenulls=True).over(later).alias("_later"))
    rest = W.partitionBy("_task").orderBy("_place").rowsBetween(0, W.unboundedFollowing)
    filled = placed.withColumn("_own", F.first(found, ignorenulls=True).over(rest)).where("not _point")
    return filled.join(tasks, "_task").select(*names, F.coalesce("_own", "_later").alias(found))


def number_in_read_order(df: DataFrame, group: list[str], block: str, name: str) -> DataFrame:
    """Number rows as they come from files, without moving them.

    ``block`` is the offset of the part of the file that a row was read from: a block is read by
    one task in file order, and blocks follow each other by offset.
    """
    return _number_placed(_with_place(df), group, block, name).select(*df.columns, name)


def part_of(row_no: Column | str, rows_per_part: int) -> Column:
    """0 for the first ``rows_per_part`` rows, then 1, and so on."""
    row_no = F.col(row_no) if isinstance(row_no, str) else row_no
    return F.floor((row_no - 1) / F.lit(rows_per_part)).cast("long")


def assign_parts(
    df: DataFrame, rows_per_part: int, group: list[str], order: list[Column | str]
) -> DataFrame:
    """Add ``part`` of each row within its group."""
    numbered = number_rows(df, group, order, "_row_no")
    return numbered.withColumn("part", part_of("_row_no", rows_per_part)).drop("_row_no")
