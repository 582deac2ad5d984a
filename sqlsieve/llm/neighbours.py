"""The rows before and after each row in a global order, without one task that holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage


def with_neighbours(rows: DataFrame, order: list[str], carry: list[str]) -> DataFrame:
    """``rows`` with the structs ``before`` and ``after``: ``carry`` of the rows next to each one.

    The rows are dealt out by ranges of ``order``, which must set them all apart, and written to
    the shared folder, so that the ranges stay as they are. Neighbours are found within each
    range; the first and last row of each range meet in a table of one row per range. So ``rows``
    should be narrow. Nulls come first.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    carried, key = F.struct(*carry), F.struct(*order)
    within = Window.partitionBy("_range").orderBy(*order)
    ends = ranged.groupBy("_range").agg(
        F.min_by(carried, key).alias("first"), F.max_by(carried, key).alias("last")
    )
    ranges = Window.orderBy("_range")
    ends = ends.select(
        "_range",
        F.lag("last").over(ranges).alias("_earlier"),
        F.lead("first").over(ranges).alias("_later"),
    )
    inner = ranged.withColumns(
        {"before": F.lag(carried).over(within), "after": F.lead(carried).over(within)}
    )
    return (
        inner.join(F.broadcast(ends), "_range")
        .withColumn("before", F.coalesce("before", "_earlier"))
        .withColumn("after", F.coalesce("after", "_later"))
        .drop("_range", "_earlier", "_later")
    )
