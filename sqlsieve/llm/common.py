"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, new_table_path

#: Removes the shuffle files of a query once it has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table by name."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, _UPPER, _LOWER)


def or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def vocabulary_path(name: str) -> str:
    """Where the public vocabulary files lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def others(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` but those that a new column of the same name replaces."""
    taken = {n.lower() for n in names}
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in taken]


def release(spark: SparkSession) -> None:
    """Lets go of shuffle files that nothing needs any more, as after a checkpoint.

    Spark deletes them once the driver's collector finds that no plan refers to them; left to
    itself that may come long after the disks are full.
    """
    gc.collect()
    spark._jvm.System.gc()


def trim() -> None:
    """Gives back memory that a Python process has freed; an idle worker else keeps it beside the others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)


def trimmed(work: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """``work`` on a group, and ``trim`` once its own tables are gone."""

    def call(rows: pd.DataFrame) -> pd.DataFrame:
        try:
            return work(rows)
        finally:
            trim()

    return call


def stored(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder, read back; ``drop_stored`` removes it.

    For steps that repeat: unlike a checkpoint a table has a size of its own, not one that the
    planner works out from all the steps before it. The shuffle files of the step go with it.
    ``batch_rows``: rows that go to Python at a time, for rows that are wide.
    """
    spark, path = df.sparkSession, new_table_path(df.sparkSession, name)
    wanted = {CLEANUP: "true"} | ({BATCH_ROWS: str(batch_rows)} if batch_rows else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        # Planned anew, as plans keep the settings they were made with.
        df.select("*").write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def drop_stored(*tables: DataFrame | None) -> None:
    for table in tables:
        if table is not None:
            delete_path(table.sparkSession, table.stored_path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def by_chars(texts, limit: int = 1_000_000) -> Iterator[list]:
    """Texts, or lists, in runs of about ``limit`` characters, so that results leave in small batches."""
    part, chars = [], 0
    for text in texts:
        part.append(text)
        chars += len(text)
        if chars >= limit:
            yield part
            part, chars = [], 0
    if part:
        yield part


def running(numbers: Column, block: int = 256) -> Column:
    """Sums of an array of numbers up to each of its positions.

    Worked out by blocks, as an array that grows by one element at a time is copied each time.
    """
    zero = F.lit(0).cast("long")
    grow = lambda done, n: F.concat(
        done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), zero) + n)
    )
    none = F.array().cast("array<bigint>")
    steps = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / block).cast("int"))
    parts = F.when(F.size(numbers) == 0, F.array().cast("array<array<bigint>>")).otherwise(
        F.transform(
            steps, lambda b: F.aggregate(F.slice(numbers, b * block + 1, block), none, grow)
        )
    )
    before = F.aggregate(
        parts,
        F.array(zero),
        lambda done, p: F.concat(done, F.array(F.element_at(done, -1) + F.element_at(p, -1))),
    )
    return F.flatten(
        F.zip_with(
            parts,
            F.slice(before, 1, F.size(parts)),
            lambda p, b: F.transform(p, lambda n: n + b),
        )
    )
