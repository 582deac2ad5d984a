"""The collectors as Structured Streaming queries. All transforms are those of the batch side."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules
from ..operators.corpus import dataset_records, kept
from ..operators.joins import ROWS_PER_SPLIT
from ..sources import commits
from ..sources.blobs import attach_content
from ..sources.sinks import write_pairs, write_shards


def stream_dataset(index: DataFrame, blobs: DataFrame) -> DataFrame:
    """Records of a stream of index rows against the blob table; no state."""
    return dataset_records(kept(attach_content(index, blobs)))


def write_dataset_stream(
    index: DataFrame, blobs: DataFrame, path: str, checkpoint: str,
    rows_per_shard: int = rules.DATASET_SHARD_ROWS, rows_per_split: int = ROWS_PER_SPLIT,
) -> StreamingQuery:
    """Records of a stream of index rows as JSON shards, a commit per micro-batch.

    Each micro-batch is planned as a batch: it is sent to the store's buckets, and the rows of a blob
    that makes up much of it are split.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = dataset_records(kept(attach_content(batch, blobs, rows_per_split)))
        commits.commit(
            path, {"records": rows}, lambda df, to: write_shards(df, to, rows_per_shard), f"batch-{batch_id:08d}"
        )

    return (
        index.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_files(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Records of a stream of files that come with their content; no state.

    ``tasks`` deals the rows of a micro-batch evenly over so many: else a task judges all that a piece
    of its input holds, which is very many texts where these are well compressed.
    """
    if tasks is None:
        return dataset_records(kept(files))
    # The rules ask for a column that only the dealt rows have, so that they are not applied before.
    dealt = files.repartition(tasks).withColumn("_task", F.spark_partition_id())
    return dataset_records(kept(dealt, "_task"))


def first_seen_names(rows: DataFrame, column: str = "repo_name") -> DataFrame:
    """Each name once over the whole stream.

    Repeats within an Arrow batch go first, inside the task that read them, so a name that makes
    up much of the input does not all travel to the one task that keeps its state.
    """

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop_duplicates()

    names = rows.select(column).mapInPandas(thin, rows.select(column).schema)
    return names.dropDuplicates([column])


def write_stream(
    rows: DataFrame, path: str, checkpoint: str, rows_per_shard: int = rules.DATASET_SHARD_ROWS
) -> StreamingQuery:
    """Append to JSON shards until the input is used up; the checkpoint remembers what was read."""
    return (
        rows.writeStream.format("json")
        .option("maxRecordsPerFile", rows_per_shard)
        .option("ignoreNullFields", False)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def write_pair_stream(
    pairs: DataFrame, path: str, checkpoint: str, formats: str = "both"
) -> StreamingQuery:
    """Raw, Alpaca and chat outputs, a commit per micro-batch; a repeated batch writes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_pairs(batch, path, formats, name=f"batch-{batch_id:08d}")

    return (
        pairs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
