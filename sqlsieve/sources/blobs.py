"""The dataset index and the file contents that belong to it."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators.corpus import dataset_records, kept, small_enough, with_blob
from ..operators.joins import ROWS_PER_SPLIT, frequent_keys

INDEX_SCHEMA = (
    "blob_id string, src_encoding string, length_bytes bigint, is_vendor boolean, "
    "is_generated boolean, path string, repo_name string, detected_licenses array<string>, "
    "size bigint"
)

TOGETHER = 1_000


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def stream_index(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Index rows as their files arrive, ``files_per_batch`` per micro-batch."""
    reader = spark.readStream.schema(INDEX_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def text_of(packed: bytes | None, charset: str | None) -> str | None:
    """Unpacked and decoded text, none where either step fails."""
    try:
        plain = gzip.decompress(packed).decode(charset)
        plain.encode("utf-8")
        return plain
    except Exception:  # noqa: BLE001 - any failure drops the row
        return None


def decoded(data: Column | str, encoding: Column | str) -> Column:
    """Unpacked and decoded text, null where either step fails."""

    @F.pandas_udf(StringType())
    def decode(data: pd.Series, encoding: pd.Series) -> pd.Series:
        return pd.Series([text_of(d, e) for d, e in zip(data, encoding)], dtype=object)

    # Marked so that a filter on the text does not make the optimizer decode a second time.
    return decode.asNondeterministic()(data, encoding)


def save_store(blobs: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Keeps blobs as a table bucketed by ``blob_id``, one file per bucket, and returns it.

    Joins on ``blob_id`` leave its bytes where they are and send the other side to them, in batches
    and in micro-batches. Size buckets so that the index rows of each fit in a task's memory, about a
    hundredth of its bytes; a GB per bucket is a good start.
    """
    spark = blobs.sparkSession
    rows = blobs.select("blob_id", "data").repartition(buckets, "blob_id")
    writer = rows.write.format("parquet").bucketBy(buckets, "blob_id").sortBy("blob_id")
    writer.option("path", path).saveAsTable(table)
    return spark.table(table)


def open_store(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """A store that another session saved, under a name for this one."""
    spark.sql(
        f"""create table if not exists `{table}` (blob_id string, data binary) using parquet
            clustered by (blob_id) sorted by (blob_id) into {int(buckets)} buckets location '{path}'"""
    )
    return spark.table(table)


def hot_blobs(index: DataFrame, rows_per_split: int = ROWS_PER_SPLIT) -> list[str]:
    """Blobs that so many index rows share that these are set apart."""
    return frequent_keys(index, "blob_id", rows_per_split)


def attach_content(
    index: DataFrame, blobs: DataFrame, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Small enough index rows with their text; rows without one drop out.

    ``blob_id`` is unique in ``blobs``; a table that ``save_store`` made is not shuffled, and neither
    are the texts: index rows go to where their blob lies, up to ``TOGETHER`` that share a blob and a
    charset as one, so that it is unpacked once for all of them. Only bytes and charsets go to Python,
    in size-bounded Arrow batches. Rows of much-copied blobs are set apart and meet the texts of these,
    which are few, in a join that adaptive execution may broadcast or split. A stream meets the blobs
    row by row; ``write_dataset_stream`` plans its micro-batches as batches.
    """
    wanted = with_blob(small_enough(index))
    if wanted.isStreaming:
        joined = wanted.join(blobs, "blob_id")
        texts = joined.withColumn("content", decoded("data", "src_encoding")).drop("data")
        return texts.where("content is not null")
    hot = hot_blobs(wanted.select("blob_id"), rows_per_split)
    if not hot:
        return _met(wanted, blobs)
    is_hot = F.col("blob_id").isin(hot)
    own = _met(wanted.where(~is_hot), blobs.where(~is_hot))
    return own.unionByName(_met_hot(wanted.where(is_hot), blobs.where(is_hot)))


def _met(wanted: DataFrame, blobs: DataFrame) -> DataFrame:
    """Index rows sent to their blobs, which are joined and unpacked where they lie."""
    key = ["blob_id", "src_encoding"]
    rest = [c for c in wanted.columns if c not in key]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(*rest)))
    chunk = F.floor((place - 1) / F.lit(TOGETHER))
    rows = wanted.where("src_encoding is not null").withColumn("_chunk", chunk)
    rows = rows.groupBy(*key, "_chunk").agg(F.collect_list(F.struct(*rest)).alias("_rows"))
    # The index side is built into a table in memory: a sort would move the bytes about.
    met = blobs.join(rows.hint("shuffle_hash"), "blob_id")
    texts = met.select(*key, "_rows", decoded("data", "src_encoding").alias("content"))
    texts = texts.where("content is not null").select(*key, F.explode("_rows").alias("_row"), "content")
    return texts.select(*key, "_row.*", "content").select(*wanted.columns, "content")


def _met_hot(wanted: DataFrame, blobs: DataFrame) -> DataFrame:
    """The same for a few blobs with very many rows each: texts first, then rows."""
    key = ["blob_id", "src_encoding"]
    asked = wanted.select(*key).distinct()
    texts = blobs.join(asked, "blob_id").select(*key, decoded("data", "src_encoding").alias("content"))
    return wanted.join(texts.where("content is not null"), key).select(*wanted.columns, "content")


def collect_dataset(
    index: DataFrame, blobs: DataFrame, max_samples: int | None = None
) -> DataFrame:
    """From index and blobs to corpus records. ``max_samples`` keeps that many, any of them."""
    records = dataset_records(kept(attach_content(index, blobs)))
    return records if max_samples is None else records.limit(max_samples)
