"""Write records and pairs as JSON lines in shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.chat import alpaca_columns, chat_messages, chat_text
from ..session import delete_path, write_table
from . import commits

FORMATS = ("alpaca", "chatml", "both")
PAIR_KEY = ["prompt_id", "source_repo", "source_path", "chunk_no"]
PAIR_KEY_SCHEMA = "prompt_id string, source_repo string, source_path string, chunk_no int"


def write_shards(
    records: DataFrame,
    path: str,
    rows_per_shard: int = rules.DATASET_SHARD_ROWS,
    mode: str = "errorifexists",
) -> None:
    """JSON lines, at most ``rows_per_shard`` per file, null fields kept."""
    (
        records.write.mode(mode)
        .option("maxRecordsPerFile", rows_per_shard)
        .option("ignoreNullFields", False)
        .json(path)
    )


def as_alpaca(pairs: DataFrame) -> DataFrame:
    return pairs.select(*alpaca_columns("instruction", "code"))


def as_chat(pairs: DataFrame) -> DataFrame:
    return pairs.select(chat_messages("instruction", "code").alias("messages"))


def as_train_text(chats: DataFrame) -> DataFrame:
    """Chat text in place of the message list."""
    return chats.withColumn("text", chat_text("messages")).drop("messages")


def pair_tables(pairs: DataFrame, formats: str = "both") -> dict[str, DataFrame]:
    if formats not in FORMATS:
        raise ValueError(f"formats must be one of {FORMATS}")
    tables = {"raw": pairs}
    if formats in ("alpaca", "both"):
        tables["alpaca"] = as_alpaca(pairs)
    if formats in ("chatml", "both"):
        tables["chatml"] = as_chat(pairs)
    return tables


def written_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys of the pairs committed below ``path``."""
    return commits.read(spark, path, "raw", PAIR_KEY_SCHEMA).distinct()


def write_pairs(pairs: DataFrame, path: str, formats: str = "both", name: str | None = None) -> bool:
    """Raw pairs always, Alpaca and chat forms as asked, each in its folder below ``path``.

    The forms are one commit: after a failure in any of them none counts as written, and the next call
    writes all of them. Pairs with a ``prompt_id`` are written once: those that were committed before,
    from the same chunk of the same file, are left out of all forms. ``name`` makes the commit itself
    happen once; false if it was there before.
    """
    spark = pairs.sparkSession
    keys = [k for k in PAIR_KEY if k in pairs.columns]
    if "prompt_id" in keys:
        done = written_keys(spark, path)
        same = [pairs[k].eqNullSafe(done[k]) for k in keys]
        pairs = pairs.join(done, same, "left_anti")
    kept, kept_path = write_table(pairs, "pairs")  # all forms are made from the same rows
    try:
        return commits.commit(path, pair_tables(kept, formats), write_shards, name)
    finally:
        delete_path(spark, kept_path)


def row_count(df: DataFrame) -> DataFrame:
    """Rows written so far."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
