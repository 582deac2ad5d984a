"""Line files with names of their own, ``shard_0000.jsonl`` and so on, written by a data source.

A task writes the shards that were dealt to it into a folder for drafts and reports them; the driver
moves those of the tasks that count to their names once all have ended, so attempts that failed or ran
twice leave nothing, and neither does a write that is given up.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SOURCE = "named_lines"


@dataclass
class Written(WriterCommitMessage):
    """Drafts of one task: file name, draft, number of lines."""

    files: list[tuple[str, str, int]]


class NamedLines(DataSource):
    """Columns ``name`` and ``value``: each row is a line of the file of that name."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "name string, value string"

    def writer(self, schema, overwrite: bool) -> NamedLinesWriter:
        return NamedLinesWriter(self.options["path"], self.options["job"])


class NamedLinesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str):
        self.path, self.job = path.rstrip("/"), job

    def _store(self) -> tuple[pa.fs.FileSystem, str]:
        path = self.path.removeprefix("file:") if self.path.startswith("file:/") else self.path
        path = "/" + path.lstrip("/") if path.startswith("/") else path
        return pa.fs.FileSystem.from_uri(path)

    def _drafts(self, folder: str) -> str:
        return f"{folder}/_drafts-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = self._store()
        drafts = self._drafts(folder)
        store.create_dir(drafts, recursive=True)
        files, out, at, lines = [], None, None, 0
        try:
            for batch in iterator:
                for name, value in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist()):
                    if name != at:
                        if out:
                            out.close()
                            files[-1] = (*files[-1][:2], lines)
                        at, lines = name, 0
                        files.append((name, f"{drafts}/{uuid.uuid4().hex}", 0))
                        out = store.open_output_stream(files[-1][1], buffer_size=1 << 20)
                    out.write(value.encode() + b"\n")
                    lines += 1
        finally:
            if out:
                out.close()
        if files:
            files[-1] = (*files[-1][:2], lines)
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = self._store()
        files = [f for m in messages if m for f in m.files]
        names = [name for name, _, _ in files]
        there = [i.path for i in store.get_file_info([f"{folder}/{n}" for n in names]) if i.type != pa.fs.FileType.NotFound]
        try:
            if len(set(names)) < len(names):
                raise ValueError("rows of one file came from more than one task")
            if there:
                raise FileExistsError(there[0])
            for name, draft, _ in files:
                store.move(draft, f"{folder}/{name}")
        finally:
            self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = self._store()
        drafts = self._drafts(folder)
        if store.get_file_info(drafts).type != pa.fs.FileType.NotFound:
            store.delete_dir(drafts)


def file_name(stem: Column | str, number: Column | str, form: str = "shard", suffix: str = ".jsonl") -> Column:
    """``{stem}_{form}_0007.jsonl``, or without the stem where that is empty."""
    stem, number = (F.col(c) if isinstance(c, str) else c for c in (stem, number))
    start = F.when(stem == "", F.lit("")).otherwise(F.concat(stem, F.lit("_")))
    digits = F.lpad(number.cast("string"), 4, "0")
    long_number = F.when(number < 10_000, digits).otherwise(number.cast("string"))
    return F.concat(start, F.lit(f"{form}_"), long_number, F.lit(suffix))


def write_named(rows: DataFrame, path: str, name: Column, value: Column, order: list[Column | str]) -> None:
    """Rows as lines of files named by ``name``, in ``order``. Nothing that is there is replaced."""
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(NamedLines)
    keyed = rows.withColumns({"_name": name, "_value": value})
    dealt = keyed.repartition("_name").sortWithinPartitions("_name", *order)
    lines = dealt.select(F.col("_name").alias("name"), F.col("_value").alias("value"))
    lines.write.format(SOURCE).option("job", uuid.uuid4().hex).mode("append").save(path)


def write_numbered(rows: DataFrame, path: str, shard: str, order: list[Column | str], stem: str = "") -> None:
    """Records as ``shard_0000.jsonl`` … by a column of shard numbers, null fields kept."""
    kept = [c for c in rows.columns if c != shard]
    value = F.to_json(F.struct(*kept), {"ignoreNullFields": "false"})
    write_named(rows, path, file_name(F.lit(stem), shard), value, order)


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """File names below ``path`` and the lines in each."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("name"))
    return lines.groupBy("name").agg(F.count(F.lit(1)).alias("n_lines"))
