"""Several outputs that appear together or not at all.

A commit writes each of its tables to a staging folder, then one small manifest that names them, and
only then moves the folders to where they belong, ``path/<table>/commit=<name>``. The manifest decides:
what a crash left behind without one is removed by the next writer, what it left behind with one is
moved by it. A name is committed once, so a repeated micro-batch writes nothing. Readers that go by
``read`` see whole commits at any time; plain readers of ``path/<table>`` never see part of a table.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

STAGING, MANIFESTS = "_staging", "_commits"
Write = Callable[[DataFrame, str], None]


class Folder:
    """The folder of one set of outputs, in whatever store it lies."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def names(self, *parts: str) -> list[str]:
        """What lies in a folder below this one, nothing if it is not there."""
        where = self.at(*parts)
        if not self._fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where))

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self.at(*parts))

    def delete(self, *parts: str) -> None:
        self._fs.delete(self.at(*parts), True)

    def move(self, source: tuple[str, ...], target: tuple[str, ...]) -> None:
        self._fs.mkdirs(self.at(*target[:-1]))
        if not self._fs.rename(self.at(*source), self.at(*target)):
            raise RuntimeError(f"cannot move {self.at(*source)} to {self.at(*target)}")

    def write_new(self, text: str, *parts: str) -> bool:
        """Writes a small file that appears whole; false if it is there already."""
        draft = (*parts[:-1], f".{parts[-1]}.draft")
        out = self._fs.create(self.at(*draft), True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        if self.exists(*parts):
            self.delete(*draft)
            return False
        return self._fs.rename(self.at(*draft), self.at(*parts))

    def text(self, *parts: str) -> str:
        stream = self._fs.open(self.at(*parts))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()


def committed(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Names of the commits below ``path`` with the tables of each, in order of their names."""
    folder = Folder(spark, path)
    return {n: json.loads(folder.text(MANIFESTS, n))["tables"] for n in folder.names(MANIFESTS) if n[0] != "."}


def recover(spark: SparkSession, path: str) -> list[str]:
    """Finishes the commits that have a manifest and removes what has none; the names of the latter.

    For the one writer of ``path``, before it writes.
    """
    folder, known, gone = Folder(spark, path), committed(spark, path), []
    for name in folder.names(STAGING):
        for table in known.get(name, []):
            if folder.exists(STAGING, name, table):
                folder.move((STAGING, name, table), (table, f"commit={name}"))
        if name not in known:
            gone.append(name)
        folder.delete(STAGING, name)
    return gone


def commit(path: str, tables: dict[str, DataFrame], write: Write, name: str | None = None) -> bool:
    """Writes all ``tables`` as one commit. False if ``name`` was committed before.

    Without a name the commit gets the next number.
    """
    spark = next(iter(tables.values())).sparkSession
    recover(spark, path)
    folder, known = Folder(spark, path), committed(spark, path)
    if name is None:
        name = f"{1 + max((int(n) for n in known if n.isdigit()), default=-1):08d}"
    if name in known:
        return False
    for table, rows in tables.items():
        write(rows, f"{folder.path}/{STAGING}/{name}/{table}")
    if not folder.write_new(json.dumps({"tables": sorted(tables)}), MANIFESTS, name):
        raise RuntimeError(f"{path}: {name} was committed by another writer")
    recover(spark, path)
    return True


def folders(spark: SparkSession, path: str, table: str) -> list[str]:
    """Where the committed rows of a table lie, moved already or not."""
    folder, out = Folder(spark, path), []
    for name, tables in committed(spark, path).items():
        if table in tables:
            final = (table, f"commit={name}")
            parts = final if folder.exists(*final) else (STAGING, name, table)
            out.append("/".join((folder.path, *parts)))
    return out


def read(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """The committed JSON lines of a table."""
    found = folders(spark, path, table)
    return spark.read.schema(schema).json(found) if found else spark.createDataFrame([], schema)
