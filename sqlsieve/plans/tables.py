"""Given and derived tables by name, for a session and a data folder."""

from __future__ import annotations

import gzip
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions.dialect import feature_tags, is_modern
from ..operators.corpus import kept
from ..operators.prompts import prompt_table
from ..operators.repos import is_sql_path
from ..session import new_table_path, spread, tasks_for
from ..sources.blobs import save_store
from . import fixtures

#: Written files of so many texts are read again by a task each.
ROWS_PER_FILE = 700_000
LEAST_BUCKETS = 16

_stored: dict[tuple[str, str, str], str] = {}


class Tables:
    """``t("orders")`` is the given table; the derived ones have methods."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, query: str, **inputs: DataFrame) -> DataFrame:
        for name, df in inputs.items():
            df.createOrReplaceTempView(name)
        return self.spark.sql(query)

    def sql_files(self, rich: bool = False) -> DataFrame:
        query = fixtures.SQL_FILES_RICH if rich else fixtures.SQL_FILES
        orders = self("orders").select("o_orderkey", "o_custkey")
        return self.stored(
            "rich_files" if rich else "sql_files",
            lambda: self.sql(query, orders=spread(orders, ROWS_PER_FILE)),
        )

    def _flat_repos(self) -> DataFrame:
        return self.sql(fixtures.REPOS, customer=self("customer"))

    def repos(self) -> DataFrame:
        return self._flat_repos().select(
            "repo_name", "stars", "language", "license", "has_readme",
            F.filter(F.split("topics_csv", ","), lambda t: t != "").alias("topics"),
            F.date_add(F.lit("2021-06-01").cast("date"), F.col("pushed_days")).alias("pushed_at"),
            F.create_map(
                F.lit("TSQL"), "tsql_bytes", F.lit("SQL"), "sql_bytes", F.lit("C#"), "other_bytes"
            ).alias("languages"),
        )

    def repo_files(self) -> DataFrame:
        return self.sql(
            fixtures.REPO_FILES, sql_files=self.sql_files(), repos=self._flat_repos()
        )

    def index(self) -> DataFrame:
        return self.stored("index", self._index)

    def blobs(self) -> DataFrame:
        return self.stored("blobs", self._blobs)

    def blob_store(self, buckets: int | None = None) -> DataFrame:
        """The blobs bucketed by their id.

        A task unpacks and judges the contents of a bucket, so buckets grow in number and not in size.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, "blob_store")
        if key in _stored and self.spark.catalog.tableExists(_stored[key]):
            try:
                return self.spark.table(_stored[key])
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        path = new_table_path(self.spark, "blob_store")
        _stored[key] = "blob_store_" + path[-32:]
        rows = self.blobs()
        return save_store(rows, _stored[key], path, buckets or max(LEAST_BUCKETS, tasks_for(rows)))

    def _index(self) -> DataFrame:
        rows = self.sql(fixtures.INDEX_ROWS, sql_files=self.sql_files())
        return rows.withColumn("detected_licenses", F.array("license_name")).drop("license_name")

    def _blobs(self) -> DataFrame:
        """Packed contents: one per index row that has its own, and one that many rows share."""
        files = self.sql_files()
        own = files.select(
            F.concat(F.lit("blob"), F.col("file_id").cast("string")).alias("blob_id"),
            F.when(
                (F.col("file_id") % 40 == 11) & (F.col("file_id") % 7 != 1),
                F.concat(F.unhex(F.lit("FFFEFD")), F.encode("content", "utf-8"))
            )
            .when(F.col("file_id") % 7 == 1, F.encode("content", "utf-16"))
            .otherwise(F.encode("content", "utf-8"))
            .alias("data"),
        )
        shared = files.where("file_id = 0").select(
            F.lit("blob-shared").alias("blob_id"), F.encode("content", "utf-8").alias("data")
        )
        return own.unionByName(shared).withColumn("data", packed("data"))

    def corpus_records(self) -> DataFrame:
        """The corpus table as the collectors leave it."""
        return self.stored("corpus", self._corpus_records)

    def _corpus_records(self) -> DataFrame:
        """Kept SQL files with the fields of a corpus record; the flag is missing for the dataset."""
        files = kept(self.sql_files().where(is_sql_path("path")))
        modern = F.when(F.col("source") == "github-scraped", is_modern("content"))
        return files.withColumn("modern_tsql", modern).withColumn(
            "tsql_features", feature_tags("content")
        )

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """``build()`` as a table in the shared folder, written once per application and folder."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key in _stored:
            try:
                return self.spark.read.parquet(_stored[key])
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        path = new_table_path(self.spark, name)
        build().write.parquet(path)
        _stored[key] = path
        return self.spark.read.parquet(path)

    def stored_path(self, name: str) -> str:
        return _stored[(self.spark.sparkContext.applicationId, self.folder, name)]

    def prompts(self) -> DataFrame:
        """The prompt table as it leaves for the model."""
        return self._numbered_prompts().drop("file_id")

    def _numbered_prompts(self) -> DataFrame:
        """The prompt table with the numbers of the files; contents are cut into chunks for it alone."""
        return self.stored("prompts", lambda: prompt_table(self.corpus_records(), keep=["file_id"]))

    def responses(self) -> DataFrame:
        """The answer table as it comes back."""
        return self.stored("responses", self._responses)

    def _responses(self) -> DataFrame:
        ids = self._numbered_prompts()
        keys = ids.groupBy("prompt_id").agg(F.min("file_id").alias("file_id"))
        return self.sql(fixtures.RESPONSES, prompt_keys=keys)


def packed(data: Column | str) -> Column:
    @F.pandas_udf(BinaryType())
    def pack(data: pd.Series) -> pd.Series:
        return data.map(gzip.compress)

    return pack(data)


def listed(array: Column | str) -> Column:
    """Array as text, so that results compare as plain values."""
    return F.array_join(array, ",")
