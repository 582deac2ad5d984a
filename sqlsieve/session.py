"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites of single Column operations: costly for expressions of this size.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "sqlsieve") -> SparkSession:
    """A session for tests and for the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the session names it.

    Only a local session without the setting gets one of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="sqlsieve-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a table that ``new_table_path`` named, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows as a table in the shared folder, computed once, and its path for ``delete_path``."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


ROWS_PER_TASK = 50_000


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Narrow rows dealt evenly over all cores, in as many rounds as keep a task at ``rows_per_task``.

    For inputs whose rows grow or cost much later on. The pieces that files come in say little: a
    part of a file may hold no row group, or one of a million rows.
    """
    return df.repartition(tasks_for(df, rows_per_task))


def tasks_for(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Whole rounds of all cores that leave at most ``rows_per_task`` rows to a task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return cores * max(1, -(-df.count() // (cores * rows_per_task)))


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as written to the shared folder, so that they are never computed anew."""
    shared_folder(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
