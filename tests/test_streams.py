"""Streams give what the batch gives, once, also across a restart."""

import gzip

from pyspark.sql import functions as F

from sqlsieve.functions.chunking import extract_chunks
from sqlsieve.plans.tables import Tables
from sqlsieve.sources import blobs, sinks
from sqlsieve.streaming import collect

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def halves(df, path):
    first, second = df.where("size % 2 = 0"), df.where("size % 2 = 1")
    assert first.count() and second.count()
    first.write.mode("append").parquet(path)
    yield
    second.write.mode("append").parquet(path)
    yield


def test_dataset_stream(spark, tmp_path):
    tables = Tables(spark, FOLDER)
    index, store = tables.index().select(*[c.split()[0] for c in blobs.INDEX_SCHEMA.split(", ")]), tables.blobs()
    source, out, done = (str(tmp_path / n) for n in ("in", "out", "done"))
    for _ in halves(index, source):
        stream = blobs.stream_index(spark, source, files_per_batch=3)
        collect.write_stream(collect.stream_dataset(stream, store), out, done).awaitTermination()
    batch = blobs.collect_dataset(index, store)
    got = spark.read.schema(batch.schema).json(out)
    assert rows(got) == rows(batch) and got.count() > 100
    again = blobs.stream_index(spark, source, files_per_batch=3)
    collect.write_stream(collect.stream_dataset(again, store), out, done).awaitTermination()
    assert spark.read.schema(batch.schema).json(out).count() == batch.count()


def test_names_are_seen_once(spark, tmp_path):
    files = Tables(spark, FOLDER).index().select("repo_name", "size")
    source, out, done = (str(tmp_path / n) for n in ("in", "out", "done"))
    for _ in halves(files, source):
        stream = spark.readStream.schema(files.schema).parquet(source)
        collect.write_stream(collect.first_seen_names(stream), out, done).awaitTermination()
    names = spark.read.schema("repo_name string").json(out)
    assert rows(names) == rows(files.select("repo_name").distinct())


def test_pair_stream(spark, tmp_path):
    schema = "instruction string, code string, size int"
    data = spark.createDataFrame([(f"Ask {i}", f"SELECT {i}", i) for i in range(40)], schema)
    source, out, done = (str(tmp_path / n) for n in ("in", "out", "done"))
    for _ in halves(data, source):
        stream = spark.readStream.schema(data.schema).parquet(source)
        collect.write_pair_stream(stream.drop("size"), out, done).awaitTermination()
    written = spark.read.schema("instruction string, code string").json(f"{out}/raw").drop("commit")
    assert rows(written) == rows(data.drop("size"))
    expected = sinks.as_alpaca(data)
    assert rows(spark.read.schema(expected.schema).json(f"{out}/alpaca").drop("commit")) == rows(expected)
    assert spark.read.json(f"{out}/chatml").count() == 40


def test_chunks_stream_as_they_batch(spark, tmp_path):
    files = Tables(spark, FOLDER).sql_files().select("content")
    files.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(files.schema).parquet(str(tmp_path / "in"))
    chunks = stream.select(extract_chunks("content").alias("chunks"))
    collect.write_stream(chunks, str(tmp_path / "out"), str(tmp_path / "done")).awaitTermination()
    batch = files.select(extract_chunks("content").alias("chunks"))
    assert rows(spark.read.schema(batch.schema).json(str(tmp_path / "out"))) == rows(batch)


def test_packed_blobs_are_gzip(spark):
    row = Tables(spark, FOLDER).blobs().where("blob_id = 'blob-shared'").first()
    assert gzip.decompress(bytes(row.data)).startswith(b"CREATE OR ALTER PROCEDURE")


def test_file_stream_is_dealt_before_it_is_judged(spark, tmp_path):
    """One file of one piece: its rows are judged by as many tasks as asked for."""
    files = Tables(spark, FOLDER).sql_files().withColumn("detected_licenses", F.array().cast("array<string>"))
    files = files.withColumn("size", F.col("file_id")).drop("source", "stars")
    source, out, done = (str(tmp_path / n) for n in ("in", "out", "done"))
    files.coalesce(1).write.parquet(source)
    records = collect.stream_files(spark.readStream.schema(files.schema).parquet(source), 6)
    collect.write_stream(records, out, done).awaitTermination()
    found = spark.read.schema("path string, size long").json(out)
    expected = collect.stream_files(files).select("path", "size")
    assert rows(found) == rows(expected)
    assert found.select(F.input_file_name()).distinct().count() == 6
    plan = collect.stream_files(files, 6)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Repartition") < plan.index("Relation")
