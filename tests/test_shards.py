"""Shards cut between groups, and line files with names of their own."""

import json
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sqlsieve.operators import numbering, packing
from sqlsieve.sources import shards


def walked(sizes, least):
    """One group after the other, straight from the rule."""
    out, shard, filled = {}, 0, 0
    for name, n in sizes:
        if filled >= least:
            shard, filled = shard + 1, 0
        out[name] = shard
        filled += n
    return out


@pytest.mark.parametrize("least", [1, 7, 40, 10_000])
def test_groups_are_packed_in_order(spark, least):
    rng = random.Random(least)
    sizes = [(f"g{i:03d}", rng.choice([1, 1, 2, 3, 5, 30, 90])) for i in range(120)]
    table = spark.createDataFrame(sizes, "name string, n_rows long").repartition(5)
    got = {r["name"]: r["shard"] for r in packing.group_shards(table, "name", least).collect()}
    assert got == walked(sizes, least)


def test_rows_follow_their_group(spark):
    rows = [(None, 1, "x")] * 3 + [("b", 9, "x")] * 4 + [("a", 5, "x")] * 2 + [("c", 0, "y")]
    table = spark.createDataFrame(rows, "name string, age int, shards string")
    by_name = packing.pack_groups(table, "name", 4).groupBy("name").agg(F.collect_set("shard").alias("s"))
    assert {r["name"]: r["s"] for r in by_name.collect()} == {None: [0], "a": [0], "b": [1], "c": [2]}
    by_age = packing.pack_groups(table, "name", 4, ["age"]).select("name", "shard").distinct()
    assert {tuple(r) for r in by_age.collect()} == {("c", 0), (None, 0), ("a", 1), ("b", 1)}
    assert packing.pack_groups(table.limit(0), "name", 4).count() == 0


def test_running_sums(spark):
    rows = [(i, (i * 37) % 11) for i in range(300)]
    table = spark.createDataFrame(rows, "i long, n long").repartition(7)
    got = {r["i"]: r["s"] for r in numbering.running_sum(table, ["i"], "n", "s").collect()}
    assert got == {i: sum(n for _, n in rows[: i + 1]) for i, _ in rows}


def test_first_point_at_or_after(spark):
    points, queries = [3, 3, 10, 40, 41], [0, 3, 4, 10, 11, 39, 41, 42]
    p = spark.createDataFrame([(v, i) for i, v in enumerate(points)], "at long, found long")
    q = spark.createDataFrame([(v,) for v in queries], "at long")
    got = {r["at"]: r["found"] for r in numbering.first_at_or_after(p, q, "at", "found").collect()}
    assert {v: points[f] if f is not None else None for v, f in got.items()} == {
        v: min((x for x in points if x >= v), default=None) for v in queries
    }


def test_named_files(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(2500).select("id", (F.col("id") / 1000).cast("int").alias("shard"), F.lit(None).cast("int").alias("none"))
    shards.write_numbered(rows.repartition(6), path, "shard", ["id"])
    assert sorted(n for n in os.listdir(path) if n[0] != ".") == [f"shard_000{i}.jsonl" for i in range(3)]
    lines = [json.loads(x) for x in (tmp_path / "out/shard_0002.jsonl").read_text().splitlines()]
    assert lines == [{"id": i, "none": None} for i in range(2000, 2500)]
    counts = {r["name"]: r["n_lines"] for r in shards.line_counts(spark, path).collect()}
    assert counts == {"shard_0000.jsonl": 1000, "shard_0001.jsonl": 1000, "shard_0002.jsonl": 500}
    with pytest.raises(PySparkException):  # nothing is replaced
        shards.write_numbered(rows.where("shard = 2"), path, "shard", ["id"])
    assert {r["name"]: r["n_lines"] for r in shards.line_counts(spark, path).collect()} == counts
    named = rows.select(shards.file_name(F.lit("a"), F.lit(7), "part").alias("x"), shards.file_name(F.lit(""), F.lit(12345)).alias("y"))
    assert tuple(named.first()) == ("a_part_0007.jsonl", "shard_12345.jsonl")


def test_a_write_that_fails_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    fails = F.when(F.col("id") == 700, F.raise_error(F.lit("stop"))).otherwise(F.lit("é"))
    rows = spark.range(1000).select("id", (F.col("id") / 100).cast("int").alias("shard"), fails.alias("v"))
    with pytest.raises(PySparkException):
        shards.write_numbered(rows.repartition(4), path, "shard", ["id"])
    assert not os.path.exists(path) or not [n for n in os.listdir(path) if n[0] != "."]
