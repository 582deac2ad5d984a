"""Hot keys, caps and numbering: same rows as the plain form, and no task with a whole group."""

import gc
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sqlsieve.operators import corpus, gold, joins, numbering, prompts, repos
from sqlsieve.operators.user_code import keep_if
from sqlsieve.plans import tables as given
from sqlsieve.plans.queries import REGISTRY
from sqlsieve.plans.tables import Tables
from sqlsieve.session import spread
from sqlsieve.sources import blobs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """9,000 rows, a third of them with one key, some without any."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))
    )
    return spark.range(9000, numPartitions=6).select(key.alias("k"), F.col("id").alias("v"))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", joins.JOINS)
def test_salted_join(spark, skewed, how):
    right = spark.range(0, 800, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), "id")
    right = right.unionByName(spark.createDataFrame([("hot", -1)], "k string, id long"))
    hot = joins.hot_keys(skewed, "k", 500).collect()
    assert [tuple(r) for r in hot] == [("hot", 6)]
    salted = joins.salted_join(skewed, right, "k", how, spread_by=["v"], rows_per_split=500)
    assert rows(salted) == rows(skewed.join(right, "k", how).select(salted.columns))


def test_every_hot_key_is_split(spark):
    many = spark.range(6000).select((F.col("id") % 150).alias("k"), "id")
    assert joins.hot_keys(many, "k", 10).count() == 150
    with pytest.raises(TypeError):
        joins.salted_join(many, many, "k", "inner")


def test_salted_join_spreads_the_hot_key(spark, skewed):
    right = spark.createDataFrame([("hot", 1)], "k string, id long")
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", False)
        salted = joins.salted_join(skewed, right, "k", "inner", spread_by=["v"], rows_per_split=100)
        tasks = salted.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 1500


@pytest.fixture
def all_tasks(spark):
    """Keep small partitions apart, as large ones would be."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def test_number_rows(spark, skewed, all_tasks):
    order = [F.desc("v")]
    got = numbering.number_rows(skewed, ["k"], order, "n")
    expected = skewed.withColumn("n", F.row_number().over(W.partitionBy("k").orderBy(F.desc("v"))))
    assert rows(got) == rows(expected.select(got.columns))
    alone = numbering.number_rows(skewed, [], ["v"], "n")
    assert alone.where("n <> v + 1").count() == 0


def test_numbering_spreads_a_group(spark, all_tasks):
    """One group over several tasks: what the range bounds are for."""
    big = spark.range(200_000, numPartitions=8).select(F.lit("one").alias("g"), "id")
    got = numbering.number_rows(big, ["g"], ["id"], "n")
    assert got.where("n <> id + 1").count() == 0
    ranged = big.repartitionByRange("g", "id")
    assert ranged.groupBy(F.spark_partition_id()).count().count() >= 6


def test_file_cap(spark):
    files = spark.range(3000).select(
        F.when(F.col("id") < 2000, "big").otherwise(F.concat(F.lit("r"), (F.col("id") % 50).cast("string"))).alias("repo_name"),
        F.format_string("src/%05d.sql", F.col("id")).alias("path"),
        F.lit("blob").alias("entry_type"),
    )
    listed = repos.listed_files(files, 15)
    assert listed.where("repo_name = 'big'").orderBy("path").first().path == "src/00000.sql"
    assert {r["count"] for r in listed.groupBy("repo_name").count().collect()} == {15}
    many = repos.listed_files(files, 1200)
    assert many.where("repo_name = 'big'").count() == 1200 and many.count() == 2200
    assert repos.listed_files(files).count() == 3000


def test_top_pairs_cut_by_keys(spark):
    """No sort that meets in one task, for any number of pairs; all keys of the cut are small."""
    from sqlsieve.operators import prompts

    tables = Tables(spark, "/root/testdata/sf0.001")
    outcomes = prompts.with_outcome(prompts.with_answers(tables.prompts(), tables.responses()))
    half = prompts.accepted(outcomes).count() // 2
    for n in (7, half):
        first = prompts.top_pairs(outcomes, n)
        assert "TakeOrderedAndProject" not in first._jdf.queryExecution().executedPlan().toString()
        assert first.count() == n
    everything = prompts.top_pairs(outcomes).collect()
    assert [r.source_path for r in everything[:7]] == [r.source_path for r in prompts.top_pairs(outcomes, 7).collect()]


def test_first_seen_does_not_follow_row_order(spark):
    from datetime import date

    schema = ("repo_name string, stars bigint, language string, topics array<string>, pushed_at date, "
              "license string, has_readme boolean, languages map<string,bigint>, rule int")  # fmt: skip
    rows = [("a", 60, "TSQL", [], date(2023, 6, d), lic, True, {"TSQL": n}, 1)
            for d in (1, 2) for lic in ("mit", "isc") for n in (1, 2)]
    one = [repos.first_seen(spark.createDataFrame(r, schema).coalesce(1)).first() for r in (rows, rows[::-1])]
    assert one[0] == one[1] and (one[0].pushed_at, one[0].license) == (date(2023, 6, 2), "isc")


def test_metadata_bounds_reach_the_scan(spark):
    from sqlsieve.operators.corpus import small_enough

    index = Tables(spark, "/root/testdata/sf0.001").index()
    plan = small_enough(index)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(length_bytes,50)" in plan and "LessThan(length_bytes,20000)" in plan


def test_text_rules_read_needed_columns_only(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    plan = REGISTRY["kept_files"].run(tables)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<file_id:bigint,path:string,content:string>" in plan
    assert plan.count("split(") == 1


def test_decoding_runs_once(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    plan = REGISTRY["dataset_records"].run(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_difference(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert sorted((r.x, r.side) for r in gold.difference(a, b).collect()) == [(1, "candidate"), (3, "gold")]
    assert gold.difference(a, a).count() == 0


def test_repo_order_and_cap(spark):
    """First sight decides the rule, stars the order within it, and the cap counts what is seen."""
    schema = ("repo_name string, stars bigint, language string, topics array<string>, pushed_at date, "
              "license string, has_readme boolean, languages map<string,bigint>")  # fmt: skip
    from datetime import date

    day, sql = date(2023, 6, 1), {"TSQL": 1, "C#": 4}
    data = [
        ("a", 15, "TSQL", [], date(2022, 6, 1), None, True, sql),
        ("b", 51, "TSQL", ["tsql"], day, "mit", True, sql),
        ("b", 51, "TSQL", ["tsql"], day, "mit", True, sql),
        ("c", 60, "TSQL", [], day, None, True, {"C#": 4}),
        ("d", 50, "TSQL", ["mssql"], day, None, False, {}),
        ("e", 101, "SQL", ["sql-server"], day, None, True, {"SQL": 1, "TSQL": 0, "x": 5}),
        ("f", 50, "SQL", ["mssql"], day, None, True, sql),
        ("g", 90, "TSQL", [], date(2023, 1, 1), None, None, sql),
        ("h", 99, "TSQL", [], date(2022, 1, 1), None, True, sql),
    ]
    table = spark.createDataFrame(data, schema)
    found = repos.first_hits(table)
    assert sorted((r.repo_name, r.rule) for r in found.collect()) == [
        ("a", 9), ("b", 1), ("c", 1), ("d", 4), ("e", 6), ("g", 9)]
    same = repos.first_seen(repos.search_hits(table))
    assert sorted((r.repo_name, r.rule) for r in same.collect()) == sorted(
        (r.repo_name, r.rule) for r in found.collect()
    )
    capped = repos.cap_repos(found, 4)
    assert {r.repo_name for r in capped.collect()} == {"c", "b", "d", "e"}
    gated = repos.choose_repos(table, max_repos=5)
    assert sorted(r.repo_name for r in gated.collect()) == ["b", "g"]
    assert repos.with_readme(gated).count() == 1


def exchanges(df):
    """Columns that each exchange of the plan that ran moves."""
    df.collect()
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    final = text.split("== Initial Plan ==")[0]
    numbers = re.findall(r"Exchange \((\d+)\)", final)
    parts = [re.search(rf"\({n}\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)[1] for n in numbers]
    return [re.sub(r"#\d+L?", "", p).split(", ") for p in parts], text


@pytest.mark.parametrize("rows_per_split", [10**6, 50])
def test_blobs_and_texts_stay_where_they_are(spark, rows_per_split):
    tables = Tables(spark, FOLDER)
    store, index = tables.blob_store(), tables.index()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        hot = blobs.hot_blobs(corpus.with_blob(corpus.small_enough(index)), rows_per_split)
        assert hot == (["blob-shared"] if rows_per_split == 50 else [])
        met = blobs.attach_content(index, store, rows_per_split)
        moved, text = exchanges(met)
        assert moved and "SelectedBucketsCount: 16 out of 16" in text
        wide = [m for m in moved if {"data", "content"} & set(m)]
        # Hot blobs are few: only their texts may move.
        assert len(wide) <= (1 if hot else 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    plain = blobs.attach_content(index, tables.blobs(), 10**6)
    assert sorted(map(str, met.select("path", "content").collect())) == sorted(
        map(str, plain.select("path", "content").collect())
    )


def test_a_store_is_opened_again(spark, tmp_path):
    rows = spark.createDataFrame([(f"b{i}", bytearray(b"x")) for i in range(50)], "blob_id string, data binary")
    blobs.save_store(rows, "store_one", str(tmp_path / "s"), 4)
    again = blobs.open_store(spark, "store_two", str(tmp_path / "s"), 4)
    keys = spark.range(50).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("blob_id"))
    joined = again.join(keys.hint("shuffle_hash"), "blob_id").select("blob_id", "data")
    assert joined.count() == 50 and all("data" not in m for m in exchanges(joined)[0])
    for table in ("store_one", "store_two"):
        spark.sql(f"drop table {table}")


def test_spread_bounds_the_rows_of_a_task(spark):
    """All rows in one of many pieces, as a file of one row group comes: no task keeps them."""
    clumped = spark.range(0, 64_000, 1, 16).where("id < 4000")
    assert clumped.rdd.getNumPartitions() == 16
    sizes = spread(clumped, 100).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 40 and max(r["count"] for r in sizes) <= 110
    assert rows(spread(clumped)) == rows(clumped)
    assert spread(clumped).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_contents_are_cut_into_chunks_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(given, "_stored", {})
    cut = given.prompt_table
    monkeypatch.setattr(given, "prompt_table", lambda *a, **k: calls.append(1) or cut(*a, **k))
    t = Tables(spark, FOLDER)
    asked, answered = t.prompts(), t.responses()
    assert len(calls) == 1 and "file_id" not in asked.columns
    ids = {r[0] for r in asked.select("prompt_id").collect()}
    found = [r[0] for r in answered.select("prompt_id").collect()]
    assert found and set(found) <= ids and len(set(found)) == len(found)


def test_batches_do_not_stay_in_a_worker(spark):
    """Objects that the caller's code ties into a circle are gone when the next batch comes."""

    def grown(texts):
        seen = sum(isinstance(o, pd.Series) and len(o) == 100 for o in gc.get_objects())
        return (texts.str.len() > 0) & (seen <= 12)

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        texts = spark.range(0, 10_000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("t"))
        assert texts.where(keep_if(grown, "t")).count() == 10_000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


@pytest.mark.parametrize("name", ["top_pairs", "resumed_pairs", "recovered_pairs"])
def test_answers_meet_their_prompts_once(spark, monkeypatch, name):
    """Cuts and sorts pass over written outcomes and not over the join again."""
    seen = []
    cut = prompts.top_pairs
    monkeypatch.setattr(given, "_stored", {})
    monkeypatch.setattr(prompts, "top_pairs", lambda df, *a: seen.append(df) or cut(df, *a))
    REGISTRY[name].run(Tables(spark, FOLDER))
    assert seen and not any("Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in seen)


def test_distinct_prompts_come_in_bounded_tasks(spark):
    """Rows of one packed piece are sorted by many tasks, before and after; so are the copies of one chunk."""
    n = F.col("id")
    copies = spark.range(9000, numPartitions=1).select(
        F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (n % 2000).cast("string"))).alias("prompt_id"),
        (n % 2).cast("int").alias("is_modern"), (n % 5).cast("int").alias("is_repo"),
        (n % 7).cast("int").alias("feature_score"), (n % 11).alias("n_stars"),
        F.concat(F.lit("r"), (n % 13).cast("string")).alias("repo_name"), n.cast("string").alias("path"),
        F.xxhash64("id").alias("content_hash"), F.lit(1).alias("chunk_no"),
    ).withColumn("prompt", F.concat(F.lit("ask "), "prompt_id"))
    got = prompts.distinct_prompts(copies, rows_per_task=500)
    place = [-F.col(c) for c in ("is_modern", "is_repo", "feature_score", "n_stars")]
    order = W.partitionBy("prompt_id").orderBy(*place, "repo_name", "path", "content_hash", "chunk_no")
    plain = copies.withColumn("no", F.row_number().over(order)).where("no = 1").select(got.columns)
    assert rows(got) == rows(plain)
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) <= 500
    # The rows are sorted once they have been dealt, and not in the one piece they come in.
    text = got._jdf.queryExecution().sparkPlan().toString()
    deals = [line for line in text.splitlines() if "Exchange" in line or "Aggregate" in line]
    assert "REPARTITION_BY_NUM" in deals[-1]


def test_buckets_grow_in_number(spark, monkeypatch):
    """The contents of a bucket are unpacked and judged by one task."""
    monkeypatch.setattr(given, "tasks_for", lambda rows: -(-rows.count() // 50))
    monkeypatch.setattr(given, "_stored", dict(given._stored))
    given._stored.pop((spark.sparkContext.applicationId, FOLDER, "blob_store"), None)
    tables = Tables(spark, FOLDER)
    store, n = tables.blob_store(), -(-tables.blobs().count() // 50)
    name = given._stored[(spark.sparkContext.applicationId, FOLDER, "blob_store")]
    described = {r.col_name: r.data_type for r in spark.sql(f"describe formatted {name}").collect()}
    assert n > 16 and int(described["Num Buckets"]) == n
    assert rows(store.select("blob_id")) == rows(tables.blobs().select("blob_id"))
    spark.sql(f"drop table {name}")
