"""JSON line files, shards, blobs and written pairs."""

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sqlsieve.operators import corpus
from sqlsieve.sources import blobs, commits, jsonl, sinks

LINES = [
    '{"a":1}', ' {"a":1} ', '{"a":1} x', '{"a":1}]', '{"a":1}}', "", "   ", "{a:1}", "{'a':1}", '{"a":1,}',
    "[1,2]", "1,2", '1, "b":2', '"x"', "3", "01", "NaN", '{"a":NaN}', "-Infinity", '{"a":1,"a":2}', "nul",
    "true", '{"a":"\\ud800"}', '{"a":"b\\u0000"}', '{"a":1} ', "﻿{}", "[" * 50 + "]" * 50,
    '{"a":1e999}', "1" * 60, '{"a":{"b":[{}]}}', "[1}", "1],[2", "1}", ',"b":2', "1,",
]


def is_json(line):
    try:
        json.loads(line)
        return True
    except json.JSONDecodeError:
        return False


def test_json_validity(values):
    rnd = random.Random(5)
    bits = ['{"a":', '"b"', "1", "}", "]", "[", ",", ":", "NaN", " ", "{", '"', "null", "x"]
    lines = LINES + ["".join(rnd.choices(bits, k=rnd.randrange(1, 9))) for _ in range(4000)]
    got = values(lines, jsonl.is_json("content"))
    assert got == [is_json(x) for x in lines]
    assert 100 < sum(got) < 2000


def test_strict_json_is_never_too_generous(values):
    got = values(LINES, jsonl.is_strict_json("content"))
    assert all(is_json(x) for x, ok in zip(LINES, got) if ok)


def test_read_corpus(spark, tmp_path):
    (tmp_path / "a/deep").mkdir(parents=True)
    (tmp_path / "b").mkdir()
    record = {"content": "SELECT 'é'", "path": "x.sql", "repo_name": "r", "tsql_features": ["cte"]}
    first = [json.dumps(record | {"license": ["mit", "isc"], "size": 3}, ensure_ascii=False), "", "{bad", "7"]
    second = json.dumps(record | {"license": "unknown", "stars": 5, "modern_tsql": True, "extra": 1})
    (tmp_path / "a/deep/one.jsonl").write_text("\n".join(first), encoding="utf-8")
    (tmp_path / "b/two.jsonl").write_text(second + "\r\n")
    (tmp_path / "b/two.txt").write_text(second)
    (tmp_path / "b/two.json").write_text(second)
    odd = [{"license": "[MIT]", "stars": 12.0, "size": "12", "path": "o1"}, {"stars": "1e3", "size": "x", "path": "o2"}]
    (tmp_path / "c").mkdir()
    (tmp_path / "c/odd.jsonl").write_text("\n".join(map(json.dumps, odd)))
    found = {r.path: r for r in jsonl.read_corpus(spark, [str(tmp_path / "c")]).collect()}
    assert (found["o1"].license, found["o1"].stars, found["o1"].size) == (["[MIT]"], 12, 12)
    assert (found["o2"].license, found["o2"].stars, found["o2"].size) == (None, 1000, None)
    got = jsonl.read_corpus(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).orderBy("size").collect()
    assert len(got) == 2
    assert got[0].license == ["unknown"] and got[0].stars == 5 and got[0].modern_tsql is True and got[0].size is None
    assert got[1].license == ["mit", "isc"] and got[1].content == "SELECT 'é'" and got[1].modern_tsql is None


def test_resplit(spark, tmp_path):
    """Parts of exactly n valid lines, in file order, across the blocks that a big file is read in."""
    (tmp_path / "in/sub").mkdir(parents=True)
    files = {"big": 2500, "sub/small": 120}
    expected = {}
    for name, n in files.items():
        lines = [json.dumps({"n": i, "pad": "p" * (i % 90)}) for i in range(n)]
        noisy = [x for i, line in enumerate(lines)
                 for x in ([f"  {line}\t"] + (["{bad"] if i % 10 == 0 else []) + ([""] if i % 15 == 0 else []))]
        (tmp_path / f"in/{name}.jsonl").write_text("\n".join(noisy) + "\n")
        expected[name] = lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        jsonl.resplit(spark, str(tmp_path / "in"), str(tmp_path / "out"), rows_per_part=1000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    for name, lines in expected.items():
        folder = tmp_path / "out" / f"source={name.replace('/', '%2F')}"
        parts = sorted(os.listdir(folder))
        assert parts == [f"part={i}" for i in range(-(-len(lines) // 1000))]
        got = []
        for part in parts:
            written = [f for f in os.listdir(folder / part) if f.endswith(".txt")]
            assert len(written) == 1
            got += (folder / part / written[0]).read_text().splitlines()
        assert got == lines


def test_files_that_share_a_stem(spark, tmp_path):
    for suffix, n in (("json", 30), ("jsonl", 50)):
        (tmp_path / f"a.{suffix}").write_text("\n".join(json.dumps([suffix, i]) for i in range(n)))
    rows = jsonl.numbered_lines(spark, str(tmp_path), 20, "*.{json,jsonl}").collect()
    for suffix, n in (("json", 30), ("jsonl", 50)):
        own = sorted((r for r in rows if r.source == f"a.{suffix}"), key=lambda r: r.line)
        assert [(r.line, r.part, json.loads(r.value)) for r in own] == [(i + 1, i // 20, [suffix, i]) for i in range(n)]


def test_shards(spark, tmp_path):
    rows = spark.range(25, numPartitions=1).select(F.lit("é").alias("a"), F.lit(None).cast("int").alias("b"))
    sinks.write_shards(rows, str(tmp_path / "s"), rows_per_shard=10)
    files = sorted((tmp_path / "s").glob("*.json"))
    assert sorted(len(f.read_text(encoding="utf-8").splitlines()) for f in files) == [5, 10, 10]
    assert files[0].read_text(encoding="utf-8").splitlines()[0] == '{"a":"é","b":null}'


@pytest.mark.parametrize("formats, folders", [("both", 3), ("alpaca", 2), ("chatml", 2)])
def test_write_pairs(spark, tmp_path, formats, folders):
    pairs = spark.createDataFrame([("Ask", "SELECT 1")], "instruction string, code string")
    for _ in range(2):
        sinks.write_pairs(pairs, str(tmp_path / "p"), formats)
    names = sorted(n for n in os.listdir(tmp_path / "p") if n[0] not in "._")
    assert len(names) == folders and "raw" in names
    assert sinks.row_count(spark.read.json(str(tmp_path / "p/raw"))).first()[0] == 2
    if "chatml" in names:
        texts = sinks.as_train_text(jsonl.read_chat(spark, str(tmp_path / "p/chatml")))
        assert texts.first().text.startswith("<|im_start|>user\nAsk<|im_end|>\n")


def pairs_of(spark, *rows):
    return spark.createDataFrame(
        [(i, "r", "p", n, f"Ask {i}", f"SELECT {n}") for i, n in rows],
        "prompt_id string, source_repo string, source_path string, chunk_no int, instruction string, code string",
    )


def forms(spark, path):
    schemas = {"raw": "instruction string", "alpaca": "instruction string", "chatml": "messages array<struct<content: string>>"}
    read = {n: commits.read(spark, path, n, s) for n, s in schemas.items()}
    texts = {n: r.select("instruction" if n != "chatml" else r.messages[0].content) for n, r in read.items()}
    return {n: sorted(t[0] for t in r.collect()) for n, r in texts.items()}


@pytest.mark.parametrize("fail_at", ["raw", "alpaca", "chatml", "manifest", "move"])
def test_a_failed_write_is_made_good(spark, tmp_path, monkeypatch, fail_at):
    path = str(tmp_path / "out")
    sinks.write_pairs(pairs_of(spark, ("a", 0)), path)
    later = pairs_of(spark, ("a", 0), ("a", 1), ("b", 0))
    with monkeypatch.context() as m:
        def failing(rows, folder, write=sinks.write_shards):
            write(rows, folder)
            if folder.endswith(fail_at):
                raise OSError(folder)

        m.setattr(sinks, "write_shards", failing)
        if fail_at == "manifest":
            m.setattr(commits.Folder, "write_new", lambda *a: 1 / 0)
        if fail_at == "move":
            m.setattr(commits.Folder, "move", lambda *a: 1 / 0)
        with pytest.raises((OSError, ZeroDivisionError)):
            sinks.write_pairs(later, path)
    if fail_at == "move":  # all was written: readers see it before it has been moved
        assert forms(spark, path)["alpaca"] == ["Ask a", "Ask a", "Ask b"]
    else:
        assert forms(spark, path) == dict.fromkeys(("raw", "alpaca", "chatml"), ["Ask a"])
    assert spark.read.json(f"{path}/raw").count() == spark.read.json(f"{path}/chatml").count() == 1
    sinks.write_pairs(later, path)
    assert forms(spark, path) == dict.fromkeys(("raw", "alpaca", "chatml"), ["Ask a", "Ask a", "Ask b"])
    assert spark.read.json(f"{path}/raw").count() == spark.read.json(f"{path}/chatml").count() == 3
    assert not os.listdir(f"{path}/_staging")


def test_a_named_commit_happens_once(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([("Ask", "SELECT 1")], "instruction string, code string")
    assert sinks.write_pairs(rows, path, name="batch-1") and not sinks.write_pairs(rows, path, name="batch-1")
    assert sinks.write_pairs(rows, path) and list(commits.committed(spark, path)) == ["00000000", "batch-1"]
    assert forms(spark, path)["raw"] == ["Ask", "Ask"]


def test_formats_are_checked(spark):
    with pytest.raises(ValueError):
        sinks.pair_tables(spark.range(1), "xml")


def test_attach_content(spark):
    text = "naïve – “x”"
    packed = {
        "u8": gzip.compress(text.encode()), "u16": gzip.compress(text.encode("utf-16")),
        "w": gzip.compress(text.encode("cp1252")), "bad": gzip.compress(b"\xff\xfe\xfd"),
        "plain": b"not packed", "latin": gzip.compress("é".encode("latin-1")),
    }
    index = [("u8", "UTF-8"), ("u16", "utf-16"), ("w", "windows-1252"), ("bad", "utf-8"), ("plain", "utf-8"),
             ("latin", "iso-8859-1"), ("gone", "utf-8"), (None, "utf-8"), ("", "utf-8"), ("u8", None), ("u8", "no-such"),
             ("u8", "utf-8")]
    rows = [(b, e, 100, None, False, f"p{i}", "r", ["mit"], 9) for i, (b, e) in enumerate(index)]
    table = spark.createDataFrame(rows, blobs.INDEX_SCHEMA)
    store = spark.createDataFrame([(k, bytearray(v)) for k, v in packed.items()], "blob_id string, data binary")
    for split in (1_000_000, 1):
        got = blobs.attach_content(table, store, rows_per_split=split)
        assert sorted((r.path, r.content) for r in got.collect()) == [
            ("p0", text), ("p1", text), ("p11", text), ("p2", text), ("p5", "é")]
    assert "data" not in got.columns


def test_prefilter_bounds(spark):
    rows = [(n, v, g) for n in (50, 51, 19999, 20000) for v in (None, False, True) for g in (None, False, True)]
    table = spark.createDataFrame(rows, "length_bytes long, is_vendor boolean, is_generated boolean")
    got = corpus.small_enough(table).collect()
    assert len(got) == 8 and {r.length_bytes for r in got} == {51, 19999}


def test_max_samples(spark):
    text = "SET NOCOUNT ON;\nSELECT a\nFROM b\nWHERE c = 1\nORDER BY a;"
    rows = [(f"b{i}", "utf-8", 100, False, False, "p.sql", "r", ["mit"], 9) for i in range(20)]
    store = [(f"b{i}", bytearray(gzip.compress(text.encode()))) for i in range(20)]
    got = blobs.collect_dataset(
        spark.createDataFrame(rows, blobs.INDEX_SCHEMA),
        spark.createDataFrame(store, "blob_id string, data binary"),
        max_samples=7,
    )
    assert got.count() == 7


def test_corpus_union(spark):
    text = "CREATE VIEW v AS\nSELECT a OVER (b)\nFROM c"
    dataset = corpus.dataset_records(
        spark.createDataFrame([(text, None, "r", ["mit"], None)],
                              "content string, path string, repo_name string, detected_licenses array<string>, size long")
    )
    found = corpus.repo_records(
        spark.createDataFrame([(text, "p", "r", 4, None)],
                              "content string, path string, repo_name string, stars int, license string")
    )
    plain, repo = corpus.corpus(dataset, found).orderBy("source").collect()[::-1]
    assert (plain.path, plain.size, plain.stars, plain.modern_tsql, plain.license) == ("", 0, None, None, ["mit"])
    assert (repo.size, repo.stars, repo.modern_tsql, repo.license) == (None, 4, True, ["unknown"])
    assert plain.tsql_features == repo.tsql_features == ["view", "window_functions"]
    filled = corpus.corpus(dataset, found, backfill_modern=True)
    assert filled.where("modern_tsql").count() == 2
