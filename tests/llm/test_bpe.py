import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sqlsieve.llm import bpe
from sqlsieve.llm.common import vocabulary_path

PATH = vocabulary_path(bpe.VOCABULARY)
PARTS = ["'s", "'ll", "'", " ", "  ", "\n", "a", "é", "<|endoftext|>", "the", "1", "23", "...", "日本", "😀", "ing"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return bpe.load(PATH)


def text(kind: int, rng: random.Random) -> str:
    if kind == 0:
        return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 200)))
    if kind == 1:
        return "".join(rng.choice("abcdeit") for _ in range(rng.randint(0, 500)))
    return "".join(rng.choice(" \n\t'") for _ in range(rng.randint(0, 150)))


@pytest.mark.parametrize("window", [1, 4, 32])
def test_joined_leaves_are_the_encoding_of_the_whole(library, coder, window):
    rng = random.Random(window)
    for i in range(300):
        whole, size = text(i % 3, rng), rng.choice([3, 7, 20, 50])
        nodes = [
            coder.encode(whole[k : k + size], allowed_special="all")
            for k in range(0, len(whole), size)
        ]
        while len(nodes) > 1:
            pairs = [nodes[k : k + 2] for k in range(0, len(nodes), 2)]
            nodes = [bpe.join_nodes(coder, *p, window) if len(p) == 2 else p[0] for p in pairs]
        assert (nodes[0] if nodes else []) == library.encode(whole, add_special_tokens=False).ids


def test_encode_over_rows(spark, library):
    long = "unsplit" * 500 + " words and <|endoftext|>" * 90 + "'ll " * 200
    rows = [(1, "A text", "x"), (2, None, None), (3, "", "y"), (4, long, "z"), (4, long, "z"), (None, long[::-1], "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = bpe.encode(docs, path=PATH, leaf_chars=64, decoded="Doc_ID2").collect()
    assert found[0].asDict().keys() == {"doc_id", "ids", "Doc_ID2"}
    got = sorted((r["doc_id"] or 0, r["ids"], r["Doc_ID2"]) for r in found)
    want = []
    for key, body, _ in rows:
        ids = library.encode(body or "", add_special_tokens=False).ids
        want.append((key or 0, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_digests(spark, library):
    docs = spark.createDataFrame([(1, "Élan vital!"), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in bpe.round_trip(docs).collect()}
    ids = library.encode("Élan vital!", add_special_tokens=False).ids
    assert found[1]["n_tokens"] == len(ids)
    assert found[1]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert found[1]["decoded_sha256"] == hashlib.sha256("Élan vital!".encode()).hexdigest()
    assert found[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table_and_only_a_text(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(docs).count() == 0
    assert bpe.encode(docs.select("text")).columns == ["ids"]


def test_decode_column(spark, library):
    ids = library.encode("a <|endoftext|> b").ids
    df = spark.createDataFrame([(ids,), (None,), ([],)], "ids array<int>")
    got = [r[0] for r in df.select(bpe.decode(F.col("ids"))).collect()]
    assert got == ["a <|endoftext|> b", "", ""]
