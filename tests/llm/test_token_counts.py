import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sqlsieve.llm import token_counts
from sqlsieve.llm.common import vocabulary_path

PATH = vocabulary_path(token_counts.VOCABULARY)
PARTS = ["▁", " ", "  ", "\n", "\t", "a", "é", "</s>", "<unk>", "the", "1", "...", "日本", "😀", "ing", "ﬁ", "\x00", "кот"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(n: int) -> list[str]:
    rng = random.Random(n)
    mixed = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return mixed + ["".join(rng.choice("abcdeit ") for _ in range(60)) for _ in range(n)]


@pytest.mark.parametrize("memory", [10, 600_000])
def test_every_prefix(library, memory):
    pieces = token_counts.Pieces(PATH, memory)
    cases = texts(150)
    for text, counts in zip(cases, pieces.prefix_counts(cases)):
        assert counts.tolist() == [len(library.encode(text[:i])) for i in range(1, len(text) + 1)]


def test_long_texts(library):
    cases = ["a" * 3000, "x y" * 4000, " " * 700, "é" * 900]
    for text, counts in zip(cases, token_counts.Pieces(PATH).prefix_counts(cases)):
        assert counts[-1] == len(library.encode(text))


@pytest.mark.parametrize("chars", [100, 16_000_000])
def test_kept_segments_are_bounded_by_characters(library, monkeypatch, chars):
    monkeypatch.setattr(token_counts, "KEPT_CHARS", chars)
    rng = random.Random(5)
    pieces = token_counts.Pieces(PATH)
    words = [rng.choice("abcdeit") * rng.randint(1, 20) for _ in range(60)]
    for _ in range(5):
        long = "".join(rng.choice("abcdeit") for _ in range(300))
        cases = [long, " ".join(rng.sample(words, 6)), long[:70] + " " + words[0], "x " + long[:200]]
        for text, counts in zip(cases, pieces.prefix_counts(cases)):
            assert counts[-1] == len(library.encode(text)) and len(counts) == len(text)
        kept = pieces.start[len(pieces.known)]
        assert kept == sum(map(len, pieces.known)) <= max(chars, 4 * 20 * 8)
        assert max(map(len, pieces.known)) <= token_counts.LONGEST_KEPT


def test_rows(spark, library):
    rows = [(1, "A text of words"), (2, None), (3, ""), (1, "A text of words"), (None, "é</s>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = token_counts.token_counts(docs, limit=3).collect()
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in found)
    want = []
    for key, text in rows:
        n = len(library.encode(text or ""))
        want.append((key or 0, len((text or "").encode()), n, n > 3))
    assert got == sorted(want)
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def test_questions_without_encoding(spark, library):
    text = "Whoever counts tokens once need not count again"
    docs = spark.createDataFrame([(text, "old"), (None, "old")], "text string, prefix_tokens string")
    counted = token_counts.with_counts(docs)
    assert counted.columns == ["text", "prefix_tokens"]
    c = F.col("prefix_tokens")
    row = counted.select(
        token_counts.tokens_of_prefix(c, F.lit(12)).alias("a"),
        token_counts.tokens_of_prefix(c, F.lit(10**6)).alias("b"),
        token_counts.tokens_of_prefix(c, F.lit(0)).alias("z"),
        token_counts.chars_within(c, 4).alias("n"),
    ).first()
    counts = np.array([len(library.encode(text[:i])) for i in range(len(text) + 1)])
    assert (row["a"], row["b"], row["z"]) == (counts[12], counts[-1], 0)
    assert row["n"] == np.flatnonzero(counts <= 4).max()
