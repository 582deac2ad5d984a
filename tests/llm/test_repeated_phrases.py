import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from sqlsieve.llm import repeated_phrases as r

WORD = re.compile(r"[^\x20\x09-\x0D]+")
W = r.WINDOW


def brute(rows):
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(t[i : i + W]) for t in texts for i in range(len(t) - W + 1))
    out = []
    for (name, _), words in zip(rows, texts):
        gone = set()
        for i in range(len(words) - W + 1):
            if seen[tuple(words[i : i + W])] > 1:
                gone.update(range(i, i + W))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((name, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, count=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é", "日本", "W1"]
    passages = [[rng.choice(words) for _ in range(rng.randint(30, 120))] for _ in range(12)]
    passages += [["la"] * 60, ["a", "b"] * 40, ["x", "y", "z"] * 11 + ["x", "y"]]
    rows = []
    for i in range(count):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += [rng.choice(words) for _ in range(rng.randint(0, 60))]
            if rng.random() < 0.7:
                passage = rng.choice(passages)
                i0 = rng.randint(0, 20)
                text += passage[i0 : i0 + rng.randint(20, 120)]
        if rng.random() < 0.3 and rows:  # near copies and copies
            text = WORD.findall(rng.choice(rows)[1] or "")
            if text and rng.random() < 0.6:
                text[rng.randrange(len(text))] = "edit"
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(text)))
    return rows


@pytest.mark.parametrize("bucket,run,shard,stretch", [(1 << 18, 1 << 20, 1 << 21, 1 << 18), (2_000, 300, 90, 64)])
def test_removed_words(spark, monkeypatch, bucket, run, shard, stretch):
    for name, value in (("BUCKET_BYTES", bucket), ("RUN_WORDS", run), ("SHARD_WORDS", shard), ("STRETCH", stretch)):
        monkeypatch.setattr(r, name, value)
    rows = corpus(bucket)
    rows += [(900, None), (901, ""), (902, " \n "), (None, rows[3][1]), (None, None), rows[5], rows[5], (2**60, "q " * 34 + "r"), (-5, "q " * 36)]
    rows += [(903, "once " + " ".join(f"u{i}" for i in range(80_000))), (904, "m n o " * 20_000)]
    docs = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "doc_id long, text string, row int, body string")
    found = r.repeat_digests(docs)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_spans_and_texts(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [("a", f"x {passage} y"), ("b", f"{passage}\nz"), ("c", "alone"), ("d", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    spans = {d["doc_id"]: [tuple(s) for s in d["spans"]] for d in r.without_repeats(docs, "spans").collect()}
    assert spans == {"a": [(1, 41)], "b": [(0, 40)], "c": [], "d": []}
    texts = {d["doc_id"]: d["text"] for d in r.without_repeats(docs).collect()}
    assert texts == {"a": "x y", "b": "z", "c": "alone", "d": ""}
    assert r.without_repeats(docs.limit(0)).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    passage = words[100:160]
    text = np.concatenate((words, passage, words[:7], passage))
    at, size, anchor, context = r.contexts(text, np.full(len(text), len(text)))
    of = {}
    for i, n, a in zip(at.tolist(), size.tolist(), anchor.tolist()):
        for s in range(i, i + n - W + 1):
            assert of.setdefault(text[s : s + W].tobytes(), a) == a
    assert len(at) and sum(size - W + 1) == len(text) - W + 1


def test_least_of_neighbours():
    values = np.random.default_rng(1).integers(0, 99, 200).astype(np.uint64)
    for width in (1, 2, 3, 28, 32):
        want = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert r.least_of(values, width).tolist() == want
