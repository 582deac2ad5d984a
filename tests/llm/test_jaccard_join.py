import random
import re
from fractions import Fraction

import numpy as np
import pytest

from sqlsieve.llm import jaccard_join as j
from sqlsieve.llm import shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, width):
    words = WORD.findall((text or "").encode().lower().decode())
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, threshold):
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            union = len(sets[a] | sets[b])
            if sets[a] and sets[b] and both * threshold.denominator >= union * threshold.numerator:
                parent[root(a)] = root(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return [(key, len(sets[i]), least.get(root(i))) for i, (key, _) in enumerate(rows)]


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    rows, texts = [], []
    for _ in range(40):
        texts.append([rng.choice(words) for _ in range(rng.randint(0, 120))])
    for i in range(160):
        text = list(rng.choice(texts[:12] if i % 2 else texts))
        for _ in range(rng.randint(0, 3)):
            if text:
                text[rng.randrange(len(text))] = rng.choice(words)
        if i % 3 == 0:
            text = passage + text[:60]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(text)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "one  two"), (None, "one"), (None, "x y z q"), (503, "one")]
    rows += [(600, "ab " * 30_000), (601, "ab " * 30_000 + "c"), (602, "İ k"), (603, "i̇ k")]
    return rows


@pytest.mark.parametrize("width,threshold,block,part", [
    (3, Fraction(9, 10), 1000, 64), (2, Fraction(3, 5), 7, 2),
])
def test_components(spark, monkeypatch, width, threshold, block, part):
    monkeypatch.setattr(j, "LIST_BLOCK", block)
    monkeypatch.setattr(j, "GROUP_PART", part)
    if block < 1000:
        monkeypatch.setattr(j, "FOREST_PAIRS", 3)
        monkeypatch.setattr(j, "CHUNK_ROWS", 5)
        monkeypatch.setattr(j, "CHUNK_SHINGLES", 300)
    rows = corpus(width)
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, key string")
    found = [tuple(r) for r in j.components_of(docs, width, threshold).collect()]
    assert sorted(found, key=str) == sorted(brute(rows, width, threshold), key=str)


def test_one_of_each(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, h string")
    kept = j.one_of_each(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    found = brute(rows, 5, Fraction(4, 5))
    want = {k for k, n, component in found if k is not None and (n == 0 or k == component)}
    assert sorted(k for k, _ in got if k is not None) == sorted(want)
    assert [t for k, t in got if k is None] == ["x y z q"]
    assert j.one_of_each(docs.limit(0)).count() == 0


def test_shingle_sets_are_those_of_the_words():
    texts = [t or "" for _, t in corpus(2)] + ["a" * 200_000 + " b " + "a" * 200_000, "é " * 70_000]
    for width in (1, 3):
        names = {}
        for text, found in zip(texts, shingles.shingle_sets(texts, width)):
            assert len(found) == len(shingle_set(text, width))
            names.setdefault(shingle_set(text, width), set()).add(shingles.set_key(found))
        assert all(len(n) == 1 for n in names.values())
        assert len({next(iter(n)) for n in names.values()}) == len(names)


def test_sketches_never_reject_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
        b = np.unique(np.concatenate((a[: rng.integers(250, 300)], rng.integers(0, 1 << 63, 20, dtype=np.uint64))))
        bits = np.frombuffer(j.sketch(a), np.uint64) ^ np.frombuffer(j.sketch(b), np.uint64)
        assert np.bitwise_count(bits).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("rows,shingles", [(1 << 13, 1 << 20), (3, 200)])
def test_prefixes_are_in_the_order_of_exact_counts(spark, monkeypatch, rows, shingles):
    monkeypatch.setattr(j, "CHUNK_ROWS", rows)
    monkeypatch.setattr(j, "CHUNK_SHINGLES", shingles)
    texts = sorted({t for _, t in corpus(3) if t})
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id long, h long, body string")
    threshold = Fraction(4, 5)
    found = {bytes(r["key"]): r for r in j.prefixes(docs, 3, threshold, 5_000).collect()}
    sets = {shingles_of.tobytes(): shingles_of for shingles_of in j.shingle_sets(texts, 3) if len(shingles_of)}
    names = {j.set_key(s): s for s in sets.values()}
    chunks = {}
    for r in j.set_rows(docs, 3).where("found is not null").select("chunk", "key").distinct().collect():
        chunks.setdefault(r["chunk"], []).append(names[bytes(r["key"])])
    counts = {}
    for members in chunks.values():  # equal sets of different chunks count once a chunk
        for member in members:
            for x in (member >> np.uint64(16)).tolist():
                counts[x] = counts.get(x, 0) + 1
    want = {}
    for key, members in names.items():
        order = sorted((members >> np.uint64(16)).tolist(), key=lambda x: (counts[x], x))
        prefix = order[: j.prefix_size(threshold, len(order))]
        alone = sum(counts[x] == 1 for x in order)
        if alone < len(prefix):
            want[key] = (len(order), alone, prefix[alone:])
    assert {k: (r["n"], r["skip"], r["prefix"]) for k, r in found.items()} == want
    assert want and len(want) < len(names)


def test_a_large_group_of_near_copies_stays_in_bounds():
    """In lists of close copies a forest is found without holding the pairs of all members."""
    rng, size = np.random.default_rng(2), 3000
    common = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    rows = []
    for i in range(size):
        members = np.unique(np.append(common[1:], np.uint64(i + 1)))
        rows.append((7, 0, 0, 0, i, 300, 0, j.set_key(members), j.sketch(members), None))
    names = ["token", "i", "j", "block", "q", "n", "place", "key", "bits", "failed"]
    frame = j.pd.DataFrame(rows, columns=names).assign(label=lambda f: f["key"])
    found = j._pairs_in(frame, Fraction(9, 10), 0, 10_000)
    assert len(found) == size - 1
    assert len(set(found["a"]) | set(found["b"])) == size


def test_whole_sets_come_from_one_worker_a_task(spark, capsys):
    """A second Python worker beside the one that makes sets is memory that every task takes."""
    texts = [t for _, t in corpus(5)] + [None, ""]
    docs = spark.createDataFrame([(i, t or "") for i, t in enumerate(texts)], "doc_id long, body string")
    docs = docs.withColumn("h", j.F.xxhash64("body"))
    rows = j.set_rows(docs, 3, whole=False)
    sets = {j.set_key(s): s.tobytes() for s in j.shingle_sets([t or "" for t in texts], 3) if len(s)}
    names = spark.createDataFrame([(k,) for k in sorted(sets)[::2]], "key binary")
    found = j.sets_of(docs, 3, rows.localCheckpoint(), names)
    assert {bytes(r["key"]): bytes(r["found"]) for r in found.collect()} == {k: sets[k] for k in sorted(sets)[::2]}
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInPandas") >= 1 and "ArrowEvalPython" not in plan


def test_a_worker_gives_freed_memory_back(monkeypatch):
    called = []
    monkeypatch.setattr(j, "trim", lambda: called.append(1))
    rows = j.pd.DataFrame({"doc_id": [1, 2], "h": [1, 2], "body": ["a b c d", "e f g h"]})
    monkeypatch.setattr(j, "TaskContext", type("T", (), {"get": lambda: type("C", (), {"partitionId": lambda s: 0})()}))
    assert sum(map(len, j._described(3, True)(iter([rows])))) == 2 and called == [1]
    assert sum(map(len, j._sent(3, 4)(iter([rows])))) >= 2 and len(called) >= 2
