import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from sqlsieve.llm import periodic_runs as p

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, powers=4, least=6):
    """All runs, straight from the definition."""
    n, stretches = len(words), {}
    for q in range(1, n // powers + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, powers * q):
                stretches.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in stretches.items())


def texts(seed, count=300):
    rng = random.Random(seed)
    for i in range(count):
        words = []
        for _ in range(rng.randint(0, 5)):
            piece = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 12))]
            words += piece * rng.randint(1, 7) + piece[: rng.randint(0, len(piece))]
            words += [rng.choice("abcdef") for _ in range(rng.randint(0, 9))]
        yield words


def runs(numbers, *bounds):
    """One text by itself, and the same between others."""
    alone = p.runs_of([numbers], *bounds)
    among = p.runs_of([np.zeros(9, dtype=np.int64), numbers, np.zeros(0, dtype=np.int64), numbers], *bounds)
    assert among[1] == among[3] == alone[0] and among[2] == []
    return alone[0]


@pytest.mark.parametrize("powers,least", [(4, 6), (2, 2), (3, 7)])
def test_runs_are_those_of_the_definition(powers, least):
    for words in texts(powers):
        numbers = p.numbered([w.encode() for w in words])
        assert runs(numbers, powers, least) == brute(words, powers, least)


def test_runs_are_known_after_every_word():
    for words in texts(9, 40):
        numbers, catchers = p.numbered([w.encode() for w in words]), p.Catchers()
        for i in range(len(numbers)):
            catchers.append(numbers[i : i + 1])
            if i % 7 == 0:
                assert catchers.runs() == brute(words[: i + 1])
        assert catchers.runs() == brute(words)


def test_runs_over_stretches(monkeypatch):
    monkeypatch.setattr(p, "STRETCH", 37)
    for words in texts(5, 60):
        numbers = p.numbered([w.encode() for w in words])
        assert runs(numbers) == brute(words)


def test_long_runs():
    n = 400_000
    assert runs(np.zeros(n, dtype=np.int64)) == [(0, n, 1)]
    piece = np.arange(70_001)
    assert runs(np.concatenate((np.full(3, -5), np.tile(piece, 5)))) == [(3, 350_005, 70_001)]
    fibonacci = ["b", "a"]
    while len(fibonacci[-1]) < 3000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    assert runs(p.numbered([c.encode() for c in fibonacci[-1]]), 3, 2) == brute(fibonacci[-1], 3, 2)


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % period] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_digests_of_all_kinds_of_rows(spark):
    rows = [(i, "\n ".join(w)) for i, w in enumerate(texts(2, 120))]
    rows += [(i, t) for i, (_, t) in zip(range(2**40, 2**40 + 120), rows)]
    rows += [(3, None), (4, ""), (5, " \t"), (None, "a " * 9), (None, None), (7, "é\xa0 " * 50), (7, "é\xa0 " * 50)]
    rows += [(8, "w " * 50_000), (9, "x\x0by\x0cx y x y x y"), (-20, "b " * 30)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n_runs int, start string")
    found = p.run_digests(docs)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint"] * 6 + ["string"] * 2
    small = [r for r in rows if len(r[1] or "") < 20_000]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    want = sorted((expected(*r) for r in small), key=str)
    assert [g for g in got if g[0] != 8 or g[2] is None] == [w for w in want if w[0] != 8 or w[2] is None]
    assert [g[1:6] for g in got if g[0] == 8 and g[3] == 50_000] == [(1, 0, 50_000, 1, 50_000_000)]
    assert p.run_digests(docs.limit(0)).count() == 0


def test_runs_and_collapsed_texts(spark):
    rows = [(1, "x a b a b a b a b y", 2), (2, None, 3), (3, "a  b", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cut int")
    found = docs.select("doc_id", p.periodic_runs("text").alias("runs")).collect()
    assert {r[0]: [tuple(x) for x in r[1]] for r in found} == {1: [(1, 8, 2)], 2: [], 3: []}
    kept = p.collapsed(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(1, "x a b y", 2), (2, None, 3), (3, "a  b", 4)]
