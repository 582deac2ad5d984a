import hashlib
import random

from sqlsieve.llm import imatch


def corpus(n: int, words: int):
    rng = random.Random(n)
    syllables = ["tha", "er", "ing", "on", "re", "st", "ou", "ble", "ne", "wh", "ka", "mi", "zo", "pu"]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(4)) for _ in range(800)]
    return [(i * 3, " ".join(rng.choice(vocabulary) for _ in range(words))) for i in range(n)]


def edited(rows):
    ordered = sorted(rows)
    out = {}
    for i, (key, text) in enumerate(ordered):
        cut = len(text) // 4
        out[key] = text[: len(text) - cut] + ordered[(i + 1) % len(ordered)][1][:cut]
    return out


def test_edited_texts_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(imatch, "MOST_SHARE", 0.3)
    rows = corpus(120, 150)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, h string")
    found = {r["doc_id"]: r for r in imatch.fingerprints(docs).collect()}
    for key, text in edited(rows).items():
        assert found[key]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert found[key]["n_chars"] == len(dict(rows)[key])
        assert 0 <= found[key]["near_next"] <= 1
    near = sorted(r["near_edited"] for r in found.values())
    far = sorted(r["near_next"] for r in found.values())
    assert near[len(near) // 2] > 0.4
    assert far[len(far) // 2] < 0.2


def test_odd_rows(spark):
    rows = [(None, "first"), (5, None), (5, ""), (7, "é😀 x y"), (7, "é😀 x y"), (9, "é😀 x y"), (9, "other words here"), (11, "w " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = imatch.fingerprints(docs).collect()
    assert len(found) == len(rows)
    prints = {}
    for r in found:
        prints.setdefault((r["n_chars"], r["doc_id"]), set()).add(r["fingerprint"])
    assert prints[4 + 1, None] != prints[0, 5]
    same = prints[6, 7] | prints[6, 9]
    assert len(same) == 1
    assert imatch.fingerprints(docs.limit(0)).count() == 0
    alone = imatch.fingerprints(docs.limit(0).union(spark.createDataFrame([(1, "abcdefgh")], docs.schema))).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and alone["near_next"] == 1.0


def test_frequencies_and_band(spark):
    docs = spark.createDataFrame([(1, "A a b"), (2, "a c"), (3, None)], "doc_id long, text string")
    assert sorted(r["df"] for r in imatch.frequencies(docs).collect()) == [1, 1, 2]


def test_large_group_of_copies_keeps_its_terms(spark):
    """A third of the rows are one text, at the share of documents that is used in earnest."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(15_000)]
    texts = [" ".join(rng.choice(words) for _ in range(100)) for _ in range(300)]
    rows = list(enumerate(texts)) + [(i, texts[0]) for i in range(300, 450)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in imatch.fingerprints(docs).collect()}
    group = [found[i] for i in (0, *range(300, 450))]
    assert not any(r["fingerprint"].startswith("text:") for r in group)
    assert min(r["near_edited"] for r in group) > 0.3
    assert len({r["fingerprint"] for r in group}) == 1
    assert all(found[i]["near_next"] == 1.0 for i in range(300, 449))


def test_frequencies_of_repeated_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "a c")], "doc_id long, text string")
    ab = docs.limit(1).select(imatch.terms(docs["text"]).alias("terms")).selectExpr("terms", "2L as held")
    found = imatch.frequencies(docs, repeated=ab).collect()
    assert sorted((r["rows"], r["df"]) for r in found) == [(1, 1), (2, 1), (3, 2)]
