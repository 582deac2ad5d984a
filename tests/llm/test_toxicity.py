import random
import zlib

import numpy as np

from sqlsieve.llm import toxicity


def corpus(n=600):
    rng = random.Random(4)
    syllables = ["tha", "er", "ing", "on", "re", "st", "ou", "ble", "ne", "wh"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(3)) for _ in range(rng.randint(20, 80))]
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grublik", "vorzak", "xemmpo"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def tables(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, k) for i, _, k in rows], "doc_id long, toxic int")
    return docs, labels


def test_held_out_accuracy(spark):
    rows = corpus()
    docs, labels = tables(spark, rows)
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    for i, _, _ in rows:
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= found[i]["score"] <= 1
        assert found[i]["predicted"] == int(found[i]["score"] >= 0.5)
    held = [(found[i]["predicted"], k) for i, _, k in rows if found[i]["held_out"]]
    assert sum(p == k for p, k in held) >= 0.95 * len(held)


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = corpus(200)
    turned = [(i, t, 1 - k if zlib.crc32(str(i).encode()) % 5 == 0 else k) for i, t, k in rows]
    scores = []
    for data in (rows, turned):
        docs, labels = tables(spark, data)
        scores.append({r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()})
    assert scores[0] == scores[1]


def test_odd_rows(spark):
    rows = corpus(150)
    docs, labels = tables(spark, rows)
    odd = [(None, "text without id", None), (900, None, None), (901, "", None), (901, "", None), (902, "grublik " * 20_000, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    more = spark.createDataFrame([(None, 1), (0, 0), (0, None), (900, 0)], labels.schema)
    found = toxicity.toxicity(docs, labels.unionByName(more)).collect()
    assert len(found) == len(rows) + len(odd)
    empty = {r["score"] for r in found if r["doc_id"] in (900, 901)}
    assert len(empty) == 1 and next(iter(empty)) < 0.5
    assert [r["held_out"] for r in found if r["doc_id"] is None] == [False]
    assert all(r["predicted"] == 1 for r in found if r["doc_id"] == 902)


def test_without_labels_or_rows(spark):
    docs, labels = tables(spark, corpus(20))
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    kept = toxicity.without_toxic(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == 20


def test_scores_do_not_depend_on_neighbours():
    texts = [t for _, t, _ in corpus(40)]
    model = toxicity.fit([toxicity.features(t) for t in texts], __import__("numpy").arange(40) % 5 == 0, 0.2)[0]
    together = toxicity.linear(texts, model)
    assert all(toxicity.linear([t], model)[0] == s for t, s in zip(texts, together))


def test_whole_texts_are_trained_on_and_ids_once(spark, monkeypatch):
    """Toxic passages lie behind 30,000 other characters; one id has many rows with several texts."""
    taken = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda rows, *a: taken.append(rows) or fit(rows, *a))
    rows = [(i, "tha er ing " * 2_800 + t, k) for i, t, k in corpus(60)]
    docs, labels = tables(spark, rows)
    repeats = spark.range(300).selectExpr("1L as doc_id", "concat('other text ', id % 7) as text", "'x' as score")
    models = [
        toxicity.train(docs.unionByName(repeats).repartition(n, "text"), labels) for n in (3, 8)
    ]
    assert all((a == b).all() for a, b in zip(models[0][:1], models[1][:1]))
    assert len(taken[0]) <= 60
    marked = toxicity.features("grublik vorzak xemmpo")
    assert any(set(marked.tolist()) & set(r.tolist()) for r in taken[0])
    assert models[0][0][marked].max() > 0


def test_only_features_that_tell_classes_apart_reach_the_driver(spark, monkeypatch):
    taken = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda *a: taken.append(a) or fit(*a))
    rows = [(i, t + f" only{i}here", k) for i, t, k in corpus(200)]
    docs, labels = tables(spark, rows)
    model = toxicity.train(docs, labels)
    (found, toxic, share), = taken
    known = [(toxicity.features(t), k) for i, t, k in rows if zlib.crc32(str(i).encode()) % 5]
    assert len(found) <= len(known) and sum(map(len, found)) < sum(len(f) for f, _ in known) / 2
    seen = {}
    for f in found:
        for bucket in f.tolist():
            seen[bucket] = seen.get(bucket, 0) + 1
    assert seen and min(seen.values()) >= toxicity.LEAST_TEXTS
    whole = {f.tobytes(): f for f, _ in known}.values()
    matched = [next(w for w in whole if len(np.setdiff1d(f, w)) == 0) for f in found if len(f)]
    assert len(matched) > len(found) / 2
    # The model is that of whole texts, whatever number of features is summed at a time.
    monkeypatch.setattr(toxicity, "FEATURES_AT_ONCE", 7)
    again = fit(found, toxic, share)
    assert (again[0] == model[0]).all() and again[1] == model[1]
