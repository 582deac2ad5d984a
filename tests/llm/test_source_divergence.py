import random
import re
from collections import Counter

import numpy as np
import pytest

from sqlsieve.llm import source_divergence as s

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    groups = sorted({(lang, source) for lang, source, _ in rows})
    counts = {g: Counter() for g in groups}
    having = {lang: Counter() for lang, _ in groups}
    for lang, source, text in rows:
        found = TERM.findall(text.translate(LOWER))
        counts[lang, source].update(found)
        having[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in having[lang].items() if n >= least_docs]
        whole = sum((counts[g] for g in groups if g[0] == lang), Counter())

        def shares(found):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own, all_of_it = shares(counts[lang, source]), shares(whole)
        pairs = [
            (-sum(abs(own[t] - other[t]) for t in kept), b)
            for a, b in groups
            if a == lang and b != source
            for other in [shares(counts[a, b])]
        ]
        terms = [
            (all_of_it[t] - own[t], t) for t in kept if counts[lang, source][t] and own[t] > all_of_it[t]
        ]
        for part, found in (("pair", sorted(pairs, key=key)), ("term", sorted(terms, key=key)[:top])):
            out += [(lang, source, part, item, -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def key(pair):
    return pair[0], pair[1].encode()


def corpus(seed):
    rng = random.Random(seed)
    words = [f"W{chr(97 + i % 26)}{chr(65 + i // 26)}é" for i in range(200)] + ["x", "日本", "ÄB"]
    rows = []
    for _ in range(400):
        lang, source = rng.choice([None, "", "en", "de"]), rng.choice(["a", "b", "ß", None, "z", "a"])
        first = rng.randrange(100)
        text = rng.choice([" ", "1", "-\n"]).join(rng.choice(words[first : first + 60]) for _ in range(rng.randint(0, 50)))
        rows.append((lang, source, text))
    rows += [("en", "empty", None), ("fr", "a", "Lone text"), ("fr", "b", ""), ("fr", "c", None), ("xx", "only", "w")]
    rows += [("de", "long", "Term ß " * 40_000)] + [("en", "a", "same Same")] * 40
    return rows


@pytest.mark.parametrize("block,held", [(1 << 16, 400_000), (7, 50)])
def test_divergence(spark, monkeypatch, block, held):
    monkeypatch.setattr(s, "BLOCK", block)
    monkeypatch.setattr(s, "HELD_TERMS", held)
    rows = corpus(block)
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "lang string, source string, text string, n int, term string")
    found = s.divergence(docs, least_docs=8, top=9)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 8, 9)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert s.divergence(docs).count() == 0


def test_shares_are_exact_for_large_counts():
    for count, total, terms in [(10**15, 8 * 10**15, 10**7), (0, 0, 1), (3, 10**12, 999), (7, 7, 1)]:
        exact = 1 + 10**9 * (count + 5) // (total + 5 * terms)
        assert int(s.share(np.array([count]), total, terms)[0]) == exact == s.share(count, total, terms)


def test_gallop():
    rng = np.random.default_rng(1)
    for n, m in [(0, 5), (5, 0), (10, 5_000), (3_000, 3_000), (1, 1)]:
        ids, among = (np.unique(rng.integers(0, 9_000, k)) for k in (n, m))
        for step in (1, 3, 1_024):
            assert np.array_equal(s.gallop(ids, among, step), np.searchsorted(among, ids))
