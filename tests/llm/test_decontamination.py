import random

import pytest

from sqlsieve.llm import decontamination as d


def edits(pattern: str, text: str) -> list[int]:
    row = list(range(len(pattern) + 1))
    out = [row[-1]]
    for char in text:
        new = [0]
        for i in range(1, len(pattern) + 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (pattern[i - 1] != char)))
        row = new
        out.append(row[-1])
    return out


def test_myers_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        assert d.myers(p, t) == edits(p, t)


def planted(rng, items, alphabet="abcd "):
    body = [rng.choice(alphabet) for _ in range(90)]
    passage = list(rng.choice(items)[1])
    for _ in range(rng.randint(0, 9)):
        k, kind = rng.randrange(len(passage)), rng.random()
        if kind < 0.33:
            passage[k] = rng.choice("xyz")
        elif kind < 0.66 and len(passage) > 1:
            del passage[k]
        else:
            passage.insert(k, rng.choice("xyz"))
    return "".join(body[:30] + passage + body[30:])


@pytest.mark.parametrize("rate", [0.05, 0.15])
def test_all_occurrences_are_found(rate):
    rng = random.Random(7)
    for _ in range(100):
        items = [(i, "".join(rng.choice("abcd ") for _ in range(rng.randint(12, 60)))) for i in range(4)]
        text = planted(rng, items)
        least = {i: min(edits(p, text)) for i, p in items}
        want = {i: k for i, k in least.items() if k <= int(len(dict(items)[i]) * rate)}
        found = d.Matcher(items, rate).find(text)
        assert {f[0]: f[1] for f in found} == want
        for key, distance, start, end in found:
            assert edits(dict(items)[key], text[start:end])[-1] == distance


@pytest.mark.parametrize("block_chars", [30, 10**6])
def test_rows(spark, block_chars):
    item = "The quick brown fox jumps over the lazy dog"
    other = "completely different sentence about nothing"
    bench = spark.createDataFrame(
        [(1, item), (1, item), (2, other), (3, None), (4, ""), (None, "a passage without any id of its own")],
        "item_id long, text string",
    )
    rows = [
        (10, f"xx {item.upper()} yy", "a"), (10, f"xx {item.upper()} yy", "a"), (11, item.replace("brown", "brawn"), None),
        (12, "clean " * 5000, "b"), (13, None, "c"), (14, "", "d"), (None, "z" * 300 + other, "e"),
        (15, "a passage without any id of its own", "f"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches string")
    found = d.matches(docs, bench, block_chars=block_chars)
    assert found.columns == docs.columns
    got = sorted(((r["doc_id"] or 0), [(m["item_id"], m["distance"]) for m in r["matches"]]) for r in found.collect())
    assert got == [
        (0, [(2, 0)]), (10, [(1, 0)]), (10, [(1, 0)]), (11, [(1, 1)]), (12, []), (13, []), (14, []), (15, [(None, 0)])
    ]
    kept = d.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [12, 13, 14]
    first = d.contaminated(docs, bench).where("doc_id = 10").first()
    assert (first["start"], first["end"]) == (3, 3 + len(item))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "abc")], "item_id long, text string")
    assert d.contaminated(docs, bench.limit(0)).count() == 0
    assert d.contaminated(docs.limit(0), bench).count() == 0
    assert d.clean(docs, bench.limit(0)).count() == 1
