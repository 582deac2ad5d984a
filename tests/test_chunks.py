"""Chunking against a plain model, on random texts and at its limits."""

import random

import pytest

from sqlsieve.functions import chunking, rules

VERBS = {"SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "CREATE", "ALTER", "EXEC"}
KINDS = {"PROCEDURE", "PROC", "FUNCTION", "TRIGGER", "VIEW"}


def begins_object(line):
    """Word by word: create or alter, perhaps "or alter", a kind of object, and then a blank."""
    words = line.upper().split()
    if not words or words[0] not in ("CREATE", "ALTER"):
        return False
    kind = 3 if words[1:3] == ["OR", "ALTER"] else 1
    if len(words) <= kind or words[kind] not in KINDS:
        return False
    return len(words) > kind + 1 or line[-1:].isspace()


def has_verb(text):
    return bool(VERBS & set("".join(c if c.isalnum() or c == "_" else " " for c in text.upper()).split()))


def batches(text, low, high):
    pieces, current = [], []
    for line in text.split("\n"):
        if line.strip().lower() == "go":
            pieces.append("\n".join(current))
            current = []
        else:
            current.append(line)
    pieces = [p.strip() for p in [*pieces, "\n".join(current)]]
    return [p for p in pieces if low <= len(p) <= high and has_verb(p)]


def objects(text, low, high):
    found, held, start = [], None, 0
    for no, line in enumerate(text.splitlines(keepends=True)):
        head = begins_object(line)
        if held is not None and (len(held) >= high or (head and no > start + 5)):
            found.append(held)
            held = None
        if held is not None:
            held += line
        elif head:
            held, start = line, no
    if held is not None:
        found.append(held)
    return [p.strip() for p in found if len(p.strip()) >= low]


def chunks(text, low, high):
    whole = [text.strip()] if low <= len(text) <= high else []
    return batches(text, low, high) or objects(text, low, high) or whole


@pytest.fixture
def small_limits(monkeypatch):
    monkeypatch.setattr(rules, "MIN_STORED_CHUNK", 8)
    monkeypatch.setattr(rules, "MAX_CHUNK", 60)


def test_random_texts(values, small_limits):
    rnd = random.Random(7)
    lines = ["GO", " go ", "GO\r", "-- GO", "SELECT 1", "CREATE PROC a", "  alter view v AS", "", "  ",
             "create or alter function f(", "x", "CREATE PROC", "abc def ghi jkl", "二三四", "CREATE TRIGGER\t"]
    ends = ["\n", "\n", "\n", "\r\n", "\r", "\x0c", " "]
    texts = []
    for i in range(3000):
        use = lines if i % 2 else [x for x in lines if "go" not in x.lower()]
        end = ["\n"] if i % 3 else ends
        texts.append("".join(rnd.choice(use) + rnd.choice(end) for _ in range(rnd.randrange(25))))
    got = values(
        texts,
        chunking.batch_chunks("content"),
        chunking.object_chunks("content"),
        chunking.extract_chunks("content"),
    )
    for text, (by_batch, by_object, first) in zip(texts, got):
        assert by_object == objects(text, 8, 60), repr(text)
        if "\r" not in text.replace("\r\n", "\n") and "\x0c" not in text and " " not in text:
            assert by_batch == batches(text, 8, 60), repr(text)
            assert first == chunks(text, 8, 60), repr(text)
    assert sum(len(g[1]) for g in got) > 1000


def test_separators(values):
    body = "SELECT " + "x" * 90
    cases = {
        f"{body}\nGO\n{body}": 2,
        f"{body}\n  go\t\n{body}": 2,
        f"{body}\r\nGO\r\n{body}": 2,
        f"{body}\n-- GO\n{body}": 1,
        f"/*\nGO\n*/ {body}": 1,  # a separator line inside a comment does split
        f"{body}\nGO 5\n{body}": 1,
        f"{body}\n\n \nGO\n\n{body}\nGO": 2,
    }
    got = values(list(cases), chunking.batch_chunks("content"))
    assert [len(g) for g in got] == list(cases.values())
    assert got[4][0].startswith("*/")


def test_batch_lengths(values):
    def batch(n):
        return "SELECT " + "x" * (n - 7)

    texts = [batch(79), batch(80), batch(3500), batch(3501), "  " + batch(3500) + "\n", "y" * 100]
    assert [len(g) for g in values(texts, chunking.batch_chunks("content"))] == [0, 1, 1, 0, 1, 0]


def test_object_scan_limits(values):
    line = "PRINT 'abcdefghij klmnopqrst uvwxyz'\n"
    at_5 = "CREATE PROC a AS\n" + line * 4 + "CREATE PROC b AS\n" + line * 3
    at_6 = "CREATE PROC a AS\n" + line * 5 + "CREATE PROC b AS\n" + line * 3
    got = values([at_5, at_6, line * 3], chunking.object_chunks("content"))
    assert [len(g) for g in got] == [1, 2, 0]


def test_whole_file(values):
    texts = ["x" * 79, "x" * 80, " " * 3410 + "x" * 90, " " * 3411 + "x" * 90, " " * 30 + "x" * 50]
    got = values(texts, chunking.extract_chunks("content"))
    assert got == [[], ["x" * 80], ["x" * 90], [], ["x" * 50]]
