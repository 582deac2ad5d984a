"""Line and character measures against plain Python."""

import random
import re
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from sqlsieve.functions import text

ALPHABET = list("ab -*/\n\n\r\t") + ["\r\n", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", " ", "é", "二", " ", " "]


def random_texts(n, size, alphabet=ALPHABET, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(alphabet, k=rnd.randrange(size))) for _ in range(n)]


def test_lines(values):
    rows = ["", "\n", "a", "a\n", "a\n\n", "\r\n", "a\r\rb", "a b"] + random_texts(1500, 30)
    got = values(
        rows,
        text.lines("content"),
        text.lines_with_ends("content"),
        text.line_stats("content"),
        text.strip("content"),
        text.alnum_share("content"),
    )
    for row, (lines, kept, stats, strip, share) in zip(rows, got):
        expected = row.splitlines()
        assert lines == expected, repr(row)
        assert kept == row.splitlines(keepends=True), repr(row)
        assert stats.n_lines == len(expected), repr(row)
        assert stats.longest == max(map(len, expected), default=0)
        assert stats.mean_length == sum(map(len, expected)) / max(len(expected), 1)
        comments = [x for x in expected if x.strip().startswith(("--", "/*", "*"))]
        assert stats.n_comments == len(comments), repr(row)
        assert strip == row.strip(), repr(row)
        assert share == sum(c.isalnum() for c in row) / max(len(row), 1), repr(row)


def test_path_suffix(values):
    paths = ["a.sql", "A/B.SQL", "x/.sql", "x.tar.Gz", "a.", "noext", "d.ir/file", "a/b.Trg", "..sql",
             "dir.sql/", "a..", ".a.sql", "ü/ü.vw", "a/b .prc"]
    rows = [("", p) for p in paths]
    expected = [PurePosixPath(p).suffix.lower() for p in paths]
    assert values(rows, text.path_suffix("path")) == expected


def test_let_evaluates_once(spark):
    """A shared expression appears once however often the body mentions it."""
    df = spark.range(1).select(text.let(F.rand(), lambda x: x - x).alias("d"))
    assert df.first().d == 0.0


def test_bounds_agree_with_the_measures(values):
    """What settles a bound early says what the measure says, also where bytes and characters differ."""
    rows = ["", "\n", "é" * 9 + "\nab", "é" * 8, "a" * 9, "!!!!!!!!aa", "aa!!!!!!", "!é!二!!!!", "\u0661!!!", "a\rb\u2028c"]
    rows += random_texts(800, 40)
    split = text.split_lines("content")
    got = values(
        rows,
        text.all_lines_within(split, 8), text.longest_line(split) <= 8,
        text.mean_line_within(split, 5), text.mean_line_length(split) <= 5,
        text.alnum_share_from("content", 0.25), text.alnum_share("content") >= 0.25,
        split,
    )
    for row, (lines, longest, within, mean, enough, share, parts) in zip(rows, got):
        assert (lines, within, enough) == (longest, mean, share), repr(row)
        assert parts == re.split("\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", row), repr(row)


def test_plain_texts_are_searched_and_not_rewritten(spark):
    """A replacement compares a text at each byte; texts without other line ends are spared it."""
    found = spark.range(1).select(F.col("id").cast("string").alias("c")).select(text.split_lines("c"))
    plan = found._jdf.queryExecution().analyzed().toString().lower()
    assert plan.index("contains(") < plan.index("replace(")
