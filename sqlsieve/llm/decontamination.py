"""Benchmark passages in documents, exact or with a few characters changed.

Pigeonhole edit matching: a test item may occur with at most ``rate`` of its characters inserted,
deleted or replaced. Cut into one piece more than that budget, at least one piece of every such
occurrence is unchanged. So an automaton finds all exact piece hits in one pass over the text, and
only around these Myers' bit-parallel algorithm computes the edit distance. Before the whole item
is looked at, a hit must hold in growing groups of neighbouring pieces: if the edits in both parts
of a group were as many as the parts' pieces, the group would be over its budget, so a true
occurrence has a piece all of whose groups have fewer edits than pieces, up to the whole.

Letters A-Z count as a-z. Test items are a stated query set: they go to the executors in blocks of
at most ``BLOCK_CHARS`` characters, each of which is matched against all documents, whole texts, in
one pass without a shuffle; a document's rows never meet in one task.

Rows: null texts and ids: a null text is empty and matches nothing, rows without id are matched
like others, items without id too; an empty item, or one without any character, matches nothing;
repeated documents give repeated results, items of the same id and text count once; empty tables
give an empty result. Of several occurrences of an item the one with the fewest edits, then the
first, is given.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, or_empty, others

RATE = 0.1
BLOCK_CHARS = 4_000_000
FOUND = "item_id:bigint,distance:int,start:int,end:int"


def lower(text: str) -> str:
    """A-Z in lower case; the number of characters stays."""
    return text.encode("utf-8", "replace").lower().decode("utf-8")


def myers(pattern: str, text: str) -> list[int]:
    """Per position in ``text`` the least edits of ``pattern`` against a stretch that ends there.

    The first value stands for the empty prefix.
    """
    size = len(pattern)
    masks: dict[str, int] = {}
    for i, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << size - 1
    up, down, edits, out = full, 0, size, [size]
    for char in text:
        match = masks.get(char, 0)
        level = (((match & up) + up) ^ up) | match | down
        plus = down | ~(level | up) & full
        minus = up & level
        if plus & top:
            edits += 1
        elif minus & top:
            edits -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        match |= down
        up = minus | ~(match | plus) & full
        down = plus & match
        out.append(edits)
    return out


class Item:
    """A test item's pieces, and the groups of pieces that a hit must pass."""

    def __init__(self, text: str, rate: float):
        self.text = text
        self.budget = int(len(text) * rate)
        n = self.budget + 1
        cuts = [len(text) * i // n for i in range(n + 1)]
        self.pieces = [(cuts[i], cuts[i + 1]) for i in range(n)]
        self.groups: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        self._halve(0, n, self.budget)

    def _halve(self, first: int, last: int, budget: int) -> None:
        """Notes the group of these pieces at each of them, small groups first.

        Of two parts of a group one occurs with at most its share of the budget, as a part of
        k pieces has a budget of k - 1 and k + m pieces one of k + m - 1.
        """
        if last - first == 1:
            return
        middle = (first + last) // 2
        self._halve(first, middle, middle - first - 1)
        self._halve(middle, last, last - middle - 1)
        begin, end = self.pieces[first][0], self.pieces[last - 1][1]
        for i in range(first, last):
            self.groups[i].append((begin, end, budget))

    def passes(self, text: str, piece: int, at: int) -> bool:
        """Whether all groups of a piece that was found at ``at`` stay within their budgets."""
        origin = at - self.pieces[piece][0]
        for begin, end, budget in self.groups[piece][:-1]:
            window = text[max(0, origin + begin - budget) : origin + end + budget]
            if min(myers(self.text[begin:end], window)) > budget:
                return False
        return True

    def occurrence(self, text: str, lo: int, hi: int) -> tuple[int, int, int] | None:
        """Fewest edits, start and end of the item within a stretch of the text."""
        ends = myers(self.text, text[lo:hi])
        least = min(ends)
        if least > self.budget:
            return None
        end = ends.index(least)
        begins = myers(self.text[::-1], text[lo : lo + end][::-1])
        return least, lo + end - begins.index(least), lo + end


class Matcher:
    """An automaton over the pieces of a block of test items."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        import ahocorasick

        self.items = [(key, Item(lower(text), rate)) for key, text in items if text]
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(self.items):
            for k, (begin, end) in enumerate(item.pieces):
                places.setdefault(item.text[begin:end], []).append((n, k))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """Id, edits, start and end of each item that occurs in the text."""
        if not text or not self.items:
            return []
        text = lower(text)
        near: dict[int, list[tuple[int, int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            at = last + 1 - size
            for n, k in where:
                near.setdefault(n, []).append((at, k))
        found = []
        for n, hits in near.items():
            item, done = self.items[n][1], set()
            for at, k in hits:
                origin = at - item.pieces[k][0]
                if origin in done:
                    continue
                stretch = None
                if origin >= 0 and text.startswith(item.text, origin):
                    stretch = (0, origin, origin + len(item.text))
                elif item.passes(text, k, at):
                    lo = max(0, origin - 2 * item.budget)
                    hi = origin + len(item.text) + 2 * item.budget
                    stretch = item.occurrence(text, lo, hi)
                if stretch:
                    done.add(origin)
                    found.append((n, *stretch))
        least: dict[int, tuple[int, int, int]] = {}
        for n, *stretch in found:
            least[n] = min(least.get(n, tuple(stretch)), tuple(stretch))
        return [(self.items[n][0], *stretch) for n, stretch in sorted(least.items())]


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list]:
    """The items, without repetitions, in blocks of bounded size."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), or_empty("text").alias("text")
    ).where("text <> ''")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-total // block_chars)
    for part in range(parts):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        rows = chosen.distinct().collect()
        yield sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r))


def _finder(sent: Broadcast, rate: float):
    names = [f.split(":")[0] for f in FOUND.split(",")]

    @F.pandas_udf(f"array<struct<{FOUND}>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(sent.value, rate)
        for texts in batches:
            found = [[dict(zip(names, m)) for m in matcher.find(t)] for t in texts]
            yield pd.Series(found, index=texts.index, dtype=object)

    return find.asNondeterministic()


def matches(
    docs: DataFrame, benchmark: DataFrame, name: str = "matches", text: str = "text",
    rate: float = RATE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with an array of the test items in each text: id, edits, start and end."""
    columns = [
        _finder(docs.sparkSession.sparkContext.broadcast(items), rate)(or_empty(docs[f"`{text}`"]))
        for items in blocks(benchmark, block_chars)
    ]
    empty = F.array().cast(f"array<struct<{FOUND}>>")
    found = F.concat(*columns) if len(columns) > 1 else (columns or [empty])[0]
    return docs.select(*others(docs, name), found.alias(name))


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """A row per document and test item that occurs in it."""
    found = matches(docs.select("doc_id", "text"), benchmark, rate=rate)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents in which no test item occurs, with their columns."""
    name = free_name(docs, "matches")
    found = matches(docs, benchmark, name=name, rate=rate)
    return found.where(F.size(name) == 0).drop(name)
