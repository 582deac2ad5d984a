"""Removal of word sequences that recur, by automata of the passages that do.

A window is ``WINDOW`` consecutive words of one document. Each word goes that lies in a window whose
words also start anywhere else, in the same document too; windows are judged on the input.

1. *Recurring passages are confirmed.* Of the ``GRAM``-word grams in a window the one with the least
   hash is its anchor, so equal windows have equal anchors. Neighbouring windows with one anchor make a
   context, some 45 words with an anchor every 12, and only (anchor, context) hashes are counted. A
   context that occurs twice recurs in all its windows. Where an anchor has different contexts, as at
   the ends of passages and around edits, one occurrence of each is looked at window by window.
2. *Automata are compiled, in shards.* Documents are dealt to buckets of about ``BUCKET_BYTES``. Per
   bucket, each confirmed passage that one of its documents holds is cut from the first such document,
   and pyahocorasick compiles these phrases, as sequences of word numbers, ``SHARD_WORDS`` at a time.
3. *All documents stream through their bucket's automata*, which locate every occurrence of every
   phrase; the words that these cover are removed.

So each document is sent to one place, and meets the phrases that may occur in it, not those of the
whole corpus. Hashes only choose phrases, by 128 bits; words are compared as they are.

Rows: null and empty texts, and texts of fewer words than a window, lose nothing; repeated rows are
documents like others, so that they lose all windows; a null id is an id; an empty table gives an empty
one; a long text takes memory in proportion to itself only; other columns are not looked at, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_chars, drop_stored, or_empty, stored
from .periodic_runs import BASE, INVERSE, table_of
from .shingles import mix

WINDOW = 35
GRAM = 8
BUCKET_BYTES = 1 << 18
RUN_WORDS = 1 << 20
SHARD_WORDS = 1 << 21
STRETCH = 1 << 18
HELD_WORDS = 1 << 19
_PLACE = np.uint64((1 << 24) - 1)
CONTEXT = "row long, at int, size int, anchor long, context long"


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen of late."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def words_of(text: str) -> list[bytes]:
    """What blanks, tabs, line ends, vertical tabs and form feeds leave between them."""
    return text.encode("utf-8", "replace").split()


def _sums(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(hashes * table_of(BASE, len(hashes))[: len(hashes)], out=out[1:])
    return out


def _hash_of(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of words, whatever lies around them."""
    with np.errstate(over="ignore"):
        same = (sums[end] - sums[start]) * table_of(INVERSE, len(sums))[start]
        return mix(same + (end - start).astype(np.uint64))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:])


def contexts(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, length, anchor and hash of the contexts in the words of some texts.

    ``ends`` has, for each word, where its text ends. A stretch may cut a context in two, which costs
    a look at its windows and changes no result.
    """
    found = [(np.zeros(0, dtype=np.int64),) * 4]
    for low in range(0, len(hashes) - WINDOW + 1, STRETCH):
        part = hashes[low : low + STRETCH + WINDOW - 1]
        n = len(part)
        start = np.flatnonzero(np.arange(low + WINDOW, low + n + 1) <= ends[low : low + n - WINDOW + 1])
        if not len(start):
            continue
        sums = _sums(part)
        place = np.arange(n - GRAM + 1)
        grams = _hash_of(sums, place, place + GRAM)
        # Of equal hashes the last counts; places fill the low bits, alike in equal windows.
        order = (grams & ~_PLACE) | (n - place).astype(np.uint64)
        least = least_of(order, WINDOW - GRAM + 1)
        anchor = n - (least[start] & _PLACE).astype(np.int64)
        first = np.ones(len(start), dtype=bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        begins = np.flatnonzero(first)
        i, j = start[begins], start[np.append(begins[1:], len(start)) - 1] + WINDOW
        found.append((i + low, j - i, grams[anchor[begins]].view(np.int64), _hash_of(sums, i, j).view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found))


def context_rows(rows: DataFrame) -> DataFrame:
    """All contexts of the texts: ``row`` key, place and size in words, ``anchor`` and ``context``."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            begin = 0
            for texts in by_chars(batch["body"]):
                keys = batch["row"].to_numpy()[begin : begin + len(texts)]
                begin += len(texts)
                words = [words_of(t) for t in texts]
                sizes = np.array([len(w) for w in words])
                ends = np.cumsum(sizes)
                hashes = np.concatenate([known.of(w) for w in words])
                at, size, anchor, context = contexts(hashes, np.repeat(ends, sizes))
                text = np.searchsorted(ends, at, side="right")
                yield pd.DataFrame(
                    {
                        "row": keys[text], "at": at - (ends - sizes)[text], "size": size,
                        "anchor": anchor, "context": context,
                    }
                )

    return rows.mapInPandas(found, CONTEXT)


def window_rows(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The window hashes of single contexts, cut from the texts with their row keys."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            for body, row, places in zip(batch["body"], batch["row"], batch["places"]):
                hashes, out = known.of(words_of(body)), []
                for p in places:
                    part = hashes[p["at"] : p["at"] + p["size"]]
                    start = np.arange(max(len(part) - WINDOW + 1, 0))
                    found = _hash_of(_sums(part), start, start + WINDOW).view(np.int64)
                    out.append((row, p["at"], p["size"], p["anchor"], p["context"], p["n"], found))
                yield pd.DataFrame(out, columns=names)

    names = ["row", "at", "size", "anchor", "context", "n", "windows"]
    place = F.struct("at", "size", "anchor", "context", "n")
    places = wanted.groupBy("row").agg(F.collect_list(place).alias("places"))
    met = rows.select("row", "body").join(places, "row")
    return met.mapInPandas(cut, f"{CONTEXT}, n long, windows array<long>")


def confirmed(rows: DataFrame, seen: DataFrame, bucket: Callable) -> DataFrame:
    """Per bucket the places of the passages to look for there: ``bucket, row, at, size, context``
    and ``offsets`` of the windows that recur, null for all of them.

    A passage's place is in the bucket's row of the least key, which comes first.
    """
    place = F.struct("row", "at", "size")
    known = seen.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    known = stored(known, "phrase-contexts")
    several = known.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor")
    unlike = known.join(several, "anchor", "left_semi").select("anchor", "context", "n", "place.*")
    windows = stored(window_rows(rows, unlike), "phrase-windows")
    each = windows.select("anchor", "context", "n", F.posexplode("windows").alias("offset", "window"))
    # A row given twice brings its contexts twice, so different ones are told by their hashes.
    again = each.groupBy("anchor", "window").agg(
        F.min("context").alias("low"), F.max("context").alias("high"), F.max("n").alias("n")
    )
    again = again.where("low <> high or n > 1").select("anchor", "window")
    offsets = (
        each.where("n = 1")
        .join(again, ["anchor", "window"])
        .groupBy("anchor", "context")
        .agg(F.sort_array(F.collect_set("offset")).alias("offsets"))
    )
    parts = known.where("n = 1").join(offsets, ["anchor", "context"])
    parts = parts.select(
        bucket("place.row").alias("bucket"), "place.row", "place.at", "place.size", "context", "offsets"
    )
    whole = known.where("n > 1").select("anchor", "context")
    whole = (
        seen.join(whole, ["anchor", "context"], "left_semi")
        # Dealt anew before they are grouped, so that the join may split a context with many rows.
        .repartition(bucket("row"))
        .groupBy(bucket("row").alias("bucket"), "anchor", "context")
        .agg(F.min(place).alias("place"))
        .select("bucket", "place.*", "context", F.lit(None).cast("array<int>").alias("offsets"))
    )
    out = stored(whole.union(parts), "phrases")
    drop_stored(known, windows)
    return out


class Bucket:
    """The phrases of one bucket, and documents that wait for them to be looked up."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.phrases: dict[tuple, None] = {}
        self.waiting: list[tuple[object, list[bytes], tuple]] = []
        self.size = 0

    def add(self, name, words: list[bytes], places: list[tuple], known: WordHashes) -> None:
        """A document, and the phrases to cut from it."""
        codes = tuple([self.numbers.setdefault(w, len(self.numbers)) for w in words])
        if places:
            at, size, context = (np.array([p[i] for p in places], dtype=np.int64) for i in range(3))
            own = at + size <= len(words)
            ends = np.where(own, at + size, 0)
            own &= _hash_of(_sums(known.of(words)), np.where(own, at, 0), ends).view(np.int64) == context
            for good, (start, n, _, offsets) in zip(own.tolist(), places):
                if good:  # else the place belongs to another text of the same key
                    for i, j in joined(offsets) if offsets is not None else [(0, n)]:
                        self.phrases[codes[start + i : start + j]] = None
        self.waiting.append((name, words, codes))
        self.size += len(words)

    def located(self) -> Iterator[tuple[object, list[bytes], np.ndarray]]:
        """The waiting documents with a mark at each word that a phrase covers."""
        edges = [np.zeros(len(codes) + 1, dtype=np.int64) for _, _, codes in self.waiting]
        for automaton in self.automata():
            for (_, _, codes), edge in zip(self.waiting, edges):
                if len(codes) >= WINDOW:
                    for last, size in automaton.iter(codes):
                        edge[last + 1 - size] += 1
                        edge[last + 1] -= 1
        for (name, words, _), edge in zip(self.waiting, edges):
            yield name, words, np.cumsum(edge[:-1]) > 0
        self.waiting, self.size = [], 0

    def automata(self) -> Iterator[ahocorasick.Automaton]:
        """Shards of the phrases, one after the other."""
        shard, words = _new_automaton(), 0
        for phrase in self.phrases:
            shard.add_word(phrase)
            words += len(phrase)
            if words >= SHARD_WORDS:
                shard.make_automaton()
                yield shard
                shard, words = _new_automaton(), 0
        if words:
            shard.make_automaton()
            yield shard


def _new_automaton() -> ahocorasick.Automaton:
    return ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)


def joined(offsets) -> Iterator[tuple[int, int]]:
    """Windows at sorted places as the stretches that neighbouring ones cover."""
    first = last = None
    for at in offsets:
        if first is not None and at > last + 1:
            yield first, last + WINDOW
            first = None
        first = at if first is None else first
        last = at
    if first is not None:
        yield first, last + WINDOW


def _kept(words: list[bytes], gone: np.ndarray) -> bytes:
    if not gone.any():
        return b" ".join(words)
    return b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])


def _digest(words, gone):
    return len(words), int(gone.sum()), hashlib.sha256(_kept(words, gone)).hexdigest()


def _text(words, gone):
    return len(words), int(gone.sum()), _kept(words, gone).decode("utf-8")


def _spans(words, gone):
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).view(np.int8)))
    pairs = edges.reshape(-1, 2).tolist()
    return len(words), int(gone.sum()), [{"start": i, "end": j} for i, j in pairs]


KINDS = {
    "kept_sha256": ("string", _digest),
    "text": ("string", _text),
    "spans": ("array<struct<start: bigint, end: bigint>>", _spans),
}


def without_repeats(docs: DataFrame, result: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the ``result``: the kept words joined by blanks as
    ``text``, their digest as ``kept_sha256``, or the removed stretches of words as ``spans``.

    The places of the phrases are kept in the shared folder for as long as the result is used.
    """
    kind, finish = KINDS[result]
    rows = docs.select("doc_id", or_empty("text").alias("body"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "body"))
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_buckets = -(-size // BUCKET_BYTES) or 1

    def bucket(key):
        return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("long")

    seen = stored(context_rows(rows), "phrase-anchors")
    phrases = confirmed(rows, seen, bucket)
    drop_stored(seen)

    both = rows.select(bucket("row").alias("bucket"), "row", F.lit(1).alias("kind"), "doc_id", "body").unionByName(
        phrases.withColumn("kind", F.lit(0)), allowMissingColumns=True
    )
    dealt = both.repartition("bucket").sortWithinPartitions("bucket", "row", "kind")

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, held, at, places, row = WordHashes(), Bucket(), None, [], None

        def results() -> pd.DataFrame:
            found = [(name, *finish(words, gone)) for name, words, gone in held.located()]
            return pd.DataFrame(found, columns=["doc_id", "n_words", "n_removed", result]).astype({"doc_id": object})

        for batch in batches:
            columns = (batch[c].tolist() for c in ("bucket", "row", "kind", "name", "body"))
            spots = zip(*(batch[c].tolist() for c in ("at", "size", "context", "offsets")))
            for (number, key, is_doc, name, body), spot in zip(zip(*columns), spots):
                if number != at:
                    if held.waiting:
                        yield results()
                    held, at, places, row = Bucket(), number, [], None
                if key != row:
                    places, row = [], key
                if not is_doc:
                    places.append(spot)
                    continue
                held.add(name, words_of(body), places, known)
                places = []
                if held.size >= RUN_WORDS:
                    yield results()
        if held.waiting:
            yield results()

    # Numbers with nulls would arrive as floating point: zeros stand for those of the other kind.
    plain = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("at", "size", "context")]
    name = F.col("doc_id").cast("string").alias("name")
    dealt = dealt.select("bucket", "row", "kind", name, "body", *plain, "offsets")
    made = dealt.mapInPandas(stream, f"doc_id string, n_words long, n_removed long, {result} {kind}")
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def repeat_digests(docs: DataFrame) -> DataFrame:
    """Per document its words, how many were removed, and the digest of those that are left."""
    return without_repeats(docs, "kept_sha256")
