"""Exact token counts at every prefix of a text, by dynamic programming.

For a piece vocabulary with merges by score, the last token of every prefix is unique: it is the
piece that ends there and that stays apart from the last token of the prefix before it when the
two are merged on their own. So one pass from left to right gives, at each position, the last token
and with it the number of tokens of that prefix. The counts are stored with the row and answer
afterwards, without any tokenizer, how many tokens a prefix has, whether a text fits a budget, and
where to cut it.

No piece crosses from other characters into a white-space mark or holds a character outside the
vocabulary, so texts fall into segments that do not affect each other. Segments repeat: each
worker process keeps the counts of those of up to ``LONGEST_KEPT`` characters that it has met, from
task to task, and forgets them all once they number ``MEMORY`` or hold ``KEPT_CHARS`` characters, so
that its memory is bounded; what it forgets it computes again.

Rows: a null text counts as an empty one and has no tokens; control strings such as ``</s>`` inside
a text are ordinary characters; repeated rows give repeated results; an empty table gives an empty
one; a column of the input that has the name of a new one is replaced.
"""

from __future__ import annotations

import itertools
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_chars, or_empty, others, vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
MEMORY = 600_000
KEPT_CHARS = 16_000_000  # characters of all segments that a worker keeps
LONGEST_KEPT = 64
CELLS = 1_000_000
SPACE = "▁"
BASE = 0x5851F42D4C957F2D
MIXERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
TABLE_BITS = 20
NONE, OUTSIDE = -2, -1


class Pieces:
    """The normal pieces of a sentencepiece BPE model, and prefix counts with them."""

    def __init__(self, path: str, memory: int = MEMORY):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        mixed = [p for p in self.score if SPACE in p[1:] and p.strip(SPACE)]
        if mixed or model.encode("a  b", out_type=str)[0] != SPACE + "a":
            raise ValueError(f"{path}: pieces cross white space, or texts are not marked")
        self.longest = max(map(len, self.score))
        known = "".join(sorted({c for p in self.score if len(p) > 1 for c in p} - {SPACE}))
        self.segments = re.compile(f"{SPACE}*[{re.escape(known)}]+|{SPACE}+|.", re.DOTALL)
        self.score = {p: v for p, v in self.score.items() if self.merged(p) == [p]}
        self.names = list(self.score)
        self._index_pieces()
        self.apart: dict[int, bool] = {}
        self.memory = memory
        self.forget()

    def _index_pieces(self) -> None:
        """Two tables from parts of a piece's hash to its number; what meets in one is in the other."""
        lengths = np.fromiter(map(len, self.names), dtype=np.int64, count=len(self.names))
        self.powers = np.power(np.uint64(BASE), np.arange(self.longest + 1, dtype=np.uint64))
        self.hashes = np.empty(len(self.names), dtype=np.uint64)
        for length in np.unique(lengths):
            of = np.flatnonzero(lengths == length)
            codes = _codes([self.names[i] for i in of]).reshape(len(of), length)
            self.hashes[of] = _prefix_hashes(codes)[:, -1]
        self.tables = [np.full(1 << TABLE_BITS, -1, dtype=np.int32) for _ in range(2)]
        first, second = self.tables
        first[self._slot(self.hashes, 0)] = np.arange(len(self.names))
        rest = np.flatnonzero(first[self._slot(self.hashes, 0)] != np.arange(len(self.names)))
        slots = self._slot(self.hashes[rest], 1)
        if len(np.unique(slots)) < len(slots):
            raise ValueError("two pieces meet in both tables: choose another BASE")
        second[slots] = rest

    @staticmethod
    def _slot(hashes: np.ndarray, table: int) -> np.ndarray:
        mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(MIXERS[table])
        return (mixed >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 where there is none."""
        found = self.tables[0][self._slot(hashes, 0)]
        wrong = np.flatnonzero((found < 0) | (self.hashes[found] != hashes))
        again = self.tables[1][self._slot(hashes[wrong], 1)]
        again[(again >= 0) & (self.hashes[again] != hashes[wrong])] = -1
        found[wrong] = again
        return found

    def merged(self, text: str) -> list[str]:
        """Merges of a short text: the best-scored pair first, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            pairs = [score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            best = max(pairs)
            if best == -np.inf:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether pairs of tokens are the encodings of their concatenations."""
        keys, places = np.unique(before.astype(np.int64) << 32 | after, return_inverse=True)
        apart, names = self.apart, self.names
        if len(apart) + len(keys) > 2 * self.memory:
            apart.clear()
        out = []
        for key in keys.tolist():
            found = apart.get(key)
            if found is None:
                a, b = names[key >> 32], names[key & 0xFFFFFFFF]
                found = apart[key] = self.merged(a + b) == [a, b]
            out.append(found)
        return np.array(out, dtype=bool)[places]

    def count(self, segments: list[str]) -> list[np.ndarray]:
        """Tokens of each non-empty prefix of the segments, which are about equally long."""
        lengths = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        width = int(lengths.max())
        codes = np.zeros((len(segments), width), dtype=np.uint32)
        codes[np.arange(width) < lengths[:, None]] = _codes(segments)
        hashes = _prefix_hashes(codes)
        last = np.full((len(segments), width + 1), NONE, dtype=np.int32)
        counts = np.zeros((len(segments), width + 1), dtype=np.int32)
        for end in range(1, width + 1):
            left = np.flatnonzero(lengths >= end)
            for size in range(min(self.longest, end), 0, -1):
                begin = end - size
                number = self.numbers(hashes[left, end] - hashes[left, begin] * self.powers[size])
                rows = left[number >= 0]
                if not len(rows):
                    continue
                piece, before = number[number >= 0], last[rows, begin]
                good = before < 0
                check = np.flatnonzero(~good)
                if len(check):
                    good[check] = self.stay(before[check], piece[check])
                rows = rows[good]
                last[rows, end] = piece[good]
                counts[rows, end] = counts[rows, begin] + 1
                left = left[last[left, end] == NONE]
                if not len(left):
                    break
            if len(left):  # a character outside the vocabulary: one token for each of its bytes
                last[left, end] = OUTSIDE
                code = codes[left, end - 1]
                size = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                counts[left, end] = counts[left, end - 1] + size
        return [counts[i, 1 : n + 1] for i, n in enumerate(lengths.tolist())]

    def forget(self) -> None:
        """Drops the kept segments: their places in ``flat``, and the counts there."""
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 20, dtype=np.int32)
        self.start = np.zeros(1 << 16, dtype=np.int64)

    def learn(self, segments: set[str]) -> None:
        """Counts new segments, those of like length together, and keeps them."""
        ordered = sorted(segments, key=lambda s: (len(s), s))
        begin = 0
        while begin < len(ordered):
            end, width = begin, 0
            while end < len(ordered) and (end == begin or (end - begin) * width < CELLS):
                width = len(ordered[end])
                end += 1
            counts = self.count(ordered[begin:end])
            n, top = len(self.known), self.start[len(self.known)]
            sizes = np.fromiter(map(len, counts), dtype=np.int64, count=len(counts))
            ends = top + np.cumsum(sizes)
            if n + len(sizes) >= len(self.start):
                grown = max(2 * len(self.start), n + len(sizes) + 1)
                self.start = np.concatenate((self.start, np.zeros(grown, dtype=np.int64)))
            if ends[-1] > len(self.flat):
                grown = max(len(self.flat), int(ends[-1]))
                self.flat = np.concatenate((self.flat, np.zeros(grown, dtype=np.int32)))
            self.start[n + 1 : n + 1 + len(sizes)] = ends
            self.flat[top : ends[-1]] = np.concatenate(counts)
            self.known.update(zip(ordered[begin:end], range(n, n + len(sizes))))
            begin = end

    def prefix_counts(self, texts: list[str]) -> list[np.ndarray]:
        """Per text the tokens of each non-empty prefix, the whole text last."""
        found = [
            self.segments.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts
        ]
        segments = list(itertools.chain.from_iterable(found))
        if not segments:
            return [np.zeros(0, dtype=np.int32) for _ in texts]
        new = set(segments).difference(self.known)
        short = sum(n for n in map(len, new) if n <= LONGEST_KEPT)
        full = len(self.known) + len(new) > self.memory
        if new and (full or self.start[len(self.known)] + short > KEPT_CHARS):
            self.forget()
            new = set(segments)
        self.learn(new)
        at = np.fromiter(map(self.known.__getitem__, segments), dtype=np.int64, count=len(segments))
        begin = self.start[at]
        sizes = self.start[at + 1] - begin
        ends = np.cumsum(sizes)
        totals = np.concatenate(([0], np.cumsum(self.flat[begin + sizes - 1])))
        index = np.arange(ends[-1]) + np.repeat(begin - (ends - sizes), sizes)
        counts = self.flat[index] + np.repeat(totals[:-1], sizes)
        # Long segments came last, so that dropping their names leaves the others' places as they are.
        for segment in new:
            if len(segment) > LONGEST_KEPT:
                del self.known[segment]
        # Each text starts anew, after the mark that is put before it.
        firsts = np.concatenate(([0], np.cumsum(list(map(len, found)))))
        places = np.concatenate(([0], ends))[firsts]
        return [
            (counts[a + 1 : b] - totals[f]).astype(np.int32) if b > a else np.zeros(0, np.int32)
            for a, b, f in zip(places, places[1:], firsts)
        ]


def _pieces(path: str) -> Pieces:
    """The pieces of a model, with what this worker process has counted before.

    The function that runs in a worker is unpickled anew for each task, so what is to outlive a
    task hangs on a module of the process.
    """
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    if ("pieces", path) not in kept:
        kept["pieces", path] = Pieces(path)
    return kept["pieces", path]


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Per row the polynomial hashes of all its prefixes, the empty one first."""
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(MIXERS[0])
    mixed ^= mixed >> np.uint64(31)
    out = np.zeros((len(codes), codes.shape[1] + 1), dtype=np.uint64)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * np.uint64(BASE) + mixed[:, i]
    return out


def prefix_counts(text: Column | str, path: str | None = None) -> Column:
    """``array<int>``: at position i the tokens of the first i code points, null text as empty."""
    path = path or vocabulary_path(VOCABULARY)

    @F.pandas_udf("array<int>")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = _pieces(path)
        for texts in batches:
            for part in by_chars(texts):
                yield pd.Series(pieces.prefix_counts(part), dtype=object)

    return counted.asNondeterministic()(or_empty(text))


def total(counts: Column | str) -> Column:
    """Tokens of the whole text."""
    counts = F.col(counts) if isinstance(counts, str) else counts
    return F.coalesce(F.try_element_at(counts, F.lit(-1)), F.lit(0)).cast("long")


def tokens_of_prefix(counts: Column | str, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` code points; more than there are means all."""
    counts = F.col(counts) if isinstance(counts, str) else counts
    at = F.least(n_chars, F.size(counts)).cast("int")
    return F.when(at < 1, F.lit(0)).otherwise(F.try_element_at(counts, at))


def chars_within(counts: Column | str, budget: Column | int) -> Column:
    """Length of the longest prefix of at most ``budget`` tokens.

    Counts may fall as a prefix grows, when a merge is completed, so the last fitting one is taken.
    """
    counts = F.col(counts) if isinstance(counts, str) else counts
    at = F.transform(counts, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))
    return F.coalesce(F.array_max(at), F.lit(0))


def with_counts(docs: DataFrame, text: str = "text", name: str = "prefix_tokens", path=None):
    """``docs`` with the prefix counts of a text column."""
    kept = others(docs, name)
    return docs.select(*kept, prefix_counts(docs[f"`{text}`"], path).alias(name))


def token_counts(docs: DataFrame, limit: int = 4096, path: str | None = None) -> DataFrame:
    """Per document its bytes, its tokens, and whether they are more than ``limit``."""
    counted = docs.select(
        "doc_id",
        F.octet_length(or_empty("text")).cast("long").alias("n_bytes"),
        prefix_counts("text", path).alias("counts"),
    )
    sized = counted.select("doc_id", "n_bytes", total("counts").alias("n_tokens"))
    return sized.withColumn("over_limit", F.col("n_tokens") > limit)
