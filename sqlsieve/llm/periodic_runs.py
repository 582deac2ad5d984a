"""Periodic runs of words, found online by catching squares over dyadic blocks.

A run is a stretch of consecutive words with smallest period q, that is words q apart are equal,
which no neighbouring word extends, of at least ``powers`` periods and ``least`` words.

Words are appended to a ``Catchers`` in order, any number at a time. Level k keeps a catcher for each
completed block of 2**k words that starts at a multiple of 2**k. It is on duty for the periods from
2**(k+1) - 1 to 2**(k+2) - 2: any stretch of so many words holds such a block whole. Each appended
word ends one suffix of 2**k words a level, which is compared, by hashes, with the two catchers whose
distance lies in that range. A suffix that equals a catcher q words before it, and the ``powers`` - 2
copies at distances of q before that, is compared word by word to both sides. That gives a square of
period q and the run that it lies in; later squares of the run merge into it, and it stays open while
appended words extend it. So a text of n words costs 2 n comparisons for each of log2(n) levels, all
of a level made at once, and some 40 bytes a word, whatever its length. Stretches of appended words
are compared at once, which finds what word by word finds; short texts share a stretch, with gaps
between them that equal nothing.

Squares within a run whose period divides theirs are multiples of it and start nothing new: if q
words in a row have a period that divides q, all the stretch of period q has it.

Rows: null and empty texts have no words and no runs; each row is worked on by itself, so repeated
rows give repeated results; a null id counts as an id whose text is left as it is; an empty table
gives an empty one; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_chars, free_name, or_empty

POWERS = 4
LEAST = 6
STRETCH = 1 << 16
KEPT_POWERS = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPREAD = np.uint64(0xD6E8FEB86659FD93)
Run = tuple[int, int, int]
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Catchers:
    """Catches squares as words are appended; words are given as numbers, equal for equal words.

    ``longest``: a length that no run exceeds, where one is known.
    """

    def __init__(self, powers: int = POWERS, least: int = LEAST, longest: int | None = None):
        if powers < 2:
            raise ValueError("a run has at least two periods")
        self.powers, self.least, self.longest = powers, least, longest
        self.n = 0
        self._words = np.zeros(64, dtype=np.int64)
        self._sums = np.zeros(65, dtype=np.uint64)  # hash of all words before each place
        self._run_at = np.full(64, -1, dtype=np.int32)  # a found run that holds the word
        self._starts: list[int] = []
        self._unmarked: list[bool] = []
        self._ends = np.zeros(64, dtype=np.int64)
        self._periods = np.ones(64, dtype=np.int64)
        self._last: dict[int, int] = {}  # by period the run found last
        self._open: set[int] = set()

    def append(self, words: np.ndarray) -> None:
        """Words that follow those given so far."""
        for i in range(0, len(words), STRETCH):
            self._append(np.asarray(words[i : i + STRETCH], dtype=np.int64))

    def runs(self) -> list[Run]:
        """Start, length and period of the runs of the words so far, by start, then period."""
        least: dict[tuple[int, int], int] = {}
        for run, start in enumerate(self._starts):
            end, period = int(self._ends[run]), int(self._periods[run])
            if end - start >= max(self.least, self.powers * period):
                ends = (start, end)
                least[ends] = min(period, least.get(ends, period))
        return sorted((s, e - s, q) for (s, e), q in least.items())

    def _append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        self._words = _room(self._words, self.n, 0)
        self._sums = _room(self._sums, self.n + 1, 0)
        self._run_at = _room(self._run_at, self.n, -1)
        self._words[old : self.n] = words
        with np.errstate(over="ignore"):
            self._hash(old, words)
            for run in list(self._open):
                self._extend(run)
            level, longest = 0, self.n if self.longest is None else min(self.longest, self.n)
            while (self.powers - 1) * ((2 << level) - 1) + (1 << level) <= longest:
                self._catch(level, old)
                level += 1

    def _hash(self, old: int, words: np.ndarray) -> None:
        mixed = (words.astype(np.uint64) + np.uint64(1)) * SPREAD
        mixed ^= mixed >> np.uint64(32)
        mixed *= SPREAD
        mixed ^= mixed >> np.uint64(29)
        sums = np.cumsum(mixed * table_of(BASE, self.n)[old : self.n])
        self._sums[old + 1 : self.n + 1] = self._sums[old] + sums

    def _catch(self, level: int, old: int) -> None:
        """Compares the suffixes that end in the words from ``old`` on with their catchers.

        The suffix at 2 * size - 1 + t meets the catchers of the blocks with the numbers t // size
        and t // size - 1.
        """
        size = 1 << level
        first = max(old - size + 1 - (2 * size - 1), 0)  # of the suffixes that are new
        begin = max((first >> level) - 1, 0) << level  # of the blocks
        sums = self._sums[begin : self.n + 1]
        hashes = sums[size:] - sums[:-size]
        hashes *= table_of(INVERSE, self.n + 1)[begin : begin + len(hashes)]
        suffixes = hashes[2 * size - 1 :]
        catchers = np.repeat(hashes[: len(suffixes) : size], size)[: len(suffixes)]
        found, periods = [], []
        for earlier in (0, size):
            t = earlier + np.flatnonzero(suffixes[earlier:] == catchers[: max(len(suffixes) - earlier, 0)])
            block = ((t >> level) << level) - earlier
            here = t + 2 * size - 1
            period = here - block
            kept = (t + begin >= first) & (block + begin >= (self.powers - 2) * period)
            block, period, here = block[kept] + begin, period[kept], here[kept] + begin
            for _ in range(self.powers - 2):
                before = block - period
                same = self._same(before, block, size)
                here, block, period = here[same], before[same], period[same]
            known = self._run_at[here - period]
            inside = (known >= 0) & (period % self._periods[known] == 0)
            inside &= here + size <= self._ends[known]
            found.append(here[~inside])
            periods.append(period[~inside])
        here, period = np.concatenate(found), np.concatenate(periods)
        order = np.lexsort((here, period))
        last, end = 0, 0
        for j, q in zip(here[order].tolist(), period[order].tolist()):
            if q != last or j + size > end:
                last, end = q, self._square(j, q, size)

    def _same(self, left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
        """Whether the ``size`` words at two places, the left one first, have one hash."""
        x = self._sums[left + size] - self._sums[left]
        y = self._sums[right + size] - self._sums[right]
        return x * table_of(BASE, self.n + 1)[right - left] == y

    def _square(self, at: int, period: int, size: int) -> int:
        """A suffix at ``at`` that equals the words ``period`` before it: the end of their run."""
        last = self._last.get(period, -1)
        if last >= 0 and at + size <= self._ends[last] and at - period >= self._starts[last]:
            return int(self._ends[last])
        over = int(self._run_at[at - period])
        if over >= 0 and period % self._periods[over] == 0 and at + size <= self._ends[over]:
            return int(self._ends[over])
        if not np.array_equal(self._words[at : at + size], self._words[at - period : at - period + size]):
            return 0
        start = at - period - self._equal_before(at - period, at)
        run = len(self._starts)
        self._starts.append(start)
        self._unmarked.append(True)
        if run >= len(self._ends):
            self._ends = _room(self._ends, run + 1, 0)
            self._periods = _room(self._periods, run + 1, 1)
        self._periods[run], self._ends[run] = period, at + size
        self._last[period] = run
        self._extend(run)
        return int(self._ends[run])

    def _extend(self, run: int) -> None:
        """The run as far as the words so far go on with its period."""
        period, end = int(self._periods[run]), int(self._ends[run])
        more, step = end, 64
        while more < self.n:
            x = self._words[more : min(more + step, self.n)]
            y = self._words[more - period : more - period + len(x)]
            differ = np.flatnonzero(x != y)
            if len(differ):
                more += int(differ[0])
                break
            more += len(x)
            step *= 2
        self._ends[run] = more
        self._mark(run, end, more)
        (self._open.add if more == self.n else self._open.discard)(run)

    def _equal_before(self, left: int, right: int) -> int:
        """How many words before two places are equal."""
        done, step = 0, 64
        while done < left:
            take = min(step, left - done)
            x = self._words[left - done - take : left - done]
            y = self._words[right - done - take : right - done]
            differ = np.flatnonzero(x != y)
            if len(differ):
                return done + take - 1 - int(differ[-1])
            done += take
            step *= 2
        return done

    def _mark(self, run: int, before: int, end: int) -> None:
        """Notes the run, which ended at ``before``, at its words, but where they have one of a
        smaller period."""
        start, long_enough = self._starts[run], self.powers * self._periods[run]
        if end - start < long_enough:
            return
        part = self._run_at[start if self._unmarked[run] else before : end]
        self._unmarked[run] = False
        part[(part < 0) | (self._periods[part] > self._periods[run])] = run


_TABLES: dict[int, np.ndarray] = {}


def table_of(base: np.uint64, size: int) -> np.ndarray:
    """The first powers of a number, at least ``size`` of them; kept, as all texts need the same."""
    table = _TABLES.get(int(base))
    if table is not None and len(table) >= size:
        return table
    table = np.ones(1, dtype=np.uint64) if table is None else table
    with np.errstate(over="ignore"):
        while len(table) < size:
            table = np.concatenate((table, table * (table[-1] * base)))
    if len(table) <= KEPT_POWERS:
        _TABLES[int(base)] = table
    return table


def _room(array: np.ndarray, size: int, fill: int) -> np.ndarray:
    """The array, or one of twice the size or more if it has no room for ``size``."""
    if size <= len(array):
        return array
    more = np.full(max(size, 2 * len(array)) - len(array), fill, dtype=array.dtype)
    return np.concatenate((array, more))


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))


def runs_of(texts: list[np.ndarray], powers: int = POWERS, least: int = LEAST) -> list[list[Run]]:
    """Start, length and period of the runs of each text, by start, then period.

    Texts are appended one after the other, so that short ones share the work of a stretch, with
    numbers between them that no word and no other gap has.
    """
    out: list[list[Run]] = []
    for part in by_chars(texts, STRETCH):
        catchers = Catchers(powers, least, max(map(len, part)))
        gaps = [np.array([-1 - i], dtype=np.int64) for i in range(len(part))]
        catchers.append(np.concatenate([x for pair in zip(part, gaps) for x in pair]))
        begins = np.cumsum([0, *(len(t) + 1 for t in part)])
        found: list[list[Run]] = [[] for _ in part]
        for start, length, period in catchers.runs():
            text = int(np.searchsorted(begins, start, side="right")) - 1
            found[text].append((start - int(begins[text]), length, period))
        out += found
    return out


def repeats(n: int, runs: list[Run]) -> np.ndarray:
    """Per word whether some run holds it after that run's first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) > 0


def first_periods(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by blanks, each run cut to its first period."""
    if not runs:
        return b" ".join(words)
    gone = repeats(len(words), runs)
    return b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])


def made_periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, or for one id in ten their first part and then repeats of a piece of them."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a : a + p]
    return words[:a] + (piece * -(-(n - a) // len(piece)))[: n - a]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact exponent; of ties the first, then the shortest period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _words(text: str) -> list[bytes]:
    """What blanks, tabs, line ends, vertical tabs and form feeds leave between them."""
    return text.encode("utf-8", "replace").split()


def periodic_runs(text: Column | str, powers: int = POWERS, least: int = LEAST) -> Column:
    """The runs of a text's words: an array of starts, lengths and periods; null as empty."""

    @F.pandas_udf(RUNS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for texts in by_chars(batch):
                runs = runs_of([numbered(_words(t)) for t in texts], powers, least)
                named = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                yield pd.Series(named, dtype=object)

    return found.asNondeterministic()(or_empty(text))


def collapsed(docs: DataFrame, text: str = "text", powers: int = POWERS, least: int = LEAST) -> DataFrame:
    """``docs`` with each run cut to its first period; words are then joined by single blanks.

    A text without a run stays as it is, null included.
    """

    @F.pandas_udf("string")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for texts in by_chars(batch):
                words = [_words(t) for t in texts]
                runs = runs_of([numbered(w) for w in words], powers, least)
                new = [first_periods(w, r).decode("utf-8") if r else None for w, r in zip(words, runs)]
                yield pd.Series(new, dtype=object)

    name = free_name(docs, "cut")
    made = docs.withColumn(name, cut.asNondeterministic()(or_empty(docs[f"`{text}`"])))
    new = F.coalesce(F.col(name), F.col(f"`{text}`")).alias(text)
    return made.select(*[new if c == text else F.col(f"`{c}`") for c in docs.columns])


DIGEST = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _digest(words: list[bytes], runs: list[Run]) -> tuple:
    best = strongest(runs)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(first_periods(words, runs)).hexdigest(),
    )


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document the number of its runs, the strongest one, and digests of all runs and of the
    words that are left; one id in ten has its words made periodic first."""
    columns = [c.split()[0] for c in DIGEST.split(", ")]

    @F.pandas_udf(DIGEST)
    def digest(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, batch in batches:
            begin = 0
            for texts in by_chars(batch):
                names = ids.iloc[begin : begin + len(texts)]
                begin += len(texts)
                words = [
                    made_periodic(_words(t), None if i is None else int(i)) for i, t in zip(names, texts)
                ]
                rows = map(_digest, words, runs_of([numbered(w) for w in words]))
                found = pd.DataFrame(rows, columns=columns)
                numbers = {c: "Int64" for c in columns[:5]}
                yield found.astype(numbers)

    # The id goes as text: a column of numbers with nulls would arrive as floating point.
    name = F.col("doc_id").cast("long").cast("string")
    found = docs.select("doc_id", digest.asNondeterministic()(name, or_empty("text")).alias("found"))
    return found.select("doc_id", "found.*")
