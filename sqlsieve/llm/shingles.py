"""Sets of word shingles as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import hashlib

import numpy as np

MULTIPLIER = 0x9FB21C651E98DF25
_INVERSE = pow(MULTIPLIER, -1, 1 << 64)
_STEP = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, size: int) -> np.ndarray:
    out = np.empty(size, dtype=np.uint64)
    out[0], done = 1, 1
    factor = np.uint64(base)
    while done < size:
        take = min(done, size - done)
        out[done : done + take] = out[:take] * factor
        factor = factor * factor
        done += take
    return out


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, A-Z lower-cased, and the number of words of each text.

    Words are what blanks, tabs, line ends, vertical tabs and form feeds leave between them.
    """
    parts = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(parts).lower() + b"\n", dtype=np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1
    begins = np.concatenate(([0], np.cumsum(sizes)))
    counts = np.diff(np.searchsorted(starts, begins))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    # Polynomial hashes from one running sum per stretch: (sum up to end - sum up to start) / b**start.
    with np.errstate(over="ignore"):
        letters = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x1234567))[data]
        up = _powers(MULTIPLIER, _STEP)
        down = _powers(_INVERSE, _STEP)
        place = np.arange(len(data), dtype=np.int64) & (_STEP - 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(letters * up[place], out=sums[1:])
        within = (starts // _STEP) == ((ends - 1) // _STEP)
        hashes = (sums[ends] - sums[starts]) * down[place[starts]]
        for i in np.flatnonzero(~within):  # a word over the end of a stretch
            word = letters[starts[i] : ends[i]]
            powers = up if len(word) <= _STEP else _powers(MULTIPLIER, len(word))
            hashes[i] = np.sum(word * powers[: len(word)], dtype=np.uint64)
        return mix(hashes + (ends - starts).astype(np.uint64)), counts


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``width`` words.

    A text of fewer words has its whole sequence as its only shingle, one without words none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    out = []
    with np.errstate(over="ignore"):
        n = max(len(words) - width + 1, 0)
        rolled = np.zeros(n, dtype=np.uint64)
        for i in range(width):
            rolled = mix(rolled + words[i : i + n] + np.uint64(i + 1))
        for end, count in zip(ends.tolist(), counts.tolist()):
            if count >= width:
                out.append(np.unique(rolled[end - count : end - width + 1]))
            elif count:
                short = np.zeros(1, dtype=np.uint64)
                for i, word in enumerate(words[end - count : end]):
                    short = mix(short + word + np.uint64(i + 1))
                out.append(mix(short + np.uint64(count << 40)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_key(found: np.ndarray) -> bytes:
    """A 128-bit name of a set."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()
