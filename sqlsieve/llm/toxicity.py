"""Toxicity scores from a linear classifier over character n-grams.

The features are the presence of character n-grams of several lengths in the lower-cased text,
hashed into a fixed number of buckets; those that both classes have about as often are left out.
Each is scaled by its naive Bayes log-count ratio, how much
likelier it is in toxic training texts than in others, and a logistic regression is fitted on the
scaled features. The n-grams of a text say nothing about its length, language or source.

Training uses at most ``MAX_ROWS`` labelled texts of each class, those with the smallest hash of
their id, read whole. Of the rows of one id the text with the smallest hash is taken, on the
executors. Features are found and counted on the executors; those that tell the classes apart come to
the driver, where the weights are fitted. Its memory is bounded by that number times ``BUCKETS``, as a
text has each bucket once at most. The model is one array of ``BUCKETS`` numbers, whatever the size of the corpus. Scoring reads whole
texts in one pass without a shuffle.

Rows: a null text is an empty one and gets the score of a text without n-grams; rows without id
are scored and never trained on; repeated labels of an id count once, as toxic if any is; without
labels of both classes every score is the share of toxic labels, or 0 without any label; an empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, free_name, or_empty, others, stored

LENGTHS = (4, 5)
BUCKETS = 1 << 19
MAX_ROWS = 1_200
LEAST_TEXTS = 4
LEAST_RATIO = 0.7
ROUNDS = 40
PENALTY = 1.0
SMALLEST = 0.05
FEATURES_AT_ONCE = 1 << 18  # of so many features, or of one text, sums are made together


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per n-gram length the bucket at each character of the joined texts, and the texts' starts.

    Texts are set apart by characters that no n-gram spans, so nothing of one reaches another.
    """
    gap = "\0" * max(LENGTHS)
    texts = [t.lower() for t in texts]
    joined = gap.join(texts) + gap
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + len(gap)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    value = codes * np.uint32(0x9E3779B1)
    value ^= value >> np.uint32(15)
    for length in range(2, max(LENGTHS) + 1):
        # value[i] stands for the characters i, ..., i + length - 1
        value = value[:-1] * np.uint32(0x85EBCA6B)
        value += codes[length - 1 :]
        value ^= value >> np.uint32(13)
        if length in LENGTHS:
            mixed = value * np.uint32(0x2C1B3C6D + 2 * length)
            mixed >>= np.uint32(32 - BUCKETS.bit_length() + 1)
            yield mixed, starts


def features(text: str) -> np.ndarray:
    """Distinct buckets of a text."""
    if not text:
        return np.zeros(0, dtype=np.int32)
    found = [b[: starts[1] - max(LENGTHS)] for b, starts in grams([text])]
    return np.unique(np.concatenate(found)).astype(np.int32)


def linear(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Per text the sum of the weights of its distinct buckets."""
    keys, heavy = [], weights != 0
    for buckets, starts in grams(texts):
        at = np.flatnonzero(heavy[buckets])
        owner = np.searchsorted(starts, at, side="right") - 1
        keys.append((owner << np.int64(32)) | buckets[at])
    key = np.unique(np.concatenate(keys))
    sums = np.bincount(key >> 32, weights=weights[key & 0xFFFFFFFF], minlength=len(texts))
    return sums[: len(texts)]


def ratios(counts: np.ndarray, bad: np.ndarray, n_toxic: int, n_rest: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that tell the classes apart, and their log-count ratios.

    ``counts`` and ``bad``: per bucket the training texts, and the toxic ones, that have it.
    """
    ratio = np.log((bad + 1.0) / (n_toxic + 2.0))
    ratio -= np.log((counts - bad + 1.0) / (n_rest + 2.0))
    used = np.flatnonzero((counts >= LEAST_TEXTS) & (np.abs(ratio) >= LEAST_RATIO))
    return used, ratio[used]


def fit(rows: list[np.ndarray], toxic: np.ndarray, share: float) -> tuple[np.ndarray, float]:
    """Weights per bucket and the intercept; ``share`` of the texts outside are toxic.

    Beside the numbers of all features there are only tables of a few texts at a time.
    """
    bad, counts = np.zeros(BUCKETS, dtype=np.int32), np.zeros(BUCKETS, dtype=np.int32)
    for row, marked in zip(rows, toxic):
        counts[row] += 1
        if marked:
            bad[row] += 1
    used, ratio = ratios(counts, bad, toxic.sum(), (~toxic).sum())
    number = np.full(BUCKETS, -1, dtype=np.int32)
    number[used] = np.arange(len(used))
    found = [n[n >= 0] for n in (number[row] for row in rows)]
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    column = np.concatenate(found)
    del found, number, counts, bad
    ends = np.cumsum(sizes)
    cuts = np.flatnonzero(np.diff((ends - 1) // FEATURES_AT_ONCE)) + 1
    bounds = [0, *cuts.tolist(), len(rows)]
    parts = [(i, j, column[ends[i] - sizes[i] : ends[j - 1]]) for i, j in zip(bounds, bounds[1:])]

    def per_text(values: np.ndarray, power: int = 1) -> np.ndarray:
        """Sums of the values of each text's features."""
        out = np.empty(len(rows))
        for i, j, columns in parts:
            owner = np.repeat(np.arange(j - i), sizes[i:j])
            out[i:j] = np.bincount(owner, weights=values[columns] ** power, minlength=j - i)
        return out

    def per_feature(values: np.ndarray) -> np.ndarray:
        """Sums of the values of each feature's texts, in their order."""
        out = np.zeros(len(used))
        for i, j, columns in parts:
            np.add.at(out, columns, np.repeat(values[i:j], sizes[i:j]))
        return out

    # Each class counts as its share, and a text by its features' total scale.
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    target = toxic.astype(float)
    step = 4.0 / (np.median(per_text(ratio, 2)) + 1.0)
    slope, base = np.zeros(len(used)), float(np.log(share / (1 - share)))
    momentum, last = slope.copy(), 1.0
    for _ in range(ROUNDS):
        score = per_text(momentum * ratio) + base
        error = weight * (1 / (1 + np.exp(-score)) - target)
        gradient = per_feature(error) * ratio
        new = momentum - step * (gradient / len(rows) * 50 + PENALTY / len(rows) * momentum)
        following = (1 + np.sqrt(1 + 4 * last * last)) / 2
        momentum = new + (last - 1) / following * (new - slope)
        slope, last = new, following
        base -= 0.5 * error.mean()
    out = np.zeros(BUCKETS)
    out[used] = np.where(np.abs(slope * ratio) >= SMALLEST, slope * ratio, 0.0)
    return out, base


def held_out(doc_id: Column) -> Column:
    """Ids that are never trained on: crc32 of the decimal id is a multiple of five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS):
    """The weights and the intercept from the labelled documents that are not held out."""
    marks = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(~held_out(F.col("doc_id")))
    )
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy(F.expr("toxic = 1 as toxic")).agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    if len(sizes) < 2:
        return np.zeros(BUCKETS), (float("-inf") if not sizes.get(True) else float("inf"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    part = [min(1.0, 0.9 * max_rows / sizes[k]) for k in (False, True)]
    chosen = marks.where(place < F.when(F.col("toxic") == 1, part[1]).otherwise(part[0]))
    texts = docs.select("doc_id", or_empty("text").alias("body"))
    # Partial results leave one text of an id for each task, so that no id is a hot key.
    own = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.struct(F.xxhash64("body"), "body"))["body"].alias("body"))
    )

    rows = stored(own.mapInPandas(_featured, "doc_id long, toxic boolean, f binary"), "features")
    try:
        tally = rows.mapInPandas(_tally, "bucket int, n long, bad long").groupBy("bucket")
        tally = tally.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        tally = tally.where((F.col("n") >= LEAST_TEXTS) | (F.col("bucket") == BUCKETS)).toPandas()
        counts, bad = np.zeros((2, BUCKETS + 1), dtype=np.int64)
        counts[tally["bucket"]], bad[tally["bucket"]] = tally["n"], tally["bad"]
        n_toxic, n_rest = int(bad[-1]), int(counts[-1] - bad[-1])
        if not n_toxic or not n_rest:
            return np.zeros(BUCKETS), float(np.log(sizes[True] / sizes[False]))
        useful = np.zeros(BUCKETS, dtype=bool)
        useful[ratios(counts[:-1], bad[:-1], n_toxic, n_rest)[0]] = True
        del tally, counts, bad
        # What no weight can come of stays on the executors.
        sent = docs.sparkSession.sparkContext.broadcast(np.packbits(useful))

        def only_useful(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            table = np.unpackbits(sent.value).astype(bool)
            for part in batches:
                found = (np.frombuffer(f, dtype=np.int32) for f in part["f"])
                yield part.assign(f=[f[table[f]].tobytes() for f in found])

        rows_left = rows.mapInPandas(only_useful, rows.schema).toPandas()
    finally:
        drop_stored(rows)
    rows_left = rows_left.sort_values("doc_id", kind="stable")
    found = [np.frombuffer(f, dtype=np.int32) for f in rows_left["f"]]
    return fit(found, rows_left["toxic"].to_numpy(), sizes[True] / total)


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        found = [features(t).tobytes() for t in rows["body"]]
        yield pd.DataFrame({"doc_id": rows["doc_id"], "toxic": rows["toxic"] == 1, "f": found})


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per bucket the texts and the toxic ones that have it; ``BUCKETS`` stands for one that all have."""
    counts, bad = np.zeros((2, BUCKETS + 1), dtype=np.int64)
    for rows in batches:
        for f, marked in zip(rows["f"], rows["toxic"]):
            row = np.frombuffer(f, dtype=np.int32)
            for table in (counts, bad) if marked else (counts,):
                table[row] += 1
                table[-1] += 1
    at = np.flatnonzero(counts)
    yield pd.DataFrame({"bucket": at.astype(np.int32), "n": counts[at], "bad": bad[at]})


def score(docs: DataFrame, model: tuple[np.ndarray, float], name: str = "score") -> DataFrame:
    """``docs`` with the chance, by the model, that a text is toxic."""
    weights, base = model
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = sent.value.astype(np.float64)
        for texts in batches:
            if not np.isfinite(base):  # one class alone: all texts are of it
                yield pd.Series(np.full(len(texts), float(base > 0)))
                continue
            texts, begin, sums = list(texts), 0, []
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and (end == begin or chars < 1_000_000):
                    chars += len(texts[end])
                    end += 1
                sums.append(linear(texts[begin:end], known))
                begin = end
            total = np.concatenate(sums) if sums else np.zeros(0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(total + base, -700, 700))))

    return docs.select(
        *others(docs, name), scored.asNondeterministic()(or_empty("text")).alias(name)
    )


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Per document its score and whether it is 0.5 or more."""
    model = train(docs, labels, max_rows)
    scored = score(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents that score below 0.5, with their columns."""
    name = free_name(docs, "score")
    scored = score(docs, train(docs, labels, max_rows), name)
    return scored.where(F.col(name) < 0.5).drop(name)
