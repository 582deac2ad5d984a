"""How far sources of one language differ in their terms: a sparse merge for each pair of sources.

Terms are what ASCII characters other than letters leave between them, A-Z lower-cased. A language
keeps the terms that at least ``least_docs`` of its documents have. Each (lang, source) group, and
each language as a whole, gives each kept term the smoothed share
``1 + floor(10**9 * (count + 5) / (N + 5 V))``, N being its occurrences of kept terms and V the
number of these. The distance of two groups is the sum of the differences of their shares over all
kept terms; a group's telling terms are those with greater shares than in the language.

1. Workers count terms into tables of bounded size, and Spark adds up what they hand on.
2. Kept terms get numbers within blocks of the vocabulary, so that no array grows with it. Each group
   has per block its (term number, count) pairs as two arrays sorted by number.
3. Each unordered pair of groups is a task per block: the two groups' arrays are co-grouped there,
   the shorter looks its terms up in the longer by a galloping search, and overlaps and terms of one
   side only are priced. Terms that both lack are priced together once the blocks are added up, as
   all of them differ by the same amount. A pair's sum holds both ways.

All numbers are whole: the quotients are worked out three decimal digits at a time in 64 bits, which
holds for up to 9 * 10**15 occurrences.

Rows: null texts, languages and sources count as empty ones, and an empty language is one like any
other; groups without terms are compared like others; repeated rows count as often as they are there;
an empty table gives an empty one; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stored, or_empty, stored

LEAST_DOCS = 30
TOP = 50
BLOCK = 1 << 16
HELD_TERMS = 400_000
SMOOTHING = 5
SCALE_STEPS = 3  # of 1,000 each
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
GROUP = "lang string, source string"


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_KEEP).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences and ``docs`` with it, of every group."""

    def handed(held: dict[tuple[str, str], list[Counter]]) -> Iterator[pd.DataFrame]:
        for (lang, source), (total, having) in held.items():
            if not total:
                continue
            yield pd.DataFrame(
                {
                    "lang": lang, "source": source,
                    "term": [t.decode("utf-8") for t in total],
                    "n": list(total.values()), "docs": [having[t] for t in total],
                }
            )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], list[Counter]] = {}
        size = 0
        for rows in batches:
            for lang, source, text in zip(rows["lang"], rows["source"], rows["text"]):
                found = Counter(terms_of(text))
                total, having = held.setdefault((lang, source), [Counter(), Counter()])
                size -= len(total)
                total.update(found)
                having.update(found.keys())
                size += len(total)
                if size > HELD_TERMS:
                    yield from handed(held)
                    held, size = {}, 0
        yield from handed(held)

    rows = docs.select(*(or_empty(c).alias(c) for c in ("lang", "source", "text")))
    made = rows.mapInPandas(count, f"{GROUP}, term string, n long, docs long")
    return made.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count, total, terms):
    """``1 + floor(10**9 * (count + 5) / (total + 5 * terms))``, as columns or arrays of numbers."""
    rest, whole = count + SMOOTHING, total + SMOOTHING * terms
    out = rest * 0
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        digits = _divided(rest, whole)
        rest = rest - digits * whole
        out = out * 1000 + digits
    return out + 1


def _divided(x, y):
    if not isinstance(x, Column):
        return x // y
    return F.call_function("div", x, y)


def merged(
    left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray],
    totals: tuple[int, int], terms: int,
) -> tuple[int, int]:
    """Sum of the differences over the terms that either side has, and how many these are.

    Each side is its sorted term numbers and their counts.
    """
    if len(left[0]) > len(right[0]):
        left, right, totals = right, left, totals[::-1]
    (ids, counts), (long_ids, long_counts) = left, right
    shares = share(counts, totals[0], terms)
    long_shares = share(long_counts, totals[1], terms)
    none, long_none = (int(share(0, t, terms)) for t in totals)
    at = gallop(ids, long_ids)
    both = np.zeros(len(ids), dtype=bool)
    there = at < len(long_ids)
    both[there] = long_ids[at[there]] == ids[there]
    met = at[both]
    total = int(np.abs(shares[both] - long_shares[met]).sum())
    total += int(np.abs(shares[~both] - long_none).sum())
    only = np.ones(len(long_ids), dtype=bool)
    only[met] = False
    total += int(np.abs(long_shares[only] - none).sum())
    return total, len(ids) + len(long_ids) - len(met)


def gallop(ids: np.ndarray, among: np.ndarray, step: int = 1_024) -> np.ndarray:
    """Where in ``among`` each of the sorted ``ids`` is or would be.

    ``step`` of them go on together from where the last ones ended: the reach is doubled until it is
    past them, and only that part is searched.
    """
    out, start = [np.zeros(0, dtype=np.int64)], 0
    for i in range(0, len(ids), step):
        part, reach = ids[i : i + step], step
        while start + reach < len(among) and among[start + reach - 1] < part[-1]:
            reach *= 2
        out.append(start + np.searchsorted(among[start : start + reach], part))
        start = int(out[-1][-1])
    return np.concatenate(out)


def _side(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of a group in a block, which has them in one row or none."""
    names = ("ids", "counts")
    first = [rows[c].iloc[0] if len(rows) else [] for c in names]
    return tuple(np.asarray(x, dtype=np.int64) for x in first)


def pair_sums(blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per pair of groups ``priced`` and ``either``, over the terms that either has.

    ``blocks``: a group's sorted arrays per block. ``pairs``: ``lang, a, b`` with what is the same
    for all blocks, the totals ``n_a`` and ``n_b`` and the number of kept terms ``v``.
    """

    def price(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = (left if len(left) else right).iloc[0]
        found = merged(_side(left), _side(right), (int(row["n_a"]), int(row["n_b"])), int(row["v"]))
        return pd.DataFrame([(row["lang"], row["a"], row["b"], *found)], columns=columns)

    columns = ["lang", "a", "b", "priced", "either"]
    keys = ["lang", "a", "b", "block"]

    def side(name: str) -> DataFrame:
        own = blocks.select("lang", F.col("source").alias(name), "block", "ids", "counts")
        own = pairs.join(own, ["lang", name]).select("lang", "a", "b", "n_a", "n_b", "v", "block", "ids", "counts")
        return own.toDF(*own.columns)  # columns of its own on each side

    left, right = side("a").groupBy(keys), side("b").groupBy(keys)
    found = left.cogroup(right).applyInPandas(price, "lang string, a string, b string, priced long, either long")
    return found.groupBy("lang", "a", "b").agg(F.sum("priced").alias("priced"), F.sum("either").alias("either"))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other sources of a group by
    distance, the most distant first; part ``term`` the group's most telling terms up to ``top``.

    Counted terms are kept as tables in the shared folder, which stay as long as the result is used.
    """
    groups = stored(docs.select(*(or_empty(c).alias(c) for c in ("lang", "source"))).distinct(), "groups")
    counted = stored(term_counts(docs), "term-counts")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= least_docs).drop("docs")
    # Blocks by hash, as many as keep each within bounds; numbers by order within a block.
    sized = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total"))
    sized = stored(sized, "kept-sizes")
    n_blocks = F.ceil(F.col("v") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("term"), n_blocks).cast("int").alias("block")
    kept = kept.join(sized, "lang").select("*", block)
    number = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))
    kept = stored(kept.withColumn("id", number.cast("long")), "kept-terms")
    rows = stored(counted.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    drop_stored(counted, kept)

    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    sides = groups.join(totals, ["lang", "source"], "left").fillna(0, ["n_group"])
    sides = stored(sides.join(sized.drop("total"), "lang", "left").fillna(0, ["v"]), "sides")

    blocks = rows.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("t"))
    blocks = blocks.select("lang", "source", "block", F.col("t.id").alias("ids"), F.col("t.n").alias("counts"))
    a = sides.select("lang", F.col("source").alias("a"), F.col("n_group").alias("n_a"), "v")
    b = sides.select("lang", F.col("source").alias("b"), F.col("n_group").alias("n_b"))
    pairs = a.join(b, "lang").where("a < b")
    sums = pairs.join(pair_sums(stored(blocks, "term-blocks"), pairs), ["lang", "a", "b"], "left")
    lacking = F.col("v") - F.coalesce("either", F.lit(0))
    v = F.greatest("v", F.lit(1))  # without kept terms nothing is summed
    zero = F.lit(0).cast("long")
    apart = F.abs(share(zero, F.col("n_a"), v) - share(zero, F.col("n_b"), v))
    value = F.coalesce("priced", zero) + lacking * apart
    sums = sums.select("lang", "a", "b", value.alias("value"))
    pair = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        sums.select("lang", "b", "a", "value")
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))

    own = rows.join(sides.select("lang", "source", "n_group"), ["lang", "source"])
    ahead = share(F.col("n"), F.col("n_group"), F.col("v")) - share(F.col("n_lang"), F.col("total"), F.col("v"))
    telling = own.select("lang", "source", F.col("term").alias("item"), ahead.alias("value")).where("value > 0")
    term = telling.withColumn("rank", rank).where(F.col("rank") <= top)
    term = term.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pair.union(term)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
w AS (SELECT i, lang, source, unnest(terms) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT i) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::HUGEINT AS n_lang FROM c GROUP BY lang, term HAVING sum(docs) >= 30),
s AS (SELECT lang, count(*)::HUGEINT AS v, sum(n_lang)::HUGEINT AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n_lang, s.v, s.total,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS n_group
  FROM g JOIN k USING (lang) JOIN s USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (
  SELECT lang, source, term, n,
    (1 + (1000000000 * (n + 5)) // (n_group + 5 * v))::BIGINT AS p,
    (1 + (1000000000 * (n_lang + 5)) // (total + 5 * v))::BIGINT AS q
  FROM x),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  ) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
telling AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM telling))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
