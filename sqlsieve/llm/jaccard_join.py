"""Exact Jaccard join of documents on word shingles, as a grouped prefix join.

Two documents link when the sets of their word shingles overlap by at least a given share of
their union. In any one order of all shingles, two linking sets have a shingle in common among
the first few of each, their prefixes. The order here puts rare shingles first, so a passage that
very many documents share is in a prefix only where there is little else.

1. Equal sets become one class; classes with identical prefixes and sizes become one group.
2. A posting list per prefix shingle brings groups together. Pairs of groups are filtered by their
   sizes and by the places of the shingle in both; then groups are expanded, and pairs of members
   are filtered by a 512-bit sketch of each set, whose differing bits are no more than the shingles
   that differ.
3. Of the pairs that pass in a list a spanning forest is verified against the whole sets. Links are
   merged into components, and the next round looks for pairs that pass, are not yet connected and
   have not failed, until there are none; from the second round on a few spare pairs for each
   member go with the forest. So each list gives a few pairs a round for each of its members, not
   their square, and no link between components is missed.

Long posting lists are cut into blocks, and each pair of blocks is a list of its own; large groups
are cut into parts. A list whose members are connected already is not looked at again.

The order comes from exact counts of the first 48 bits of each shingle's hash. Texts are cut into
chunks of bounded size, with equal sets of a chunk once. Each chunk sends its distinct shingles to
buckets of their hashes, a shingle that several of its sets have as one entry with their number, so
a shingle of very many documents comes to its bucket once a chunk; back go the counts above one.
What no other set has needs no list, and a set with more shingles of its own than its prefix is long
is in none. Whole sets are larger than the texts and are not written: a pass over the texts writes
names, sizes and sketches, a second one sends the chunks. Sets that later steps need, once sketches
as wide as the sets have ruled out what they can, come from their texts, which buckets of their hashes,
of a fixed number, and an exact join choose. A task that runs again must find the same rows, so documents that are
not read from a table should be written to one first.

Sets hold 64-bit hashes of shingles; two different shingles of a pair of documents are taken as the
same with a chance of less than one in 10**10.

Rows: a null or empty text, or one without words, has an empty set, links with nothing and is a
component by itself; equal texts link whatever their ids; rows without id are classed like
others, and a component's id is the least id in it, null if there is none; repeated rows give
repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_chars, drop_stored, free_name, or_empty, stored, trim, trimmed
from .components import components, merged
from .shingles import mix, set_key, shingle_sets

BITS = 512
LIST_BLOCK = 1_000
SPARES = 4
PAIRS_AT_ONCE = 256  # pairs of whole sets that go to Python together
FOREST_PAIRS = 200_000  # pairs that are put in order together
GROUP_PART = 64
BUCKETS = 1 << 20
TEXTS_AT_ONCE = 1 << 10  # texts that go to Python together
CHARS_AT_ONCE = 1 << 18  # characters whose shingles are made together
CHUNK_ROWS = 1 << 13
CHUNK_SHINGLES = 1 << 20
SEVERAL = 0xFFFF  # in place of the place of a set: several sets of the chunk have the shingle
ROW = (
    "doc_id long, h long, chunk long, place int, n long, key binary, bits binary, wide binary, "
    "found binary"
)
BLOB_NAMES = ["bucket", "chunk", "hashes", "places", "counts", "sizes", "keys"]
BLOB = "bucket long, chunk long, hashes binary, places binary, counts binary, sizes binary, keys binary"
PREFIX = "key binary, n long, skip long, g long, prefix array<long>"


def least_overlap(threshold: Fraction, sizes) -> int:
    """Least intersection with which sets of these total sizes link."""
    a, b = threshold.numerator, threshold.denominator
    return -(-a * sizes // (a + b))


def prefix_size(threshold: Fraction, n: int) -> int:
    return n - -(-threshold.numerator * n // threshold.denominator) + 1


def sketch(found: np.ndarray, bits: int = BITS) -> bytes:
    """Bit i is the parity of the number of shingles that hash to i. ``bits`` is a power of two."""
    place = (mix(found) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def wide_sketch(found: np.ndarray) -> bytes:
    """A sketch with two to four bits for each shingle."""
    return sketch(found, max(BITS, 2 << max(len(found) - 1, 0).bit_length()))


def differing(x: bytes, y: bytes) -> int:
    """Differing bits of two sketches; halves of the longer one are laid over each other."""
    x, y = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _described(width: int, whole: bool):
    """Names and sizes of sets and their places in chunks; with ``whole`` the sets, else sketches.

    ``found`` or ``wide`` is null where an earlier row of the chunk has the same set.
    """

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, seen, shingles = TaskContext.get().partitionId() << 32, set(), 0
        for rows in batches:
            begin = 0
            for texts in by_chars(rows["body"], CHARS_AT_ONCE):
                out = []
                for found in shingle_sets(texts, width):
                    n, key = len(found), set_key(found)
                    new = n > 0 and key not in seen
                    if new and seen and (len(seen) == CHUNK_ROWS or shingles + n > CHUNK_SHINGLES):
                        chunk, seen, shingles = chunk + 1, set(), 0
                    place = len(seen)
                    if new:
                        seen.add(key)
                        shingles += n
                    bits = None if whole else sketch(found)
                    wide = wide_sketch(found) if new and not whole else None
                    kept = found.tobytes() if new and whole else None
                    out.append((chunk, place, n, key, bits, wide, kept))
                names = ["chunk", "place", "n", "key", "bits", "wide", "found"]
                part = pd.DataFrame(out, columns=names)
                for place, name in enumerate(("doc_id", "h")):
                    part.insert(place, name, rows[name].iloc[begin : begin + len(texts)].array)
                begin += len(texts)
                yield part
        trim()

    return describe


def set_rows(docs: DataFrame, width: int, whole: bool = True) -> DataFrame:
    """Per document its set, or sketches of it, the set's size, name and place in a chunk."""
    return docs.mapInPandas(_described(width, whole), ROW)


def pack(tokens: np.ndarray) -> bytes:
    """Sorted tokens of 48 bits, their first bytes first, then their second ones: equal bytes lie together."""
    return tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].T.tobytes()


def unpack(packed: pd.Series) -> np.ndarray:
    """The tokens of several packs, in their order."""
    out = [np.zeros(0, dtype=np.uint64)]
    for pack in packed:
        rows = np.zeros((len(pack) // 6, 8), dtype=np.uint8)
        rows[:, 2:] = np.frombuffer(pack, dtype=np.uint8).reshape(6, -1).T
        out.append(rows.view(">u8").ravel().astype(np.uint64))
    return np.concatenate(out)


def _sent(width: int, buckets: int):
    """Cuts the distinct shingles of each chunk by bucket; what several sets have stays with it, too."""
    describe = _described(width, True)

    def part(chunk: int, rows: list[tuple[int, int, bytes, bytes]]) -> pd.DataFrame:
        places, sizes, keys, sets = zip(*rows)
        flat = np.frombuffer(b"".join(sets), dtype=np.uint64) >> np.uint64(16)
        place = np.repeat(np.array(places, dtype=np.uint16), sizes)
        order = np.argsort(flat, kind="stable")
        flat, place = flat[order], place[order]
        begin = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        count = np.diff(np.append(begin, len(flat)))
        several = np.repeat(count > 1, count)
        own = (
            chunk % buckets, chunk, pack(flat[several]), place[several].tobytes(), None,
            np.array([places, sizes], dtype=np.int64).tobytes(), b"".join(keys),
        )
        flat, place = flat[begin], np.where(count > 1, SEVERAL, place[begin]).astype(np.uint16)
        count = count.astype(np.uint32)
        bucket = ((flat >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() + [len(flat)]
        out = [own]
        for i, j in zip(cuts, cuts[1:]):
            more = count[i:j][place[i:j] == SEVERAL]  # the others are ones
            out.append(
                (int(bucket[i]), chunk, pack(flat[i:j]), place[i:j].tobytes(), more.tobytes(), None, None)
            )
        return pd.DataFrame(out, columns=BLOB_NAMES)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, kept = None, []
        for rows in describe(batches):  # in one worker with it, not in a second one beside it
            rows = rows[rows["found"].notna()]
            for chunk, *row in zip(rows["chunk"], rows["place"], rows["n"], rows["key"], rows["found"]):
                if kept and chunk != now:
                    yield part(now, kept)
                    kept = []
                now = chunk
                kept.append(row)
        if kept:
            yield part(now, kept)
            kept = []
        trim()

    return send


def _counted(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket the entries whose shingle several sets of the corpus have, with their number.

    What a chunk keeps for itself only passes through.
    """
    own = rows[rows["sizes"].notna()]
    rows = rows[rows["sizes"].isna()]
    hashes = unpack(rows["hashes"])
    if not len(hashes):
        return own
    places = np.frombuffer(b"".join(rows["places"]), dtype=np.uint16)
    counts = np.ones(len(hashes), dtype=np.int64)
    counts[places == SEVERAL] = np.frombuffer(b"".join(rows["counts"]), dtype=np.uint32)
    order = np.argsort(hashes)
    same = hashes[order]
    begin = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
    total = np.empty(len(hashes), dtype=np.int64)
    total[order] = np.repeat(np.add.reduceat(counts[order], begin), np.diff(np.append(begin, len(same))))
    total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
    ends = np.cumsum([len(p) // 2 for p in rows["places"]])
    out = []
    for chunk, end, size in zip(rows["chunk"], ends.tolist(), np.diff(ends, prepend=0).tolist()):
        at = np.flatnonzero(total[end - size : end] > 1) + end - size
        if len(at):
            out.append((0, chunk, pack(hashes[at]), places[at].tobytes(), total[at].tobytes(), None, None))
    return pd.concat([own, pd.DataFrame(out, columns=BLOB_NAMES)])


def _prefixes(threshold: Fraction):
    """Of one chunk the sets whose prefixes have shingles of other sets, and these, rarest first."""

    def joined(values: pd.Series, kind) -> np.ndarray:
        return np.frombuffer(b"".join(values), dtype=kind)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["sizes"].notna()
        about = [np.frombuffer(x, dtype=np.int64).reshape(2, -1) for x in rows["sizes"][own]]
        places, sizes = np.concatenate(about, axis=1)
        names = joined(rows["keys"][own], "V16")
        n = np.zeros(places.max() + 1, dtype=np.int64)
        key = np.zeros(len(n), dtype="V16")
        n[places], key[places] = sizes, names

        hashes, place = unpack(rows["hashes"][~own]), joined(rows["places"][~own], np.uint16)
        total = joined(rows["counts"][~own], np.uint32)
        several = place == SEVERAL
        known, first = np.unique(hashes[several], return_index=True)
        counts = total[several][first]
        local, where = unpack(rows["hashes"][own]), joined(rows["places"][own], np.uint16)
        hashes = np.concatenate((hashes[~several], local))
        place = np.concatenate((place[~several], where)).astype(np.int64)
        total = np.concatenate((total[~several], counts[np.searchsorted(known, local)]))

        a, b = threshold.numerator, threshold.denominator
        shared = np.bincount(place, minlength=len(n))
        skip = n - shared
        take = np.maximum(n + (-a * n // b) + 1 - skip, 0)
        begin = np.cumsum(shared) - shared
        keep = take[place] > 0
        if keep.any():
            # Only sets that are in some list are put in order.
            hashes, place, total = hashes[keep], place[keep], total[keep]
            order = np.lexsort((hashes, total, place))
            hashes, place = hashes[order].astype(np.int64), place[order]
            begin = np.searchsorted(place, np.arange(len(n)))
        out = []
        for i in np.flatnonzero(take).tolist():
            prefix = hashes[begin[i] : begin[i] + take[i]]
            name = key[i].tobytes()
            seed = name if skip[i] else set_key(np.append(prefix, n[i]))
            group = int.from_bytes(seed[:8], "little", signed=True)
            out.append((name, n[i], skip[i], group, prefix))
        return pd.DataFrame(out, columns=["key", "n", "skip", "g", "prefix"])

    return choose


def prefixes(docs: DataFrame, width: int, threshold: Fraction, total: int) -> DataFrame:
    """Classes that share a shingle of their prefix: ``key``, ``n``, ``prefix`` without what is theirs
    alone, the number of such (``skip``), and ``g``, equal for equal prefixes.

    ``total``: about how many shingles the sets have.
    """
    sent = docs.mapInPandas(_sent(width, max(-(-total // CHUNK_SHINGLES), 1)), BLOB)
    back = sent.groupBy("bucket").applyInPandas(trimmed(_counted), BLOB)
    chosen = back.groupBy("chunk").applyInPandas(trimmed(_prefixes(threshold)), PREFIX)
    return stored(chosen.dropDuplicates(["key"]), "prefixes", CHUNK_ROWS // 8)


def grouped(classes: DataFrame) -> DataFrame:
    """Groups of classes with the same prefix and size: ``q``, ``n``, ``skip``, ``prefix``, ``members``."""
    most = classes.groupBy("g", "n").count().agg(F.max("count")).first()[0] or 1
    part = F.pmod(F.xxhash64("key"), F.lit(-(-most // GROUP_PART)))
    return (
        classes.groupBy("g", "n", part.alias("part"))
        .agg(
            F.first("skip").alias("skip"),
            F.first("prefix").alias("prefix"),
            F.collect_list(F.struct("key", "bits")).alias("members"),
        )
        .select(F.xxhash64("g", "n", "part").alias("q"), "n", "skip", "prefix", "members")
    )


def postings(groups: DataFrame) -> DataFrame:
    """Places of groups in the posting lists of two groups or more, with their block of the list."""
    entries = groups.select("q", "skip", F.posexplode("prefix").alias("pos", "token"))
    entries = entries.select("q", "token", (F.col("skip") + F.col("pos")).alias("place"))
    shared = entries.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / LIST_BLOCK).cast("int")
    listed = entries.join(shared, "token").select(
        "token", "q", "place", blocks.alias("blocks"),
        F.pmod(F.xxhash64("q", "token"), blocks).cast("int").alias("block"),
    )
    alone = groups.where(F.size("members") > 1).select(
        F.col("q").alias("token"), "q", F.lit(0).alias("place"), F.lit(1).alias("blocks"),
        F.lit(0).alias("block"),
    )
    return listed.unionByName(alone)


def paired(lists: DataFrame, diagonal: bool) -> DataFrame:
    """List entries by pairs of blocks, or by blocks alone."""
    if diagonal:
        return lists.withColumns({"i": F.col("block"), "j": F.col("block")})
    return lists.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumns(
        {"i": F.least("block", "other"), "j": F.greatest("block", "other")}
    )


def labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with ``label``: the root of ``key``, or ``key`` where no link is known."""
    roots = roots.select(F.col("node").alias("key"), F.col("root").alias("label"))
    return members.join(roots, "key", "left").withColumn("label", F.coalesce("label", "key"))


def open_lists(lists: DataFrame, groups: DataFrame, roots: DataFrame) -> DataFrame:
    """The lists of more than one component; those of one stay so."""
    members = groups.join(lists.select("q").distinct(), "q", "left_semi")
    members = labelled(members.select("q", F.explode("members.key").alias("key")), roots)
    range_of = members.groupBy("q").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = lists.join(range_of, "q").groupBy("token")
    mixed = mixed.agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    return lists.join(mixed.select("token"), "token", "left_semi")


def _passing(threshold: Fraction, spares: int, forest: int):
    """Finds, in whole posting lists, pairs of members that may link and are not connected.

    Rows come sorted by list, then size; a list that a batch breaks off waits for the next one.
    """
    keys = ["token", "i", "j"]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for rows in batches:
            rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
            same = (rows[keys] == rows[keys].iloc[-1]).all(axis=1).to_numpy()
            whole = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
            rest = rows.iloc[whole:]
            if whole:
                yield _pairs_in(rows.iloc[:whole], threshold, spares, forest)
        if rest is not None and len(rest):
            yield _pairs_in(rest, threshold, spares, forest)
        trim()

    return find


def _pairs_in(rows: pd.DataFrame, threshold: Fraction, spares: int, forest: int) -> pd.DataFrame:
    a, b = threshold.numerator, threshold.denominator
    token, i, j, n, place, block, q = (
        rows[c].to_numpy(np.int64) for c in ("token", "i", "j", "n", "place", "block", "q")
    )
    label = pd.factorize(rows["label"])[0]
    names = rows["key"].tolist()
    failed = {k: set(f) for k, f in zip(names, rows["failed"]) if f is not None}
    bits = np.frombuffer(b"".join(rows["bits"]), dtype=np.uint64).reshape(-1, BITS // 64)
    low = np.frombuffer(b"".join(name[:8] for name in names), dtype=np.uint64)
    starts = np.ones(len(rows), dtype=bool)
    starts[1:] = (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    number, begin = np.cumsum(starts) - 1, np.flatnonzero(starts)
    end = np.append(begin[1:], len(rows))[number]
    # Nodes are the components of one list.
    node = np.unique(number * (label.max() + 1) + label, return_inverse=True)[1]
    parent = list(range(node.max() + 1))
    given = [0] * len(rows)
    out = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def take(found: list[np.ndarray]) -> None:
        # All lists take pairs in one order, likely links first, so that they choose the same ones.
        left, right, differ = np.concatenate(found, axis=1)
        order = np.lexsort((mix(low[left] + low[right]), differ))
        for x, y in zip(left[order].tolist(), right[order].tolist()):
            one, two = root(node[x]), root(node[y])
            if one == two and max(given[x], given[y]) >= spares:
                continue
            if names[x] in failed and names[y] in failed[names[x]]:
                continue
            parent[one] = two
            given[x] += 1
            given[y] += 1
            out.append(sorted((names[x], names[y])))

    found, size, x, step = [], 0, np.arange(len(rows)), 0
    while len(x):
        step += 1  # all pairs of rows of a list that are so many rows apart
        x = x[x + step < end[x]]
        x = x[n[x + step] * a <= n[x] * b]
        y = x + step
        good = (node[x] != node[y]) & ((i[x] == j[x]) | (block[x] != block[y]))
        left, right = x[good], y[good]
        total = n[left] + n[right]
        need = least_overlap(threshold, total)
        most = np.minimum(place[left], place[right])
        most += np.minimum(n[left] - place[left], n[right] - place[right])
        near = (most >= need) | (q[left] == q[right])
        left, right, spare = left[near], right[near], (total - 2 * need)[near]
        differ = np.bitwise_count(bits[left] ^ bits[right]).sum(axis=1).astype(np.int64)
        near = differ <= spare
        found.append(np.stack([left[near], right[near], differ[near]]))
        size += int(near.sum())
        if size >= forest:
            take(found)
            found, size = [], 0
            node = np.array([root(v) for v in range(len(parent))])[node]
            whole = np.logical_and.reduceat(node == node[begin][number], begin)
            x = x[~whole[number[x]]]  # lists of one component are done
    if found:
        take(found)
    return pd.DataFrame(out, columns=["a", "b"])


def likely(pairs: DataFrame, sketches: DataFrame, threshold: Fraction) -> DataFrame:
    """``pairs`` with ``linked``: false where the wide sketches rule a link out, else null."""

    @F.pandas_udf("boolean")
    def too_far(x: pd.Series, y: pd.Series, n: pd.Series) -> pd.Series:
        most = [int(t) - 2 * least_overlap(threshold, int(t)) for t in n]
        return pd.Series([differing(*xy) > m for *xy, m in zip(x, y, most)], dtype=bool)

    left = sketches.select(F.col("key").alias("a"), F.col("n").alias("m"), F.col("wide").alias("x"))
    right = sketches.select(F.col("key").alias("b"), F.col("n").alias("k"), F.col("wide").alias("y"))
    far = too_far("x", "y", F.col("m") + F.col("k"))
    linked = F.when(far, F.lit(False)).alias("linked")
    return pairs.join(left, "a").join(right, "b").select("a", "b", linked)


def sets_of(docs: DataFrame, width: int, rows: DataFrame, names: DataFrame) -> DataFrame:
    """The whole sets of these names: ``key`` and ``found``."""
    bucket = F.pmod(F.col("h"), F.lit(BUCKETS)).cast("int").alias("bucket")
    texts = rows.where("wide is not null").join(names, "key", "left_semi")
    # At most so many numbers are broadcast. Texts of other buckets are neither shuffled nor go to
    # Python, and a task has one worker, not a second one that looks them up.
    wanted = F.broadcast(texts.select(bucket).distinct())
    chosen = docs.withColumn("bucket", bucket).join(wanted, "bucket", "left_semi").drop("bucket")
    near = set_rows(chosen, width).where("found is not null")
    return near.select("key", "found").join(names, "key", "left_semi").dropDuplicates(["key"])


def verified(sets: DataFrame, pairs: DataFrame, threshold: Fraction) -> DataFrame:
    """``pairs`` of set names with ``linked``, from the whole sets."""

    @F.pandas_udf("boolean")
    def link(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            out = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                total = len(x) + len(y) - both
                out.append(both * threshold.denominator >= total * threshold.numerator)
            yield pd.Series(out, index=left.index)

    left = sets.select(F.col("key").alias("a"), F.col("found").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("found").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", link("x", "y").alias("linked"))


def classed(docs: DataFrame, width: int, threshold: Fraction) -> DataFrame:
    """Per document its id, the hash of its text, the size of its set, the least id of its
    component, and the component's name, null for an empty set."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty("text").alias("body"))
    docs = docs.withColumn("h", F.xxhash64("body"))
    rows = set_rows(docs, width, whole=False).select("doc_id", "h", "n", "key", "bits", "wide")
    rows = stored(rows, "sets", TEXTS_AT_ONCE)
    total = rows.where("wide is not null").agg(F.sum("n")).first()[0] or 0
    listed = prefixes(docs, width, threshold, total)
    sketches = rows.where("wide is not null").select("key", "n", "bits", "wide")
    sketches = sketches.join(listed.select("key"), "key", "left_semi").dropDuplicates(["key"])
    sketches = stored(sketches, "sketches")
    groups = stored(grouped(listed.join(sketches.select("key", "bits"), "key")), "groups")
    lists = stored(postings(groups), "lists")
    tried: DataFrame | None = None
    roots: DataFrame | None = None
    sets: list[DataFrame] = []
    step, diagonal = 0, not lists.where("blocks > 1").isEmpty()
    while True:
        members = groups.join(lists.select("q").distinct(), "q", "left_semi").select(
            "q", "n", F.explode("members").alias("m")
        ).select("q", "n", "m.key", "m.bits")
        if roots is None:
            members = members.withColumns(
                {"label": F.col("key"), "failed": F.lit(None).cast("array<binary>")}
            )
        else:
            failed = tried.where("not linked")
            failed = failed.select("a", "b").union(failed.select("b", "a"))
            failed = failed.groupBy(F.col("a").alias("key")).agg(F.collect_list("b").alias("failed"))
            members = labelled(members, roots).join(failed, "key", "left")
        entries = (
            paired(lists, diagonal).join(members, "q")
            .select("token", "i", "j", "block", "q", "n", "place", "key", "bits", "label", "failed")
            .repartition("token", "i", "j")
            .sortWithinPartitions("token", "i", "j", "n", "q", "key")
        )
        find = _passing(threshold, SPARES * step, FOREST_PAIRS)
        pairs = entries.mapInPandas(find, "a binary, b binary").distinct()
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            drop_stored(pairs)
            if not diagonal:
                break
            diagonal = False
            continue
        judged = stored(likely(pairs, sketches, threshold), "judged")
        unknown = judged.where("linked is null")
        names = unknown.select(F.col("a").alias("key")).union(unknown.select("b")).distinct()
        for known in sets:
            names = names.join(known.select("key"), "key", "left_anti")
        if not names.isEmpty():  # as in the first round; later ones mostly pair what was paired before
            sets.append(stored(sets_of(docs, width, rows, names), "known", TEXTS_AT_ONCE))
        known = reduce(DataFrame.union, sets) if sets else None
        new = verified(known, unknown, threshold) if sets else unknown
        new = new.union(judged.where("linked is not null"))
        # Links of earlier rounds are in the components already.
        new = new if tried is None else tried.where("not linked").union(new)
        before, tried = tried, stored(new, "tried", PAIRS_AT_ONCE)
        drop_stored(pairs, judged, before)
        links = tried.where("linked").select("a", "b")
        roots = components(links) if roots is None else merged(roots, links)
        before, lists = lists, stored(open_lists(lists, groups, roots), "lists")
        drop_stored(before)
        step, diagonal = step + 1, False
    sets.append(rows)  # only its narrow columns are needed from here on
    rows = stored(rows.select("doc_id", "h", "n", "key"), "names")
    drop_stored(tried, listed, sketches, groups, lists, *sets)

    least = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    if roots is not None:
        named = labelled(least, roots).withColumnRenamed("label", "root")
        ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
        least = named.join(ids, "root").select("key", "root", "component_id")
    else:
        least = least.select("key", F.col("key").alias("root"), F.col("least").alias("component_id"))
    found = rows.select("doc_id", "h", "n", F.when(F.col("n") > 0, F.col("key")).alias("key"))
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    found = found.join(least, "key", "left").select(
        "doc_id", "h", F.col("n").alias("n_shingles"), own.alias("component_id"), "root"
    )
    found = stored(found, "classed")  # callers use it more than once
    drop_stored(rows, roots)
    return found


def components_of(docs: DataFrame, width: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for each document."""
    found = classed(docs, width, threshold)
    return found.select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, width: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """``docs`` with one document of each component, the one with the least id, then text hash.

    Documents without words stay; a document without an id stays if no other of its component has
    one; of rows that are equal in id and text one stays.
    """
    found = classed(docs, width, threshold)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = found.where("root is not null").groupBy("root").agg(F.min(rank).alias("first"))
    kept = first.select("first.doc_id", "first.h").union(
        found.where("root is null").select("doc_id", "h")
    )
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("h").alias("kept_h")).distinct()
    name = free_name(docs, "h")
    rows = docs.withColumn(name, F.xxhash64(or_empty("text")))
    same = rows["doc_id"].cast("long").eqNullSafe(kept["kept_id"]) & (rows[name] == kept["kept_h"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
