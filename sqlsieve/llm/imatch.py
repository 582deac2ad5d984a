"""Document fingerprints from terms of middling rarity (I-Match with randomised lexicons).

Terms are runs of letters and digits, lower-cased. The lexicon is the terms whose inverse document
frequency lies in a band: in at least ``LEAST_DOCS`` documents and in at most the share
``MOST_SHARE`` of them, counted over the distinct texts, so that exact copies, however many, count
as one and take no term of theirs out of the band. A group of near copies of more than
``MOST_SHARE`` of the distinct texts does lift the terms they all have above the band: its members
are compared by the other terms, and have their digest as fingerprint if there are none. The
lexicon is split at random into ``SUBSETS`` lexicons, and
each of these is thinned at random by halves. For each lexicon the fingerprint holds the hash of
the sorted distinct terms that the document has in it: at the thinning where a document of its
number of terms has about one or two in each, and at the next. So a change of some words changes
some of the hashes, whatever the length of the document. Likeness is the share of equal hashes
among the lexicons from which either document has a term, at the thinnings that both hold; it
estimates the overlap of the documents' terms. A document without a term in the lexicons has the
digest of its text as fingerprint, and is like equal texts only.

On Spark everything is DataFrame functions. Which terms a document may need is known from their hashes
alone, so only these are looked up in the lexicon: a bounded number for a document of any
length. The terms that more than ``MOST_SHARE`` of the rows have could be hot keys and are broadcast; there
are at most as many as the mean number of terms of a row over ``MOST_SHARE``.

Rows: a null text is an empty one; a null id comes before all others; documents are ordered by id,
then by the hash of their text; rows equal in both are one document in that order and are given
as often as they occur; an empty table gives an empty one; the only document is its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import or_empty, release
from .neighbours import with_neighbours

SUBSETS = 32
LEAST_DOCS = 2
MOST_SHARE = 0.01
BROADCAST_TERMS = 2_000_000
SPLIT = r"[^\p{L}\p{N}]+"
FIRST_ID = -(1 << 63)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms."""
    words = F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def level(n_terms: Column) -> Column:
    """Halvings of a lexicon after which a document has one or two terms in it."""
    return F.greatest(F.floor(F.log2(n_terms / SUBSETS)), F.lit(0)).cast("int")


def subset(term: Column) -> Column:
    return F.pmod(term, F.lit(SUBSETS)).cast("int")


def survives(term: Column, halvings: Column) -> Column:
    """Whether a term is still in its lexicon after so many halvings."""
    rest = F.shiftrightunsigned(term, SUBSETS.bit_length() - 1)
    return F.pmod(rest, F.pow(F.lit(2.0), halvings).cast("long")) == 0


def _surviving(halvings: Column):
    return lambda term: survives(term, halvings)


def frequencies(docs: DataFrame, text: str = "text", repeated: DataFrame | None = None) -> DataFrame:
    """Number of rows (``rows``) and of distinct texts (``df``) that have each term.

    ``repeated`` has the ``terms`` of each text of several rows, and their number ``held``; without
    it all texts count as distinct.
    """
    every = docs.select(
        F.explode(terms(or_empty(text))).alias("term"), F.lit(1).alias("rows"), F.lit(0).alias("less")
    )
    if repeated is not None:
        more = F.col("held") - 1
        every = every.union(repeated.select(F.explode("terms"), F.lit(0), more))
    counts = every.groupBy("term").agg(F.sum("rows").alias("rows"), F.sum("less").alias("less"))
    return counts.select("term", "rows", (F.col("rows") - F.col("less")).alias("df"))


def hashes(members: DataFrame, lexicon: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per key the hashes of both versions' terms, an array over the lexicons for each thinning.

    ``members`` has the key ``k``, ``term`` and ``about``: the versions (1: the text, 2: the edited
    one, 3: both) and their levels in one number. ``frequent`` has the terms of many rows, and
    ``within``: whether they are in the lexicon. Null stands for a lexicon without a term.
    """
    if frequent.count() <= BROADCAST_TERMS:
        rare = members.join(F.broadcast(frequent), "term", "left_anti").join(lexicon, "term")
        hot = members.join(F.broadcast(frequent.where("within")), "term")
        known = rare.select("k", "term", "about").union(hot.select("k", "term", "about"))
    else:
        known = members.join(lexicon, "term").select("k", "term", "about")
    about = F.col("about")
    per_subset = known.groupBy("k", subset(F.col("term")).alias("r")).agg(
        *[
            F.sort_array(
                F.collect_list(F.when(about.bitwiseAND(v) > 0, F.col("term")))
            ).alias(f"t{v}")
            for v in (1, 2)
        ],
        F.first("about").alias("about"),
    )
    found = []
    for v in (1, 2):
        dense = F.col(f"t{v}")
        halved = F.shiftright("about", 2 if v == 1 else 8).bitwiseAND(63) + 1
        for step, of in enumerate((dense, F.filter(dense, _surviving(halved)))):
            found.append(F.when(F.size(of) > 0, F.hash(of)).alias(f"h{v}{step}"))
    gathered = (
        per_subset.select("k", "r", *found)
        .groupBy("k")
        .agg(F.collect_list(F.struct("r", "h10", "h11", "h20", "h21")).alias("found"))
    )
    return gathered.select("k", *[laid_out("found", c[:3]).alias(c[3:]) for c in _LAID])


_LAID = ("h10dense1", "h11thin1", "h20dense2", "h21thin2")


def laid_out(found: str, field: str) -> Column:
    """Hashes by number of the lexicon, null where the document has no term in one."""
    pairs = F.map_from_entries(F.transform(found, lambda x: F.struct(x["r"], x[field])))
    return F.transform(
        F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda r: F.try_element_at(pairs, r)
    )


def fingerprint(at: Column, dense: Column, thin: Column, digest: Column) -> Column:
    """Level and hashes as one string; the text's digest where there is no hash."""

    def shown(hashed: Column) -> Column:
        word = lambda x: F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))
        return F.array_join(F.transform(hashed, lambda x: F.coalesce(word(x), F.lit("-"))), ",")

    return F.when(
        dense.isNotNull() & F.exists(dense, lambda x: x.isNotNull()),
        F.concat_ws(";", at.cast("string"), shown(dense), shown(thin)),
    ).otherwise(F.concat(F.lit("text:"), F.lower(F.hex(digest))))


def likeness(a: tuple[Column, ...], b: tuple[Column, ...], equal: Column) -> Column:
    """Of two fingerprints, each given as level, dense and thin hashes; ``equal``: of equal texts."""
    (level_a, dense_a, thin_a), (level_b, dense_b, thin_b) = a, b

    def total(counted: Column) -> Column:
        return F.aggregate(counted, F.lit(0), lambda n, x: n + x)

    def share(x: Column, y: Column) -> Column:
        seen = F.zip_with(x, y, lambda p, q: (p.isNotNull() | q.isNotNull()).cast("int"))
        same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)).cast("int"))
        return F.try_divide(total(same), total(seen))

    both = F.when(
        level_a == level_b, share(F.concat(dense_a, thin_a), F.concat(dense_b, thin_b))
    ).when(level_a + 1 == level_b, share(thin_a, dense_b))
    both = both.when(level_b + 1 == level_a, share(dense_a, thin_b))
    return F.when(equal, F.lit(1.0)).otherwise(F.coalesce(both, F.lit(0.0)))


def in_order(rows: DataFrame) -> DataFrame:
    """``d`` and ``h`` of each distinct document with its copies and neighbours, round the ends."""
    narrow = rows.groupBy("d", "h").agg(
        F.max(F.length("body")).alias("n"), F.count("*").alias("c")
    )
    order = with_neighbours(narrow, ["d", "h"], ["d", "h", "n"])
    key = F.struct("d", "h", "n")
    ends = narrow.agg(F.min(key).alias("first"), F.max(key).alias("last")).first()
    for name, end in (("after", "first"), ("before", "last")):
        if ends[end] is not None:
            kinds = {"d": "long", "h": "long", "n": "int"}
            value = [F.lit(ends[end][k]).cast(kind).alias(k) for k, kind in kinds.items()]
            order = order.withColumn(name, F.coalesce(name, F.struct(*value)))
    return order.select("d", "h", "c", "before", "after")


def edited_texts(rows: DataFrame) -> DataFrame:
    """Distinct documents with ``copies``, their next one's key, and their edited text.

    The last quarter of a text is replaced by as many first characters of the next document. Each
    text is shuffled once; of the next documents' texts only what is needed is sent on. The first
    document of each text has the number of all rows of that text as ``held``.
    """
    order = in_order(rows)
    quarter = lambda n: F.floor(n / 4).cast("int")
    distinct = rows.groupBy("d", "h").agg(
        F.first("body").alias("body"), F.count("*").alias("copies")
    )
    # Both uses of the distinct texts read all their columns, so that one shuffle serves them.
    head = F.substring(F.col("body"), F.lit(1), quarter(F.col("before.n")))
    heads = distinct.join(order, ["d", "h"]).select(
        F.col("before.d").alias("d"), F.col("before.h").alias("h"),
        F.when(F.col("copies") > 0, head).alias("head"),
    )
    held = order.groupBy("h").agg(F.min("d").alias("d"), F.sum("c").alias("held"))
    following = order.select(
        "d", "h", F.col("after.d").alias("nd"), F.col("after.h").alias("nh")
    ).join(held, ["d", "h"], "left")
    pairs = distinct.join(heads, ["d", "h"]).join(following, ["d", "h"])
    pairs = pairs.withColumn("n", F.length("body"))
    kept = F.substring(F.col("body"), F.lit(1), F.col("n") - quarter(F.col("n")))
    return pairs.withColumn("edited", F.concat(kept, F.col("head")))


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """Distinct documents with the hashes of their terms and of their edited texts' terms."""
    rows = docs.select(or_empty("text").alias("body"), F.col("doc_id").cast("long").alias("d"))
    rows = rows.select(
        F.coalesce("d", F.lit(FIRST_ID)).alias("d"), F.xxhash64("body").alias("h"), "body"
    )
    pairs = edited_texts(rows)
    texts = pairs.select(
        "d", "h", "nd", "nh", "copies", "held", F.col("n").cast("long").alias("n_chars"),
        F.unhex(F.sha2("body", 256)).alias("digest"), F.unhex(F.sha2("edited", 256)).alias("edited"),
        terms(F.col("body")).alias("a"), terms(F.col("edited")).alias("b"),
    ).withColumns({"l1": level(F.size("a")), "l2": level(F.size("b"))})
    needed = texts.withColumns(
        {
            "terms": F.when(F.col("held") > 1, F.col("a")),
            "a": F.filter("a", lambda t: survives(t, F.col("l1"))),
            "b": F.filter("b", lambda t: survives(t, F.col("l2"))),
        }
    )
    facts = needed.select(
        "d", "h", "nd", "nh", "copies", "n_chars", "digest", "edited", "l1", "l2", "held", "terms",
        F.array_intersect("a", "b").alias("both"), F.array_except("a", "b").alias("own"),
        F.array_except("b", "a").alias("new"), F.monotonically_increasing_id().alias("k"),
    )
    facts = cut_lineage(facts)
    release(docs.sparkSession)

    member = lambda name, v: F.transform(
        name, lambda t: F.struct(t.alias("term"), F.lit(v).alias("versions"))
    )
    every = F.concat(member("both", 3), member("own", 1), member("new", 2))
    levels = F.col("l1") * 4 + F.col("l2") * 256
    members = facts.select("k", levels.alias("levels"), F.explode(every).alias("m")).select(
        "k", "m.term", (F.col("levels") + F.col("m.versions")).cast("int").alias("about")
    )
    totals = facts.agg(F.sum("copies").alias("rows"), F.count("held").alias("texts")).first()
    most_rows, most = (
        max(float(LEAST_DOCS), MOST_SHARE * (totals[name] or 0)) for name in ("rows", "texts")
    )
    counts = frequencies(docs, repeated=facts.where("terms is not null").select("terms", "held"))
    counts = counts.where((F.col("df") >= LEAST_DOCS) | (F.col("rows") > most_rows))
    counts = cut_lineage(counts)
    within = (F.col("df") >= LEAST_DOCS) & (F.col("df") <= most)
    lexicon = counts.where(within).select("term")
    frequent = counts.where(F.col("rows") > most_rows).select("term", within.alias("within"))
    release(docs.sparkSession)
    found = cut_lineage(hashes(members, lexicon, frequent))
    release(docs.sparkSession)
    return facts.drop("both", "own", "new", "held", "terms").join(found, "k", "left").drop("k")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document both fingerprints and their likenesses."""
    done = with_fingerprints(docs)
    own, edited = (tuple(F.col(f"{c}{v}") for c in ("l", "dense", "thin")) for v in (1, 2))
    following = done.select(
        F.col("d").alias("nd"), F.col("h").alias("nh"), F.col("l1").alias("l3"),
        F.col("dense1").alias("dense3"), F.col("thin1").alias("thin3"),
    )
    after = tuple(F.col(f"{c}3") for c in ("l", "dense", "thin"))
    rows = done.join(following, ["nd", "nh"], "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    return rows.select(
        F.nullif("d", F.lit(FIRST_ID)).alias("doc_id"),
        "n_chars",
        F.lower(F.hex("edited")).alias("edited_sha256"),
        fingerprint(*own, F.col("digest")).alias("fingerprint"),
        fingerprint(*edited, F.col("edited")).alias("edited_fingerprint"),
        likeness(own, edited, F.col("digest") == F.col("edited")).alias("near_edited"),
        likeness(own, after, F.col("h") == F.col("nh")).alias("near_next"),
    )
