"""Secrets in texts: known forms, and tokens that look random.

Known forms are assignments to a secret's name, access key ids and long hexadecimal runs. Beyond
them, every run of at least ``LEAST`` key characters that touches no known form and has letters
and digits, or letters of both cases within a word, is put through a battery of tests, seen as
numbers in the narrowest of ``ALPHABETS`` that holds all its characters: a chi-squared test of the
alphabet's four quarters, a runs test about the middle and a test of the correlation of
neighbours. A token's p value is three times the least of the three. A random key is as random in
a narrower alphabet that happens to hold it. Alphabets up to base 36 are of either case, and
separators that cut a token into groups of one size, and those of a UUID, are left out. Alphabets
of words begin with the letters that words use most, so that the quarters tell words from keys.

Words, names and paths fail these tests, keys pass them. Which p values count as failed is set by
false-discovery control among tokens of about the same length and the same encoding, as short ones
can hardly fail: by the Benjamini-Hochberg rule at most the share ``RATE`` of what is cleared as not
random is random. The rule needs only counts by class and p value, rounded up to steps of a twentieth
of a decade, over all documents; the rest is one pass without a shuffle. What is not cleared is a span
of the kind ``random``.

Two guards go over each text: ``RUN`` finds ``LEAST`` key characters in a row, which every token, access
key id and hexadecimal run has, and ``NAMED`` a secret's name before its sign. Only texts that pass
one are searched for the spans that it stands for. ``secret_spans`` leaves the texts out, so what was
found in them is written, counted and judged from there: the texts are read once.

Everything is DataFrame functions. The counts that come to the driver are one number for each
class: at most one for each alphabet times the powers of two up to the longest text.

Rows: a null text is an empty one without spans; repeated rows give repeated results and count as
often in the control; an empty table gives an empty one; a column of the input that has the name
of a new one is replaced.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import let
from .common import free_name, or_empty, others, running, stored

NAMES = "password|passwd|secret|token|api_?key"
ASSIGN = rf"(?=[AaPpSsTt])(?i:({NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f](?<![0-9a-f]{2})[0-9a-f]{23,}+"
LEAST = 20
#: One by one, as the JVM looks a class of single characters up in one table.
KEY = string.ascii_letters + string.digits + "+/_-"
TOKEN = rf"(?<![{KEY}])[{KEY}]{{{LEAST},}}+={{0,2}}"
#: Goes over each character once: shorter runs are taken with what follows them, and not tried again.
RUN = rf"\A(?:[{KEY}]{{0,{LEAST - 1}}}+[^{KEY}]+)*+[{KEY}]{{{LEAST}}}"
#: Holds wherever ``ASSIGN`` does; the JVM looks back at a bounded number of spaces only.
NAMED = rf"[:=](?<=(?:(?i:{NAMES})[\"']?\x20{{0,8}}|\x20{{9}})[:=])"
UUID = r"^(?i:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})$"
KINDS = ("assign", "access", "hex", "random")
COMMON = "ETAOINSHRDLUCMFWYPVBGKJQXZ"
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": COMMON + "234567",
    "base36": COMMON + "0123456789",
    "base52": COMMON.lower() + COMMON,
    "base62": COMMON.lower() + COMMON + "0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
RATE = 0.05
STEPS = 20
LAST_STEP = 400
MARK = "[SECRET]"
SPAN = "struct<start:bigint,kind:int,end:bigint>"
MATCH = "struct<start:bigint,end:bigint,word:string>"


def matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern, leftmost and not overlapping, each with its start and end in code points."""

    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern), 1, F.size(hits))
        sizes = F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.length(h))

        def one(end: Column, i: Column) -> Column:
            word = F.get(hits, i)
            return F.struct((end - F.length(word)).alias("start"), end.alias("end"), word.alias("word"))

        found = F.transform(let(sizes, running), one)
        return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(f"array<{MATCH}>"))

    return let(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), placed)


def span(match: Column, kind: int, before: Column | int = 0) -> Column:
    start, end = match["start"] + before, match["end"] + before
    return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))


def assigned_spans(text: Column) -> Column:
    """Spans of assignments to a secret's name, of values of at least six characters."""
    named = (text.contains(":") | text.contains("=")) & text.rlike(NAMED)
    long = F.filter(matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["word"], ASSIGN, 2)) >= 6)
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(named, F.transform(long, lambda m: span(m, 0))).otherwise(none)


def long_runs(text: Column) -> Column:
    """Matches of ``TOKEN``."""
    none = F.array().cast(f"array<{MATCH}>")
    return F.when(text.rlike(RUN), matches(text, TOKEN)).otherwise(none)


def spans_within(runs: Column, pattern: str, kind: int) -> Column:
    """Spans of a pattern that matches within long runs only."""
    part = lambda r: F.transform(matches(r["word"], pattern), lambda m: span(m, kind, r["start"]))
    return F.flatten(F.transform(F.filter(runs, lambda r: r["word"].rlike(pattern)), part))


def known_spans(text: Column, runs: Column) -> Column:
    """Spans of the known forms, by start, then kind. ``runs``: the text's ``long_runs``."""
    within = [spans_within(runs, ACCESS, 1), spans_within(runs, HEX, 2)]
    return F.array_sort(F.concat(assigned_spans(text), *within))


def numbers_below(places: Column, marks: Column, equal: bool) -> Column:
    """For each of the ascending ``places`` how many of ``marks`` are below it, or ``equal`` to it."""
    asks = F.transform(places, lambda p: F.struct(p.alias("at"), F.lit(equal).alias("late")))
    marked = F.transform(marks, lambda m: F.struct(m.alias("at"), F.lit(not equal).alias("late")))
    mark = lambda e: e["late"] != F.lit(equal)

    def counted(events: Column) -> Column:
        numbers = let(F.transform(events, lambda e: mark(e).cast("long")), running)
        return F.filter(numbers, lambda n, i: ~mark(F.get(events, i)))

    return let(F.array_sort(F.concat(asks, marked)), counted)


def untouched(runs: Column, known: Column) -> Column:
    """The long runs that no known span touches.

    Access key ids and hexadecimal runs lie within them, so their patterns tell; where names and their
    values lie is known, by start and not overlapping.
    """
    free = F.filter(runs, lambda r: ~r["word"].rlike(ACCESS) & ~r["word"].rlike(HEX))
    assigned = F.filter(known, lambda s: s["kind"] == 0)

    def apart(x: Column) -> Column:
        free, assigned = x["free"], x["assigned"]
        over = numbers_below(free["start"], assigned["end"], equal=True)
        begun = numbers_below(free["end"], assigned["start"], equal=False)
        same = F.zip_with(begun, over, lambda b, o: b == o)
        kept = let(same, lambda s: F.filter(free, lambda m, i: F.get(s, i)))
        return F.when(F.size(assigned) == 0, free).otherwise(kept)

    return let(F.struct(free.alias("free"), assigned.alias("assigned")), apart)


def plain(token: Column) -> Column:
    """The token without padding and without the separators of even groups and UUIDs."""

    def joined(body: Column) -> Column:
        sizes = F.array_distinct(F.transform(F.split(body, "[-_]"), lambda g: F.length(g)))
        even = let(sizes, lambda s: (F.size(s) == 1) & (F.get(s, F.lit(0)) > 1))
        grouped = body.rlike("[-_]") & (even | body.rlike(UUID))
        return F.when(grouped, F.translate(body, "-_", "")).otherwise(F.translate(body, "-_", "+/"))

    return let(F.regexp_replace(token, "=+$", ""), joined)


def encoding(body: Column) -> Column:
    """The narrowest encoding of a plain token; null for words and plain numbers."""
    return (
        F.when(~body.rlike("[A-Za-z]") | ~body.rlike("[0-9]|[a-z][A-Z]"), None)
        .when(body.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit("hex"))
        .when(body.rlike("^([A-Z2-7]+|[a-z2-7]+)$"), F.lit("base32"))
        .when(body.rlike("^([A-Z0-9]+|[a-z0-9]+)$"), F.lit("base36"))
        .when(body.rlike("^[A-Za-z]+$"), F.lit("base52"))
        .when(body.rlike("^[A-Za-z0-9]+$"), F.lit("base62"))
        .otherwise(F.lit("base64"))
    )


def _tail(z: Column) -> Column:
    """Chance that a standard normal value is above ``z``, to three digits."""
    z = F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))
    return let(z, lambda z: 1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z)))


def p_value(body: Column, kind: Column) -> Column:
    """Three times the least p value of the battery, for the hypothesis that the token is random."""
    folded = F.when(kind == "hex", F.lower(body)).when(
        kind.isin("base32", "base36"), F.upper(body)
    )
    alphabet = F.lit(ALPHABETS["base64"])
    for name in ALPHABETS:
        alphabet = F.when(kind == name, F.lit(ALPHABETS[name])).otherwise(alphabet)

    def tested(s: Column) -> Column:
        chars = F.filter(F.split(s["body"], ""), lambda c: c != "")
        numbers = F.transform(chars, lambda c: F.instr(s["alphabet"], c) - 1)
        return let(numbers, lambda v: _battery(v, F.length(s["alphabet"])))

    return let(F.struct(F.coalesce(folded, body).alias("body"), alphabet.alias("alphabet")), tested)


def _squared(d: Column, by: Column) -> Column:
    return let(d, lambda d: d * d / by)


def _battery(v: Column, k: Column) -> Column:
    """What a test uses more than once is bound: an expression within a lambda is worked out at each element."""
    zero = F.lit(0.0)
    n = F.size(v).cast("double")
    total = lambda a: F.aggregate(a, zero, lambda x, y: x + y)
    share = lambda a, test: F.size(F.filter(a, lambda x: test(x))).cast("double")
    before, after = F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1)

    def chi(quarters: Column) -> Column:
        out = zero
        for q in range(4):
            seen = share(quarters, lambda x, q=q: x == q)
            quarter = n * (F.ceil(k * (q + 1) / 4) - F.ceil(k * q / 4)) / k
            out = out + _squared(seen - quarter, quarter)
        return out

    spread = 2.0 / 27
    chi_squared = let(F.transform(v, lambda x: F.floor(x * 4 / k)), chi)
    uniform = _tail((F.pow(chi_squared / 3, F.lit(1.0 / 3)) - (1 - spread)) / math.sqrt(spread))

    changes = total(
        F.zip_with(before, after, lambda a, b: ((a * 2 >= k) != (b * 2 >= k)).cast("double"))
    )
    mean = let(share(v, lambda x: x * 2 >= k), lambda high: 2 * high * (n - high) / n)

    def runs_test(mean: Column) -> Column:
        def tested(variance: Column) -> Column:
            z = F.abs(changes - mean) / F.sqrt(variance)
            return F.when(variance > 0, F.least(F.lit(1.0), 2 * _tail(z))).otherwise(zero)

        return let(mean * (mean - 1) / (n - 1), tested)

    runs = let(mean, runs_test)

    def serial_test(middle: Column) -> Column:
        squares = total(F.transform(v, lambda x: (x - middle) * (x - middle)))
        products = total(F.zip_with(before, after, lambda a, b: (a - middle) * (b - middle)))

        def tested(squares: Column) -> Column:
            z = F.abs(products / squares) * F.sqrt(n)
            return F.when(squares > 0, F.least(F.lit(1.0), 2 * _tail(z))).otherwise(zero)

        return let(squares, tested)

    serial = let(total(F.transform(v, lambda x: x.cast("double"))) / n, serial_test)
    return F.least(F.lit(1.0), 3 * F.least(uniform, runs, serial))


def tokens(runs: Column, known: Column) -> Column:
    """Candidates among long runs, outside the known spans: span, class of length and encoding, and p value's step."""

    def tested(m: Column) -> Column:
        return let(
            F.struct(span(m, 3).alias("span"), plain(m["word"]).alias("body")),
            lambda t: F.struct(t["span"].alias("span"), t["body"].alias("body"), encoding(t["body"]).alias("kind")),
        )

    def rated(t: Column) -> Column:
        p = F.greatest(p_value(t["body"], t["kind"]), F.lit(1e-25))
        step = F.least(F.floor(-F.log10(p) * STEPS), F.lit(LAST_STEP)).cast("int")
        size = F.floor(F.log2(F.length(t["body"]).cast("double"))).cast("string")
        name = F.concat(t["kind"], F.lit(":"), size)
        return F.struct(t["span"].alias("span"), name.alias("class"), step.alias("step"))

    candidates = F.filter(F.transform(untouched(runs, known), tested), lambda t: t["kind"].isNotNull())
    return F.transform(candidates, rated)


def cleared_from(candidates: DataFrame, rate: float = RATE) -> dict[str, int]:
    """Per class the first step at which a token is cleared, by the Benjamini-Hochberg rule.

    ``candidates`` has a row per token with ``class`` and ``step``.
    """
    counts = candidates.groupBy("class", "step").agg(F.count("*").alias("n"))
    every = Window.partitionBy("class")
    below = every.orderBy(F.desc("step"))
    ranked = counts.select(
        "class", "step", F.sum("n").over(below).alias("rank"), F.sum("n").over(every).alias("all")
    )
    within = F.pow(F.lit(10.0), -F.col("step") / STEPS) <= rate * F.col("rank") / F.col("all")
    first = ranked.where(within).groupBy("class").agg(F.min("step").alias("step"))
    return {r["class"]: r["step"] for r in first.collect()}


def searched(docs: DataFrame, kept: list[Column], text: str = "text") -> DataFrame:
    """Per document a ``row`` of the columns ``kept``, its known spans and its candidates."""
    body, runs, known = F.col("body"), F.col("runs"), F.col("known")
    rows = docs.select(F.struct(*kept).alias("row"), or_empty(docs[f"`{text}`"]).alias("body"))
    rows = rows.withColumn("runs", long_runs(body)).withColumn("known", known_spans(body, runs))
    return rows.select("row", "known", tokens(runs, known).alias("tokens"))


def judged(rows: DataFrame, name: str, rate: float = RATE) -> DataFrame:
    """The columns of ``row``, and all spans but those of tokens that are cleared."""
    first = cleared_from(rows.select(F.explode("tokens").alias("t")).select("t.*"), rate)
    limits = [F.lit(x) for pair in sorted(first.items()) for x in pair]

    def random(t: Column) -> Column:
        if not first:
            return F.lit(True)
        step = F.try_element_at(F.create_map(*limits), t["class"])
        return t["step"] < F.coalesce(step, F.lit(LAST_STEP + 1))

    added = F.transform(F.filter("tokens", random), lambda t: t["span"])
    return rows.select("row.*", F.array_sort(F.concat("known", added)).alias(name))


def scan(docs: DataFrame, name: str = "spans", text: str = "text", rate: float = RATE) -> DataFrame:
    """``docs`` with all spans, by start, then kind, in code points with the end left out."""
    return judged(searched(docs, others(docs, name), text), name, rate)


def listed(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(found, one), ",")


def redact(docs: DataFrame, text: str = "text", rate: float = RATE) -> DataFrame:
    """``docs`` with every span of the text replaced by a mark, overlapping spans by one mark."""
    name = free_name(docs, "spans")
    found = scan(docs, name, text, rate)
    body, empty = F.col(f"`{text}`"), F.array().cast("array<struct<start:bigint,end:bigint>>")
    last = lambda done: F.try_element_at(done, F.lit(-1))
    one = lambda start, end: F.array(F.struct(start.alias("start"), end.alias("end")))
    merged = F.aggregate(
        name,
        empty,
        lambda done, s: F.when(
            F.coalesce(last(done)["end"] > s["start"], F.lit(False)),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                one(last(done)["start"], F.greatest(last(done)["end"], s["end"])),
            ),
        ).otherwise(F.concat(done, one(s["start"], s["end"]))),
    )
    piece = lambda a, b: F.substring(body, a.cast("int") + 1, (b - a).cast("int"))
    zero = F.lit(0).cast("long")
    pieces = F.transform(
        name,
        lambda s, i: F.concat(
            piece(F.when(i == 0, zero).otherwise(F.get(name, i - 1)["end"]), s["start"]),
            F.lit(MARK),
        ),
    )
    rest = piece(last(F.col(name))["end"], F.length(body).cast("long"))
    clean = F.when(F.size(name) == 0, body).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return found.withColumn(name, merged).withColumn(text, clean).drop(name)


def secret_spans(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Per document the numbers of known forms, their digest, and all spans."""
    found = judged(stored(searched(docs, [docs["doc_id"]]), "secret-candidates"), "found", rate)
    base = F.filter("found", lambda s: s["kind"] < 3)
    kinds = F.transform("found", lambda s: s["kind"])
    numbers = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(KINDS)
    ]
    return found.select(
        "doc_id", *numbers[:3], F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"), numbers[3],
    )
