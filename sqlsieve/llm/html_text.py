"""Main text of web pages, by differences between pages of nearby URLs.

Each page's HTML becomes a list of text lines, one for each block element. The pages of a host are
put in the order of their paths, and each is compared with the neighbour whose path has the longer
beginning in common: the longest common subsequence of their lines aligns the two, and the lines
they share are deleted, as menus, notices and the like are what pages of a site have in common.

Markup then settles what it is certain about. Lines inside navigation, footers, sidebars, forms,
adverts, comments and so on go whether shared or not. Where a page marks its article, the lines in
it stay even if a neighbour has the same ones, and lines outside go. So a shared line is deleted
wherever markup does not name it part of the article. Forms and what only its class or id names a
frame may be wrappers of the page: an article or main part in one counts if it holds more text than
what lies outside, and where all lines are in such frames the outermost ones are undecided. A page that would lose all its undecided lines is a
copy of its neighbour rather than a frame without content, and keeps them.

On Spark: hashes of lines, not the lines, are dealt out by ranges of host and path, so a host with
very many pages is spread like all others; texts are shuffled once, to meet what was found.

Rows: a null page is an empty one; without a URL, or one without ``://``, host and path are empty
and such pages are each other's neighbours; a page alone on its host has none; repeated rows give
repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_chars, or_empty
from .neighbours import with_neighbours
from .url_filters import host, path

DROPPED = frozenset(
    "nav footer aside button select textarea option dialog menu iframe object embed svg math "
    "canvas audio video map head title noscript template".split()
)
RAW = "script|style|textarea|title|noscript|template|iframe|svg|math|xmp"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LOOSE = frozenset("p li dt dd tr td th option".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notices pager pagination popup promo promoted promotion related respond "
    "share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
REPLIES = frozenset("comment comments disqus respond".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][\w:-]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
FRAME, PLAIN, ARTICLE, MAIN, SOFT, DEEP, WITHIN, INNER, INNER_MAIN = range(9)
#: Frames by class, id or form, by what they lie in: a wrapper, one in another, one in an article.
SOFTER = {
    PLAIN: SOFT, MAIN: SOFT, SOFT: DEEP, DEEP: DEEP, INNER_MAIN: DEEP,
    ARTICLE: WITHIN, INNER: WITHIN, WITHIN: WITHIN,
}
LARGE = 50_000_000


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in ATTRIBUTE.finditer(rest)}


def _region(name: str, rest: str, inside: int) -> int:
    """What an element makes of the text in it, given what it lies in."""
    outside = inside in (PLAIN, SOFT, DEEP)
    if inside == FRAME or name in DROPPED or (name == "header" and outside):
        return FRAME
    article = ARTICLE if inside in (PLAIN, ARTICLE, MAIN, WITHIN) else INNER
    main = MAIN if inside == PLAIN else INNER_MAIN
    soft = name == "form"
    if "=" in rest or "hidden" in rest.lower():
        found = _attributes(rest)
        words = set(re.split(r"[^a-z0-9]+", found.get("class", "") + " " + found.get("id", "")))
        style = re.sub(r"\s", "", found.get("style", ""))
        gone = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
        role = found.get("role")
        if name not in ("body", "html"):
            if gone or words & REPLIES or (role in ROLES and role != "form"):
                return FRAME
            soft = soft or role == "form" or bool(words & NAMES)
        if found.get("itemprop") == "articlebody":
            return article
        if role == "main" and outside:
            return main
    if name == "article" and inside != WITHIN:
        return article
    if name == "main" and outside:
        return main
    return SOFTER[inside] if soft and name not in ("article", "main") else inside


def lines(page: str) -> tuple[list[str], list[bool | None]]:
    """The text lines of a page, and whether each is main text; None where markup does not say."""
    texts, regions, parts, stack = [], [], [], [("", PLAIN)]

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                texts.append(text)
                regions.append(stack[-1][1])
            parts.clear()

    last = 0
    for token in TOKEN.finditer(page):
        if token.start() > last:
            parts.append(page[last : token.start()])
        last = token.end()
        name = token["name"] or token["name2"]
        if name is None:
            continue
        name, rest = name.lower(), token["rest"] or token["rest2"] or ""
        if token["end"] or token["end2"]:
            opened = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if name not in INLINE or (opened and stack[opened][1] != stack[opened - 1][1]):
                flush()
            if opened:
                del stack[opened:]
            continue
        if name in VOID:
            if name not in INLINE:
                flush()
            continue
        if name == "body":
            flush()
            stack[1:] = []
        if name in LOOSE and stack[-1][0] == name:
            flush()
            stack.pop()
        region = _region(name, rest, stack[-1][1])
        if name not in INLINE or region != stack[-1][1]:
            flush()
            if not rest.endswith("/"):
                if name not in ("p", "body", "html") or region != stack[-1][1]:
                    stack.append((name, region))
    if last < len(page):
        parts.append(page[last:])
    flush()
    sizes = dict.fromkeys(range(9), 0)
    for text, region in zip(texts, regions):
        sizes[region] += len(text)
    wanted = ARTICLE if sizes[ARTICLE] else MAIN if sizes[MAIN] else None
    inner = INNER if sizes[INNER] else INNER_MAIN
    if wanted != ARTICLE and sizes[inner] > sizes[wanted or PLAIN]:
        wanted = inner
    if wanted is None:
        outermost = next((r for r in (PLAIN, SOFT, DEEP) if sizes[r]), PLAIN)
        return texts, [None if r in (outermost, INNER, INNER_MAIN) else False for r in regions]
    return texts, [r == wanted for r in regions]


def common(a: list, b: list) -> list[int]:
    """Positions in ``a`` of one longest common subsequence, in order."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    middle = _common(a[low : len(a) - high], b[low : len(b) - high])
    return [*range(low), *(low + i for i in middle), *range(len(a) - high, len(a))]


def _rows(a: list, b: list, every: bool) -> list[int]:
    """Bit j of a row is 0 where the subsequence grows by b[j], bit-parallel over b."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, out = full, [full]
    for x in a:
        match = row & places.get(x, 0)
        row = ((row + match) | (row - match)) & full
        if every:
            out.append(row)
    return out if every else [row]


def _common(a: list, b: list) -> list[int]:
    shared = set(a) & set(b)
    where = [i for i, x in enumerate(a) if x in shared]
    a, b = [a[i] for i in where], [x for x in b if x in shared]
    if not a:
        return []
    if len(a) * len(b) > LARGE and len(a) > 1:
        # Too large to keep all rows: halve a, and b where the two halves fit best.
        half = len(a) // 2
        left = _growth(_rows(a[:half], b, False)[0], len(b))
        right = _growth(_rows(a[half:][::-1], b[::-1], False)[0], len(b))[::-1]
        cut = max(range(len(b) + 1), key=lambda j: left[j] + right[j])
        found = _common(a[:half], b[:cut]) + [half + i for i in _common(a[half:], b[cut:])]
        return [where[i] for i in found]
    rows, i, j, found = _rows(a, b, True), len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            found.append(where[i - 1])
            i, j = i - 1, j - 1
        elif rows[i] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
    return found[::-1]


def _growth(row: int, size: int) -> list[int]:
    out = [0]
    for bit in reversed(format(row, f"0{size}b")[-size:] if size else ""):
        out.append(out[-1] + (bit == "0"))
    return out


def page_lines(pages: DataFrame) -> DataFrame:
    """Per page its lines, and 1, 0 or null for main text, frame or undecided."""

    @F.pandas_udf("texts array<string>, main array<int>")
    def split_lines(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in by_chars(batch):
                found = [lines(p) for p in part]
                marks = [[None if m is None else int(m) for m in f[1]] for f in found]
                yield pd.DataFrame({"texts": [f[0] for f in found], "main": marks})

    rows = pages.select("page_id", "url", or_empty("html").alias("html"))
    key = F.xxhash64("page_id", "url", "html").alias("key")
    found = split_lines.asNondeterministic()("html").alias("found")
    return rows.select("page_id", "url", key, found).select("page_id", "url", "key", "found.*")


def shared_lines(pages: DataFrame) -> DataFrame:
    """Per distinct page the positions of the lines that its nearest neighbour has too."""
    hashed = page_lines(pages).select(
        "page_id", "key", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        F.transform("texts", lambda t: F.xxhash64(t)).alias("lines"),
    )
    hashed = hashed.dropDuplicates(["page_id", "key"])
    near = with_neighbours(
        hashed, ["host", "path", "page_id", "key"], ["host", "path", "lines"]
    ).where("before.host = host or after.host = host")

    @F.pandas_udf("array<int>")
    def aligned(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for mine, here, before, before_path, after, after_path in batches:
            out = []
            for a, p, b, q, c, r in zip(mine, here, before, before_path, after, after_path):
                if b is None or (c is not None and _begin(p, r) > _begin(p, q)):
                    b = c
                out.append(common(a.tolist(), b.tolist()))
            yield pd.Series(out, index=mine.index, dtype=object)

    def of(side: str, field: str):
        return F.when(F.col(f"{side}.host") == F.col("host"), F.col(f"{side}.{field}"))

    found = aligned.asNondeterministic()(
        "lines", "path", of("before", "lines"), of("before", "path"),
        of("after", "lines"), of("after", "path"),
    )
    return near.select("page_id", "key", found.alias("shared")).where(F.size("shared") > 0)


def _begin(a: str, b: str) -> int:
    """Length of the common beginning."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def main_text(pages: DataFrame) -> DataFrame:
    """Per page its main text, the blocks joined by one space, and the text's length."""
    shared = shared_lines(pages).select(F.col("page_id").alias("of"), "key", "shared")
    rows = page_lines(pages).alias("l").join(
        shared.alias("s"),
        (F.col("l.key") == F.col("s.key")) & F.col("l.page_id").eqNullSafe(F.col("s.of")),
        "left",
    ).select("page_id", "url", "texts", "main", "shared")
    gone = F.transform(
        F.sequence(F.lit(0), F.size("texts")), lambda i: F.array_contains("shared", i)
    )
    undecided = F.exists("main", lambda m: m.isNull())
    rows = rows.withColumn("gone", F.when(undecided & F.col("shared").isNotNull(), gone))
    kept = F.filter(
        "texts", lambda t, i: F.coalesce(F.get("main", i) == 1, ~F.get("gone", i), F.lit(True))
    )
    whole = F.filter("texts", lambda t, i: F.coalesce(F.get("main", i) == 1, F.lit(True)))
    chosen = F.when(F.size("kept") > 0, F.col("kept")).otherwise(F.col("whole"))
    out = rows.select("page_id", "url", kept.alias("kept"), whole.alias("whole"))
    text = F.array_join(chosen, " ")
    return out.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
