"""Allow and block decisions for URLs, carried over to their aliases.

A rule is a host, or a host and the beginning of a path. It fits the host and all its subdomains,
if the URL's path starts with the rule's; of the rules that fit the longest decides. A URL that no
rule fits takes the decision of its aliases: redirects and canonical links make URLs equivalent,
the classes are the connected components of these links, and a class in which a rule blocks a URL
is blocked. An explicit allow goes first: a URL that a rule allows stays allowed whatever its
aliases are, and only block decisions are carried over.

Everything is DataFrame functions. Rules are a short list that the caller states; links are
compared as URLs without a fragment, their schemes and hosts in lower case. Classes come from rounds of joins over the link table, and of
the URLs only those that occur in a link are looked up there.

Rows: a null URL, or one without ``://``, has an empty host and path and fits no rule; repeated
rows give repeated results; links with a null end are ignored; an empty table gives an empty one;
a column of the input that has the name of a new one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, or_empty, others
from .components import components

RULES = (
    ("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)


def host(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark or hash, A-Z lower-cased."""
    found = F.regexp_extract(or_empty(url), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(found)


def path(url: Column) -> Column:
    """What follows the host up to a question mark or hash."""
    return F.regexp_extract(or_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def page(url: Column) -> Column:
    """The URL without its fragment, scheme and host in lower case, by which links and pages meet."""
    whole = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    head = F.regexp_extract(whole, r"(?s)^([^/?]*://[^/?]*)", 1)
    return F.concat(ascii_lower(head), F.substr(whole, F.length(head) + 1))


def rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, null where none does."""
    out = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = (host == name) | host.endswith("." + name)
        out = F.when(fits & path.startswith(slash + rest), F.lit(text)).otherwise(out)
    return out


def decision(rule: Column, rules=RULES) -> Column:
    out = F.lit(None).cast("string")
    for text, verdict in rules:
        out = F.when(rule == text, F.lit(verdict)).otherwise(out)
    return out


def absolute(target: Column, base: Column) -> Column:
    """A link's target as an absolute URL; one that is relative is seen from ``base``."""
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(origin, target))
        .otherwise(F.concat(F.regexp_replace(folder, r"([^/])$", "$1/"), target))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``a`` and ``b``: each page's URL and those that its HTML names as canonical or goes on to."""
    tags = F.expr(
        r"regexp_extract_all(html, '(?is)(<link\\b[^>]*>|<meta\\b[^>]*>)', 1)"
    )
    rows = (
        pages.where(F.col("html").rlike(r"(?is)<link\b[^>]*\bcanonical\b|<meta\b[^>]*\brefresh\b"))
        .where("url is not null")
        .select("url", F.explode(tags).alias("tag"))
    )
    canonical = F.col("tag").rlike(r"""(?is)^<link\b.*\brel\s*=\s*["']?\s*canonical\b""")
    refresh = F.col("tag").rlike(r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?\s*refresh\b""")
    href = F.regexp_extract("tag", r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)""", 1)
    goes = F.regexp_extract("tag", r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)""", 1)
    target = F.replace(F.when(canonical, href).when(refresh, goes), F.lit("&amp;"), F.lit("&"))
    return (
        rows.select("url", target.alias("to"))
        .where("to <> ''")
        .select(page(F.col("url")).alias("a"), page(absolute(F.col("to"), F.col("url"))).alias("b"))
    )


def judge(urls: DataFrame, links: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``links`` has the columns ``a`` and ``b``, redirects and canonical links in either direction.
    """
    kept = others(urls, "host", "path", "rule", "verdict")
    source = urls[f"`{url}`"]
    ruled = urls.select(F.struct(*kept).alias("row"), source.alias("_url"))
    ruled = ruled.select("row", "_url", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"))
    ruled = ruled.withColumn("rule", rule(F.col("host"), F.col("path"), rules))

    links = links.select(page(F.col("a")).alias("a"), page(F.col("b")).alias("b"))
    members = components(links)
    blocked = (
        members.where(decision(rule(host(F.col("node")), path(F.col("node")), rules), rules) == "block")
        .select("root")
        .distinct()
    )
    aliases = members.join(blocked, "root", "left_semi").select("node").distinct()
    out = ruled.withColumn("node", page(F.col("_url"))).join(
        aliases.withColumn("alias", F.lit(True)), "node", "left"
    )
    own = decision(F.col("rule"), rules)
    verdict = F.coalesce(own, F.when(F.col("alias"), "block"), F.lit("allow"))
    return out.select("row.*", "host", "path", "rule", verdict.alias("verdict"))


def page_verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """Per page its host, path, rule and verdict, aliases taken from the pages' own HTML."""
    judged = judge(pages.select("page_id", "url"), page_links(pages), rules=rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH RECURSIVE split AS (
  SELECT page_id, url, html,
    regexp_extract(url, '(?s)^([^#]*)', 1) AS whole,
    regexp_extract(url, '(?s)^([^/?#]*://[^/?#]*)', 1) AS head,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), ruled AS (
  SELECT page_id, translate(head, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      || substr(whole, length(head) + 1) AS node, host, path, CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM split
), tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)(<link\b[^>]*>|<meta\b[^>]*>)', 1)) AS tag
  FROM split WHERE url IS NOT NULL
), targets AS (
  SELECT url, replace(CASE
      WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?\s*canonical\b')
        THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
      WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?\s*refresh\b')
        THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1)
    END, '&amp;', '&') AS t
  FROM tags
), resolved AS (
  SELECT url AS x, CASE
      WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
      WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || t
      WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t
      ELSE regexp_replace(regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1), '([^/])$', '\1/') || t
    END AS y
  FROM targets WHERE t <> ''
), cut AS (
  SELECT regexp_extract(x, '(?s)^([^#]*)', 1) AS x, regexp_extract(y, '(?s)^([^#]*)', 1) AS y,
    regexp_extract(x, '(?s)^([^/?#]*://[^/?#]*)', 1) AS p, regexp_extract(y, '(?s)^([^/?#]*://[^/?#]*)', 1) AS q
  FROM resolved
), links AS (
  SELECT translate(p, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || substr(x, length(p) + 1) AS a,
    translate(q, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || substr(y, length(q) + 1) AS b
  FROM cut
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), ends AS (
  SELECT DISTINCT a AS node, regexp_extract(a, '(?s)^.*?://([^/?#]*)', 1) AS host,
    regexp_extract(a, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM edges
), reached AS (
  SELECT node FROM ends
  WHERE ((host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/')
      AND NOT ((host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/')))
    OR ((host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/'))
  UNION
  SELECT edges.b FROM reached JOIN edges ON reached.node = edges.a
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN node IN (SELECT node FROM reached WHERE node IS NOT NULL) THEN 'block'
    ELSE 'allow'
  END AS verdict
FROM ruled
"""
