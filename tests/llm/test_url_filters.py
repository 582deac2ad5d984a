import duckdb

from sqlsieve.llm import url_filters
from sqlsieve.llm.components import components


def verdicts(spark, urls, links=()):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    edges = spark.createDataFrame(list(links), "a string, b string")
    judged = url_filters.judge(pages, edges)
    assert sorted(judged.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in judged.orderBy("page_id").collect()]


def test_rules(spark):
    got = verdicts(spark, [
        "https://A.Example.NET/en/1?q", "http://b.net/x", "http://b.net", "http://b.net?x/", "http://example.com/de/",
        "http://notexample.com/de/1", "http://x.org/fr/1#top", "http://x.org/fr", None, "no scheme/net/", "",
        "http://net/", "ftp://a://b.net/c",
    ])
    assert got == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("b.net", "/x", "net/", "block"),
        ("b.net", "", None, "allow"), ("b.net", "", None, "allow"),
        ("example.com", "/de/", "example.com/de/", "block"), ("notexample.com", "/de/1", None, "allow"),
        ("x.org", "/fr/1", "org/fr/", "allow"), ("x.org", "/fr", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("net", "/", "net/", "block"),
        ("a:", "//b.net/c", None, "allow"),
    ]


def test_blocks_go_over_to_aliases(spark):
    chain = [f"http://c{i}.com/" for i in range(40)]
    links = [(a, b) for a, b in zip(chain, chain[1:])] + [(chain[39] + "#part", "http://bad.net/x")]
    links += [("http://x.org/fr/1", chain[3]), (None, chain[1]), ("http://free.com/", None), ("http://q.com/", "http://q.com/")]
    got = verdicts(spark, [*chain[::13], "http://x.org/fr/1", "http://free.com/", chain[5] + "#a", chain[5]], links)
    assert [g[3] for g in got] == ["block"] * 4 + ["allow", "allow", "block", "block"]


def test_links_of_pages(spark):
    html = [
        '<link href="/a?x=1&amp;y=2" rel="canonical">', "<LINK REL='canonical' HREF='http://o.net/p'>",
        '<meta http-equiv="refresh" content="0; url=//m.net/z">', '<link rel="stylesheet" href="s.css">', None,
        '<link rel=canonical href=rel.html>',
    ]
    pages = spark.createDataFrame([(i, f"https://h.com/d/{i}#f", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    got = sorted(tuple(r) for r in url_filters.page_links(pages).collect())
    assert got == [
        ("https://h.com/d/0", "https://h.com/a?x=1&y=2"), ("https://h.com/d/1", "http://o.net/p"),
        ("https://h.com/d/2", "https://m.net/z"), ("https://h.com/d/5", "https://h.com/d/rel.html"),
    ]
    found = {r["page_id"]: r["verdict"] for r in url_filters.page_verdicts(pages).collect()}
    assert found == {0: "allow", 1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}
    assert url_filters.page_verdicts(pages.limit(0)).count() == 0


def test_twin_with_planted_links(spark):
    rows = [
        (1, "http://a.org/1", '<link rel="canonical" href="/2">'),
        (2, "http://A.org/2", '<link rel="canonical" href="http://BAD.net/x">'),
        (3, "http://B.example.edu/y/w", '<link rel="canonical" href="z">'),
        (4, "http://b.example.edu/y/z", '<meta http-equiv="refresh" content="0; url=//q.net/">'),
        (5, "HTTP://B.example.edu/y/w#part", None), (6, "http://clean.edu/A", '<link rel="canonical" href="/a">'),
        (7, None, '<link rel="canonical" href="http://bad.net/x">'), (8, "http://x.org/fr/1", '<link rel="canonical" href="http://bad.net/x">'),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    got = sorted(tuple(r[c] for c in columns) for r in url_filters.page_verdicts(pages).collect())
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    assert got == sorted(con.execute(f"select page_id, host, path, rule, verdict from ({url_filters.SQL})").fetchall())
    assert [r[4] for r in got] == ["block"] * 5 + ["allow"] * 3


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 7), (201, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {}
    for r in components(df).collect():
        found.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(sorted, found.values())) == [list(range(202)), list(range(1000, 1300))]
    assert components(df.limit(0)).count() == 0
