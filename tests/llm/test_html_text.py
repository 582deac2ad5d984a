import random

import pytest

from sqlsieve.llm import html_text as h


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("large", [h.LARGE, 20])
def test_common_subsequence(monkeypatch, large):
    monkeypatch.setattr(h, "LARGE", large)
    rng = random.Random(large)
    for _ in range(500):
        a = [rng.randint(0, 5) for _ in range(rng.randint(0, 14))]
        b = [rng.randint(0, 5) for _ in range(rng.randint(0, 14))]
        found = h.common(a, b)
        rest = iter(b)
        assert found == sorted(set(found)) and len(found) == longest(a, b)
        assert all(a[i] in rest for i in found)


def test_common_of_long_lists():
    a, b = list(range(0, 40_000, 2)), list(range(0, 40_000, 3))
    assert h.common(a, b) == [i for i, x in enumerate(a) if x % 3 == 0]


PAGES = [
    ("<nav>menu</nav><article><h1>T</h1><p>One <b>two</b>three&nbsp;&amp; 4<br>five</p></article><footer>f</footer>", "T One twothree & 4 five"),
    ("<article><p><b>a<br><p>b &copy x</article><aside>s</aside>", "a b © x"),
    ("<body><header>h</header><main><p>x</p><div class='ad'>ad</div><form>f</form>y</main><div>z</div>", "x y"),
    ("<article>x<div id=comments><p>no</p></div><!-- c --><script>var t='</p>'</script><style>p{}</style>y", "x y"),
    ("<div class='cookie-notice'>n</div><p>plain</p><div hidden>g</div><p style='display: none'>g</p>text", "plain text"),
    ("<article><p title='a > b'>x</p><article class=comment>no</article><p>y", "x y"),
    ("<title>t</title><p>cut &am", "cut &am"), ("", ""), ("   ", ""), ("no markup at all", "no markup at all"), ("<", "<"),
]


def test_single_pages(spark):
    """Each on a host of its own, so that there is nothing to compare it with."""
    rows = [(i, f"http://h{i}.com/a", html) for i, (html, _) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in h.main_text(pages).collect()}
    assert found == {i: (text, len(text)) for i, (_, text) in enumerate(PAGES)}


WRAPPED = [
    ("<div class='content-sidebar-wrap'><main><article><p>body</p></article></main><aside>s</aside></div>", "body"),
    ("<h1>S</h1><div class='site has-sidebar'><article><p>body</p><div class=share>no</div></article></div>", "body"),
    ("<div id='no-sidebar'><main><p>body</p></main></div>", "body"),
    ("<body><form id=aspnetForm><nav>n</nav><article><p>body</p></article><div class=footer>f</div></form>", "body"),
    ("<form><p>body</p><button>go</button><div class=sidebar>s</div></form>", "body"),
    ("<article><h1>T</h1><div class='with-ads'><div itemprop=articleBody>body</div>ad</div></article>", "T body"),
    ("<main><h1>T</h1><div class='with-ads'><article>body</article></div></main>", "body"),
    ("<article>body</article><div class=related><article>a longer teaser</article></div>", "body"),
    ("<p>body</p><div id=comments><article>a much longer reply</article></div>", "body"),
    ("<article>body<div class=related><article>a longer teaser</article></div></article>", "body"),
]


@pytest.mark.parametrize("page, text", WRAPPED)
def test_wrappers_do_not_swallow_the_article(page, text):
    texts, main = h.lines(page)
    assert " ".join(t for t, m in zip(texts, main) if m is not False) == text


def test_shared_lines_go(spark):
    page = lambda *own: "<p>Our site</p>" + "".join(f"<p>{o}</p>" for o in own) + "<p>All rights reserved</p>"
    rows = [
        (1, "http://h.com/a/1", page("one", "two"), "x"), (2, "http://h.com/a/2", page("three"), "x"),
        (3, "http://h.com/z", "<p>alone</p><p>Our site</p>", "x"), (4, "http://other.com/a/1", page("four"), "x"),
        (5, "http://copy.com/1", page("five"), "x"), (6, "http://copy.com/1", page("five"), "x"), (6, "http://copy.com/1", page("five"), "x"),
        (7, None, None, None), (8, None, "<p>eight</p>", "x"), (None, "nothing", "<p>nine</p>", "x"),
        (10, "http://m.com/1", "<p>Our site</p><article><p>same</p><p>ten</p></article>", "x"),
        (11, "http://m.com/2", "<p>Our site</p><article><p>same</p><p>eleven</p></article>", "x"),
        (12, "http://long.com/1", "<p>line</p>" * 3000 + "<p>" + "word " * 20_000 + "</p>", "x"),
        (13, "http://long.com/2", "<p>line</p>" * 3000 + "<p>end</p>", "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, texts string")
    found = h.main_text(pages).collect()
    assert len(found) == len(rows)
    got = {r["page_id"]: r["text"] for r in found}
    whole = "Our site five All rights reserved"
    assert got == {
        1: "one two", 2: "three", 3: "alone", 4: "Our site four All rights reserved", 5: whole, 6: whole, 7: "", 8: "eight",
        None: "nine", 10: "same ten", 11: "same eleven", 12: " ".join(["word"] * 20_000), 13: "end",
    }
    assert h.main_text(pages.limit(0)).count() == 0
