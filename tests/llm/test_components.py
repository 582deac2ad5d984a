import random
from fractions import Fraction

from sqlsieve.llm import components as c
from sqlsieve.llm import jaccard_join as j

from .test_jaccard_join import brute, corpus


def parts(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    out = {}
    for x in parent:
        out.setdefault(root(x), set()).add(x)
    return sorted(map(sorted, out.values()))


def found(roots):
    out = {}
    for r in roots.collect():
        out.setdefault(r["root"], set()).add(r["node"])
    assert all(root in members for root, members in out.items())
    return sorted(map(sorted, out.values()))


def graphs():
    rng = random.Random(4)
    path = [(f"p{i}", f"p{i + 1}") for i in range(300)]
    star = [("s0", f"s{i}") for i in range(1, 300)]
    loose = [(f"r{rng.randrange(300)}", f"r{rng.randrange(300)}") for _ in range(200)]
    return path, star, [(a, b) for a, b in loose if a != b]


def test_no_plan_holds_more_than_one_step(spark, monkeypatch):
    """The driver keeps plans whole: one over all rounds was most of what it held."""
    joins, stored = [], c.stored

    def counted(df, name, *more):
        joins.append((name, df._jdf.queryExecution().analyzed().toString().count("Join ")))
        return stored(df, name, *more)

    monkeypatch.setattr(c, "stored", counted)
    edges = [edge for graph in graphs() for edge in graph]
    table = spark.createDataFrame([*edges, edges[0], ("x", "x"), (None, "p1")], "a string, b string")
    roots = c.components(table)
    assert found(roots) == parts(edges)
    assert max(n for _, n in joins) <= 2
    assert roots._jdf.queryExecution().analyzed().toString().count("Join ") == 0

    joins.clear()
    star = graphs()[1]
    assert found(c.components(spark.createDataFrame(star, "a string, b string"))) == parts(star)
    assert len(joins) <= 4  # one round


def test_later_edges_are_merged_with_what_is_known(spark):
    edges = [edge for graph in graphs() for edge in graph]
    random.Random(5).shuffle(edges)
    table = lambda rows: spark.createDataFrame(rows, "a string, b string")
    roots = c.components(table([]))
    assert found(roots) == []
    for begin in range(0, len(edges), 250):
        roots = c.merged(roots, table(edges[begin : begin + 250]))
        assert found(roots) == parts(edges[: begin + 250])
    assert found(c.merged(roots, table([]))) == parts(edges)


def test_links_of_a_round_are_not_gone_over_in_the_next(spark, monkeypatch):
    given = []

    def noted(work):
        def call(*args):
            given.append([(bytes(r["a"]), bytes(r["b"])) for r in args[-1].collect()])
            return work(*args)

        return call

    monkeypatch.setattr(j, "components", noted(j.components))
    if hasattr(j, "merged"):
        monkeypatch.setattr(j, "merged", noted(j.merged))
    for name, value in {"LIST_BLOCK": 3, "GROUP_PART": 2, "FOREST_PAIRS": 3, "CHUNK_ROWS": 5, "CHUNK_SHINGLES": 300}.items():
        monkeypatch.setattr(j, name, value)
    rows = corpus(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in j.components_of(docs, 2, Fraction(3, 5)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, 2, Fraction(3, 5)), key=str)
    links = [link for call in given for link in call]
    assert len(given) > 1 and len(links) == len(set(links))


def test_what_follows_the_classes_is_planned_without_them(spark):
    docs = spark.createDataFrame(corpus(1), "doc_id long, text string")
    plan = j.one_of_each(docs)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join ") == 1
