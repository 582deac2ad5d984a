"""Connected components of a graph given as an edge table, on Spark alone.

Each round every node points at the node that comes first, in an order drawn anew for the round,
among itself and those up to two edges away; the graph is then rewritten in terms of the nodes
pointed at. Nodes that point at the same one become one, so the edges left shrink by a constant
factor a round on average on chains, and a star is one node after the first. A node's own neighbours
are only ever reduced to one minimum, with partial aggregation, so a node with very many of them is
no hot group; joins are of written tables, so that adaptive execution can split them.

The tables of a round are written one by one. No plan holds more than one step, as the driver keeps
plans whole and plans them anew whenever one of their stages ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``: equal for two nodes if and only if a path links them.

    ``edges`` has the columns ``a`` and ``b`` of one orderable type. Nulls and loops are ignored;
    nodes without an edge do not occur in the result. A root is a node of its component. What is
    written to the shared folder goes again, but for the result, which ``drop_stored`` removes.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        seed = F.lit(len(steps))
        rank = lambda name: F.struct(F.xxhash64(name, seed).alias("h"), F.col(name).alias("n"))  # noqa: E731,B023
        both = edges.union(edges.select("b", "a"))
        first = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("other"))
        near = stored(first.select("node", F.least("other", rank("node"))["n"].alias("to")), "nearest")
        # A neighbour points at this node or at one that comes before it, and so does the first of them.
        seen = both.join(near.select(F.col("node").alias("b"), "to"), "b")
        to = seen.groupBy(F.col("a").alias("node")).agg(F.min(rank("to"))["n"].alias("to"))
        to = stored(to, "pointers")
        steps.append(to)
        left = (
            edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .where("a <> b")
            .distinct()
        )
        before, edges = edges, stored(left, "edges")
        drop_stored(near, before)
    if not steps:
        return _kept(edges, edges.select(F.col("a").alias("node"), F.col("a").alias("root")))
    # From the last round back: a node's root is that of the node it points at.
    roots = _kept(steps[-1], steps[-1].select("node", F.col("to").alias("root")))
    for to in reversed(steps[:-1]):
        later = roots.select(F.col("node").alias("to"), F.col("root").alias("end"))
        found = to.join(later, "to", "left").select("node", F.coalesce("end", "to").alias("root"))
        before, roots = roots, stored(found, "components")
        drop_stored(to, before)
    drop_stored(edges)
    return roots


def merged(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``components`` of all edges so far, from those of the earlier ones and the ``edges`` that came since.

    Only roots and new nodes are gone over, not the earlier edges. ``roots`` is dropped.
    """
    side = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
    edges = edges.select("a", "b").join(side("a"), "a", "left").join(side("b"), "b", "left")
    ends = components(edges.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
    later = ends.select(F.col("node").alias("root"), F.col("root").alias("end"))
    moved = roots.join(later, "root", "left").select("node", F.coalesce("end", "root").alias("root"))
    new = ends.join(roots.select("node"), "node", "left_anti").select("node", "root")
    out = stored(moved.union(new), "components")
    drop_stored(roots, ends)
    return out


def _kept(table: DataFrame, view: DataFrame) -> DataFrame:
    """``view``, with the path by which ``drop_stored`` removes the written ``table`` below it."""
    view.stored_path = table.stored_path
    return view
