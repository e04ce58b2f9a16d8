"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plimsoll.sources.stage import staged


def _hooked(edges: DataFrame) -> DataFrame:
    """v, root: every end of the edges under its least neighbour, or itself where none is less, then followed up.

    A parent is less than its child, so the hooks form trees; parents are replaced by their own parents,
    which halves the height of every tree each time, until all are roots.
    """
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select("b", "a"))
    found = staged(both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("root")))
    while True:
        above = found.where("root <> v").select(F.col("v").alias("root"), F.col("root").alias("next"))
        moved = staged(found.join(above, "root", "left").select(
            "v", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        found = moved.select("v", "root")
        if moved.where("moved").isEmpty():
            return found


def components(edges: DataFrame) -> DataFrame:
    """v, root for every end of the edges (a, b): the least vertex that can be reached.

    Each round hooks the vertices into trees, makes each tree one vertex, its root, and goes on with
    the edges between trees. A vertex with an edge is in a tree of two or more, so a round at least
    halves the vertices that have edges left, whatever the shape of the graph. The rounds are then
    undone from the last, which is the smallest. Vertices without edges but to themselves have no row.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    rounds = [_hooked(edges)]
    while True:
        root = rounds[-1]
        ends = edges.join(root.select(F.col("v").alias("a"), F.col("root").alias("x")), "a").join(
            root.select(F.col("v").alias("b"), F.col("root").alias("y")), "b").where("x <> y")
        edges = staged(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if edges.isEmpty():
            break
        rounds.append(_hooked(edges))
    found = rounds.pop()
    while rounds:
        above = found.select(F.col("v").alias("root"), F.col("root").alias("next"))
        found = staged(rounds.pop().join(above, "root", "left").select("v", F.coalesce("next", "root").alias("root")))
    return found
