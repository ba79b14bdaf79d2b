"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.operators.sizes import materialise


def _tops(edges: DataFrame) -> DataFrame:
    """(node, up) for every end of ``edges``: each node hangs on its smallest neighbour, if that is smaller, and ``up`` is the
    top of the tree that this gives. Every jump halves what is left of the way, over nodes and not over edges."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("up")),
                                          F.struct(F.col("b").alias("node"), F.col("a").alias("up")))).alias("e")).select("e.*")
    tops = materialise(ends.groupBy("node").agg(F.min("up").alias("up")).select("node", F.least("node", "up").alias("up")))
    while True:
        above = tops.select(F.col("node").alias("_n"), F.col("up").alias("_up"))
        jumped = materialise(tops.join(above, F.col("up") == F.col("_n")).select(
            "node", F.col("_up").alias("up"), (F.col("_up") < F.col("up")).alias("moved")))
        tops = jumped.select("node", "up")
        if jumped.filter("moved").isEmpty():
            return tops


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): root is the smallest node of its component.

    Every round replaces the ends of all edges by the tops of their trees and keeps distinct edges between different ones,
    so later rounds work on what is left of the graph instead of on all edges again. Edges and labels are checkpointed per
    round; nothing but the answer whether edges are left reaches the driver.
    """
    left = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    labels = None
    while labels is None or not left.isEmpty():
        tops = _tops(left)
        of = tops.select(F.col("node").alias("root"), "up")
        labels = tops.withColumnRenamed("up", "root") if labels is None else materialise(
            labels.join(of, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        a, b = (tops.select(F.col("node").alias(x), F.col("up").alias(f"{x}_up")) for x in "ab")
        moved = left.join(a, "a").join(b, "b").filter("a_up <> b_up")
        left = materialise(moved.select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct())
    return labels
