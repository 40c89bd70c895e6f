"""Connected components by repeated contraction, entirely as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import discard, stored


def _grandparents(edges: DataFrame) -> DataFrame:
    """Each vertex with the parent of its parent, a parent being the least neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    parent = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p"))
    above = parent.select(F.col("a").alias("p"), F.col("p").alias("root"))
    return parent.join(above, "p").select(F.col("a").alias("node"), "root")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every end of the edges ``(a, b)``; the root is the least vertex reachable.

    Every round maps each vertex to its grandparent and keeps one edge between different
    images. The image of a connected graph is connected and the least vertex stays put, so
    components are kept; each vertex with an edge merges with another one, so the number of
    vertices at least halves. Only the count of the edges left reaches the driver.
    """
    left = stored(edges.where("a <> b").select("a", "b").distinct(), "links")
    mapping = None
    while not left.isEmpty():
        step = stored(_grandparents(left), "parents")
        before = [left]
        if mapping is None:
            mapping = step
        else:
            before += [mapping, step]
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = mapping.join(onward, "root", "left")
            mapping = stored(moved.select("node", F.coalesce("next", "root").alias("root")), "roots")
        of_a = step.select(F.col("node").alias("a"), F.col("root").alias("to_a"))
        of_b = step.select(F.col("node").alias("b"), F.col("root").alias("to_b"))
        ends = left.join(of_a, "a").join(of_b, "b")
        ends = ends.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        left = stored(ends.where("a <> b").distinct(), "links")
        for table in before:
            discard(table)
    if mapping is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return mapping
