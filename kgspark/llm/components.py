"""Connected components by contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.llm.common import cut


def components(edges: DataFrame, source: str = "u", target: str = "v") -> DataFrame:
    """The smallest id reachable from each id that has an edge: ``id``, ``component``.

    Each round every node points at its smallest neighbour (or itself), pointers are followed once more, and nodes with one
    pointer become one node. A round at least halves every component that is left; the loop ends when no edge is.
    Null ends and loops are ignored; repeated edges count once.
    """
    left = edges.select(F.col(source).alias("u"), F.col(target).alias("v")).filter("u <> v")
    left = cut(left.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    nodes = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("v"), F.col("u")))
        lowest = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.least("u", "v").alias("to"))
        lowest = cut(lowest, "pointers")
        step = lowest.join(lowest.select(F.col("id").alias("to"), F.col("to").alias("further")), "to").select("id", F.col("further").alias("to"))
        step = cut(step, "contracted")
        nodes = step if nodes is None else cut(
            nodes.join(step.select(F.col("id").alias("to"), F.col("to").alias("further")), "to", "left").select("id", F.coalesce("further", "to").alias("to")), "nodes"
        )
        of = step.select(F.col("id").alias("u"), F.col("to").alias("a")), step.select(F.col("id").alias("v"), F.col("to").alias("b"))
        moved = left.join(of[0], "u").join(of[1], "v").filter("a <> b")
        left = cut(moved.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    if nodes is None:
        return left.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.select("id", F.col("to").alias("component"))
