"""Connected components of a graph given by edges, as DataFrame steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.session import stored


def hung_up(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: each node keeps the edge to its least neighbour below it, and the
    other neighbours below are tied to that one instead."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return least.withColumnRenamed("least", "b").unionByName(tied).distinct()


def _roots(parent: DataFrame) -> DataFrame:
    """``node`` and the end of its way from parent to parent, as ``up``; ways double in each round."""
    while True:
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("next"))
        step = stored(parent.join(above, "up").select("node", "up", "next"), "parents")
        if step.where("next <> up").isEmpty():
            return step.select("node", "up")
        parent = step.select("node", F.col("next").alias("up"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it is connected with, for each node of ``edges`` (a, b).

    In each round every node points to its least neighbour, or to itself, and follows the pointers to their end;
    the ends, joined by the edges between their followers, are the graph of the next round, which has half the
    nodes at most. Counts are combined by each task before they are shuffled, and each round is written to the
    shared folder.
    """
    edges = stored(hung_up(stored(edges.select("a", "b"), "edges")), "edges")
    rounds: list[DataFrame] = []
    while not rounds or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        rounds.append(_roots(stored(parent.select("node", F.least("node", "b").alias("up")), "parents")))
        of_a = rounds[-1].select(F.col("node").alias("a"), F.col("up").alias("c"))
        of_b = rounds[-1].select(F.col("node").alias("b"), F.col("up").alias("d"))
        ends = edges.join(of_a, "a").join(of_b, "b").select(F.col("c").alias("a"), F.col("d").alias("b"))
        edges = stored(hung_up(stored(ends, "edges")), "edges")

    def followed(below: DataFrame, above: DataFrame) -> DataFrame:
        above = above.select(F.col("node").alias("up"), F.col("up").alias("top"))
        return below.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"))

    return stored(reduce(followed, rounds).select("node", F.col("up").alias("component")), "components")
