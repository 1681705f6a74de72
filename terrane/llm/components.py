"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step groups edges by a node and takes a minimum, so Spark combines before it shuffles and no neighbourhood is
gathered anywhere; a hot node's edges meet their node's minimum in a join that adaptive execution can split. Every
round is written to the shared folder, so its lineage stays short and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.storage import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a > b). Each node's neighbours are hung on the least of them and itself: the larger
    ones (`large`) or the smaller ones and the node."""
    if large:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        # Only the larger neighbours are hung anew.
        hung = both.where("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        smaller = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).join(least, "node")
        hung = smaller.select(F.col("other").alias("a"), F.col("least").alias("b")).union(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return hung.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge and is not the least of its component, `root` being that least one.

    `edges`: two long columns a and b. Loops, repeated and reversed edges are harmless.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = saved(edges, "edges")
    mark = None
    while True:
        # Stars only: no node is both a leaf and a centre, and no leaf hangs on two. Two numbers tell of a change.
        edges = saved(_star(_star(edges, True), False), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(state) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(state)
