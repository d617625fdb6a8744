"""Connected components by alternating large and small stars, in joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (large star) or smaller neighbours of each node on its least one.

    A node's neighbours are never gathered: their least is aggregated and joined
    back, so a node with any number of them is split like any hot key.
    """
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges  # a > b
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
    hung = near.join(least, "a").select("a", "b", "root")
    if large:
        moved = hung.where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        moved = hung.select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(
            hung.select("a", F.col("root").alias("b"))
        )
    return moved.where("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the least node that each node of ``edges(a, b)`` can reach.

    Loops and repeated edges do no harm; no edges give no rows. Every round is
    written to the shared folder, so plans stay short; rounds grow with the
    logarithm of the longest chain.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = stored(edges.where("a <> b").select(*ends).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
        now = stored(_star(stored(_star(now, True), "large-star"), False), "small-star")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
