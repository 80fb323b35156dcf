"""Connected components of an edge table by alternating star contractions.

Each round points every node at the smallest node it has seen, first over its larger, then over its smaller neighbours;
the edge count never grows, no group is collected, and a hub's edges are spread by the shuffle.  Every round is written
to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: two columns of comparable nodes.  Returns node, root (the smallest node of its component) for every
    node with an edge to another one; an empty table gives an empty result, loops and repeated edges change nothing."""
    x, y = edges.columns
    state = cut_lineage(edges.filter(F.col(x) != F.col(y))
                        .select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "edges")
    sign = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == sign:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        sign = now
        state = cut_lineage(_small_star(_large_star(state)), "edges")
