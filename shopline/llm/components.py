"""Connected components as DataFrame rounds (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopline.llm.common import drop, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every node that has an edge; component is the
    smallest id of its connected component.

    Ids may be of any type that can be ordered.  Each round replaces the edges
    by shorter ones to smaller ids: first every node's larger neighbours are
    tied to its smallest one, then its smaller neighbours.  Rounds needed grow
    with the logarithm of the longest path.  A node with very many neighbours
    costs one map-side minimum and a join that Spark may split.  The driver
    sees two numbers a round; each round is a stored table, so that a lost
    executor never sets the work back to its start.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = stored(edges.select(u, v).filter("u != v").distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        drop(before)
        drop(large)
        # Done when all edges are stars: one root a node, and no root below another.
        edges_now, nodes = now.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        if edges_now == nodes and now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
    root = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(root)
