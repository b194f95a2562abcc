"""Connected components of an edge table by alternating star contraction.

Each round is two grouped minima and joins on the node (a node with many links shuffles as
many rows as it has links; AQE splits it in the join), and is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(low, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    stars = down.join(low, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stars.union(low.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a link, root the least node of its component.

    ``edges`` has long columns a and b; loops and repeated edges are allowed."""
    spark = edges.sparkSession
    now = stored(spark, edges.select("a", "b").filter("a != b").distinct(), "links")
    seen = None
    while True:
        now = stored(spark, _small_star(_large_star(now)), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
