"""Connected components of a graph given as pairs of long ids, by alternating large-star and small-star rounds.

Every round is two joins of the edges with each node's smallest neighbour; nothing is gathered per component, and a
node with very many edges (the centre a large component contracts to) is broadcast, not shuffled (``join_counted``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semjoin.llm.common import join_counted, stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; self-loops allowed): root = smallest node reachable."""
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        n = now.count()
        if not n:
            break
        # large star: every larger neighbour of u is tied to the smallest of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "stars")
        large = join_counted(both, least, ["u"], "n", 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.filter("u <> v").distinct(), "edges")
        # small star: u and its smaller neighbours are tied to the smallest of them
        low = stage(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "stars")
        met = join_counted(large, low, ["u"], "n", large.count())
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = stage(small.filter("u <> v").distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
