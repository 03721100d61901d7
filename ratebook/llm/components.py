"""Connected components of an edge table, by alternating star contraction.

Large-star links every larger neighbour of a node to the node's smallest
neighbour, small-star links the smaller ones and the node itself; repeated,
each component becomes a star around its smallest id in O(log^2 n) rounds.
Both steps are a partial ``min`` per node and a join back, so a node with
millions of neighbours is never gathered into one row (AQE splits its join
partition). Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links -> (id, component): the smallest id reachable, for every id
    that has a link to another. Self links and repeated links change nothing."""
    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u <> v").distinct(), "links")
    mark = None
    while True:
        now = staged(_small_star(_large_star(now)), "stars")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        mark = tuple(seen)
