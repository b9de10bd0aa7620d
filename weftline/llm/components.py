"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import discard, stored


def _stars(edges: DataFrame) -> bool:
    """Whether every component is a star about its smallest node: no node is both the larger end of an edge and the smaller one of another."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("side")), F.struct(F.col("v").alias("node"), F.lit(2).alias("side")))).alias("e"))
    sides = ends.select("e.*").groupBy("node").agg(F.bit_or("side").alias("sides"), F.count_if(F.col("side") == 1).alias("up"))
    return sides.where("sides = 3 OR up > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, comp for each node of edges (columns a, b): comp is the smallest node of its component.

    Edges always point from a larger node u to a smaller v. A large-star step hangs all larger neighbours of a node on its
    smallest one, a small-star step the smaller ones; both aggregate before they shuffle and end when every component is a
    star, which one aggregation tells. Each step ends in a table in the shared folder. Self-links and repeated edges change nothing; null ends are dropped."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _stars(now):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: each u > v of node v goes to the least node about v.
        large = now.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large_star")
        # Small star: node u and its smaller neighbours go to the least of them.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        last, now = now, stored(hung, "small_star")
        discard(last, large)
    found = now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
    found._weftline_path = now._weftline_path  # discard() of the result deletes the table behind it
    return found
