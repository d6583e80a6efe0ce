"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, join_counted


def star_components(edges: DataFrame) -> DataFrame:
    """``node, root`` (bigint) for each node of ``edges(u, v)`` but the roots; root is the smallest node it reaches.

    Each round joins every node with the least of its neighbours, first for the
    larger neighbours, then for the smaller; rounds grow with the logarithm of
    the largest component.  A node that a large share of the edges meet is
    joined where the edges are.  Only a count and a hash of the edges come to the
    driver.  Nulls, loops and repeated edges are ignored; no edges give no rows.
    """
    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    before = None
    while True:
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = cut(join_counted(both, least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_counted(large, least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = cut(small.select("e.u", "e.v").filter("u > v").distinct())
