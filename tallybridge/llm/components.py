"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm.common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every linked node but the smallest of its component, with that one.

    Both columns are longs; nulls and links of a node to itself count for nothing, repeated links
    for one.  Each round ends in a checkpoint; rounds stop when the stars no longer change.
    """
    edges = cut(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct()
    )
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(first, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = cut(small.union(first.select("u", F.col("m").alias("v"))).distinct())
