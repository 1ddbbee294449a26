"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that ``links(a, b)`` names but the smallest ones: the smallest node it reaches.

    Each round hangs every node's larger neighbours, then its smaller ones, below the smallest of
    them. All of it is aggregations and joins by node; nothing is collected but two numbers a round.
    """
    a, b = F.col("a"), F.col("b")
    edges = stored(links.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    mark = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        edges = stored(small.union(lowest.select("hi", "m")).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        mark = now
