"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links (a, b)``.

    Alternates large-star and small-star steps until nothing changes: each
    replaces a node's links by links to its smallest neighbour, so a row per
    link is all that moves, and the number of rounds grows with the logarithm
    of the longest path.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = stored(
            large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(small.select("u", F.col("m").alias("v"))).distinct(),
            "edges",
        )
        after = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
