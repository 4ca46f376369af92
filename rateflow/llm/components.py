"""Connected components of a graph given as a table of links, by alternating star operations.

A large-star step links every larger neighbour of a node to the smallest neighbour, a small-star step every smaller one
(and the node itself). Both keep the components; once nothing changes, every node is linked to the smallest of its
component. Each step is a grouped minimum and a join; its result is stored, which cuts the lineage. The driver sees only
a count and a checksum.
"""

from pyspark.sql import functions as F

from rateflow.llm.common import stored


def _large_star(links):
    near = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = near.groupBy("high").agg(F.min("low").alias("m")).select("high", F.least("m", "high").alias("m"))
    return near.join(least, "high").where("low > high").select(F.col("low").alias("high"), F.col("m").alias("low"))


def _small_star(links):
    least = links.groupBy("high").agg(F.min("low").alias("m"))
    moved = links.join(least, "high").where("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low"))
    return moved.unionByName(least.select("high", F.col("m").alias("low")))


def components(links, a="a", b="b"):
    """(node, component): each linked node with the smallest node it reaches. Links from a node to itself are ignored."""
    links = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where("high > low").distinct()
    links, before = stored(links, "links"), None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if mark == before:
            nodes = links.select(F.col("high").alias("node"), F.col("low").alias("component"))
            return nodes.unionByName(links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())
        before = mark
        if not mark[0]:
            continue
        links = stored(_small_star(_large_star(links).distinct()).where("high > low").distinct(), "links")
