"""Connected components of links between nodes, without gathering any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.shared import leaves_one, stage


def _figures(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()


@leaves_one
def components(links: DataFrame) -> DataFrame:
    """Staged (node, root) of every node in ``links`` (columns u, v): root is the component's least node.

    Large-star and small-star turns: every node hands its neighbours on to the least
    node it knows, until each component is a star. Minima combine on the map side and
    the joins can be split, so a node with any number of links is no one task's work.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    edges = stage(edges, "edges")
    before = None
    while (now := _figures(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large.filter("u > v"), "edges")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        handed = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = handed.unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        edges = stage(small, "edges")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return stage(roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "roots")
