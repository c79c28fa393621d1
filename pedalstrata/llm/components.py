"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is an aggregate and a join over the links, written to shared storage, so neither a
component nor the links of one node are ever gathered. Each pair of steps about halves the height
of what is left, so a few rounds do for stars and log2 of the length for chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalstrata.sources.staging import discard, stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    # Decimal: the sum of hashes must not overflow.
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node ``root`` of its component, for every node with links.

    ``links`` has long columns ``u`` and ``v``; repeated links and self-links are harmless, links
    with a null end are ignored. Nodes that only link to themselves have no row.
    """
    edges = stage(links.where("u <> v").select("u", "v").distinct())
    before = None
    while (now := _mark(edges)) != before:
        larger = stage(_large_star(edges).distinct())
        smaller = stage(_small_star(larger).distinct())
        discard(edges)
        discard(larger)
        edges, before = smaller, now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
