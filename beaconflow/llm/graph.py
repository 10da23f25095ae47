"""Connected components of links between ids, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconflow.session import shared_table


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``u``, or ``u`` itself if that is smaller."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; ``links`` has long columns a and b.

    Alternates two steps until nothing changes: each node hands its larger
    neighbours to the smallest id it sees, then its smaller ones. Stars stay
    stars, so a hub costs one row for each neighbour and a round, never a pair
    of neighbours. Rounds grow with the logarithm of the longest chain; each
    is written to the shared folder, which cuts the lineage. Loops and nulls
    are left out; no link gives an empty result.
    """
    pair = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = shared_table(pair, "component_edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        up = up.where("u != v").distinct()
        least = _least(up)
        down = up.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = shared_table(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "component_edges")
        ids = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if ids(after) == ids(edges):
            break
        edges = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
