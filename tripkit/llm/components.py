"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.session import materialize


def lowest(edges: DataFrame) -> DataFrame:
    """Per ``u``, the least of itself and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is its least reachable node.

    Each round reads and writes the edges a bounded number of times, minima are combined before
    the shuffle, and the join that follows has one row per node on its small side, so a node
    with very many edges can be split. Rounds grow with the logarithm of a component's size.
    Loops and repeated edges do no harm; nulls are dropped.
    """
    edges = materialize(edges.select("u", "v").where("u <> v").distinct())
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        large = (both.join(lowest(both), "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        joined = down.join(lowest(down), "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(joined.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
