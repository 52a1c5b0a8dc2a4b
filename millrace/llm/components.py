"""Connected components of a graph that no machine can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Workspace


def connected_components(links: DataFrame, work: Workspace) -> DataFrame:
    """``node, component`` for every node of the undirected ``links`` (columns ``a``, ``b``, both long).

    The component is its smallest node. Each round points the larger neighbours of every node at the smallest
    one (large star), then its smaller neighbours (small star), until nothing changes; the number of rounds
    grows with the logarithm of the longest path. Minima combine inside the tasks before rows move, the joins
    can split a node with many links, and each round is written to the shared folder. Nulls, loops and
    repeated links change nothing; no links give no rows.
    """
    edges = work.keep(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = work.keep(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        now = _state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Equal before and after a round only if the round changed nothing."""
    sums = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
    )
    return tuple(sums.first())
