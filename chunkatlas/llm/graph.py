"""Connected components of a table of edges, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _least(edges: DataFrame, own: str, other: str) -> DataFrame:
    """(own, m): the least of a node and its neighbours. Minima combine in the tasks."""
    return (edges.groupBy(own).agg(F.min(other).alias("m"))
            .select(own, F.least(own, "m").alias("m")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node on an edge; root is the least node that it is connected to.

    Alternates the two star operations until they change nothing: the larger neighbours of each
    node, then the smaller ones, are linked to the least neighbour. A round keeps at most the edges
    there were, and the number of rounds grows with the logarithm of the longest path. Each round
    is written to the shared folder, so lineage stays short; of a round only the number of edges
    and a checksum reach the driver.
    """
    now = materialize(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    last = None
    while True:
        # Large star: every node sees all its neighbours.
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_least(both, "u", "v"), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large, "edges")
        # Small star: each node sees its smaller neighbours.
        least = _least(large, "u", "v")
        now = materialize(large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = tuple(now.agg(F.count(F.lit(1)), F.coalesce(F.sum(
            F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first())
        if state == last:
            return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .union(now.select("v", "v").distinct()))
        last = state
