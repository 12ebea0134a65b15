"""Connected components of a graph kept as an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.operators.scratch import settle

ROUNDS = 60


def _least_neighbour(links: DataFrame) -> DataFrame:
    """``u, least``: the smallest of ``u`` and the ``v`` it is linked to."""
    return links.groupBy("u").agg(F.min("v").alias("least")).select(
        "u", F.least("u", "least").alias("least")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges (a, b)``; a component is named by
    its smallest node.

    Large-star and small-star steps turn every component into a star around that
    node. Steps aggregate the smallest neighbour (combined before the shuffle) and
    join it back, so a hub is one aggregate row and a join Spark can split. Each
    round is settled; only a count and a checksum reach the driver. Nodes without
    an edge do not appear.
    """
    one_way = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    state = settle(one_way.distinct())
    before = None
    for _ in range(ROUNDS):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least_neighbour(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .where(F.col("u") != F.col("v")).distinct()
        )
        met = large.join(_least_neighbour(large), "u")
        small = met.select("u", F.col("least").alias("v")).unionByName(
            met.select(F.greatest("v", "least").alias("u"), F.least("v", "least").alias("v"))
        )
        state = settle(small.where(F.col("u") != F.col("v")).distinct())
        now = state.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v"))
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
