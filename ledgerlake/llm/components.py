"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, settle


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(u, v, m) for each neighbour v of u, in both directions; m: the least of u and its neighbours.

    The minimum is pre-aggregated before the shuffle and joined back, so that a hub's
    neighbours never have to meet in one task: AQE may split that join.
    """
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least.select("u", F.least("u", "m").alias("m")), "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node around it."""
    around = _least_neighbour(edges)
    return around.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    smaller = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges(u, v)``; the component is its smallest node.

    Nulls and self links are left out; repeated links change nothing. The number of rounds
    grows with the logarithm of the longest path. Only a count and two checksums of the links
    reach the driver.
    """
    work = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = settle(work, "links")
    seen = _state(current)
    while seen[0]:
        following = settle(small_star(large_star(current)), "links")
        state = _state(following)
        discard(current)
        current = following
        if state == seen:
            break
        seen = state
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
