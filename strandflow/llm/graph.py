"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def _star(edges: DataFrame, mins: DataFrame) -> DataFrame:
    """edges (u, v) with the least neighbour of u; both sides are written tables, so a hub's rows can be split."""
    return edges.join(keep(mins, "cc-least"), "u")


def _oriented(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()


def connected_components(pairs: DataFrame) -> DataFrame:
    """pairs: a, b (long). Returns node and label, the least node of its component, for each node of a pair.

    Each round is a few joins and grouped minima, whose results are written to the shared
    folder; rounds grow with the logarithm of a component's diameter.
    """
    edges, sign = keep(_oriented(pairs), "cc-edges"), None
    while True:
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(seen) == sign or seen[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        sign = tuple(seen)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        edges = keep(_oriented(large.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))), "cc-large")
        small = _star(edges, edges.groupBy("u").agg(F.min("v").alias("m")))
        pairs = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = keep(_oriented(pairs), "cc-small")
