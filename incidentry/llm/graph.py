"""Connected components by alternating star contractions, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentry.sources.workspace import stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, root) for every node of the links but the roots themselves.

    The root is the least node of the component. Nulls and loops are left out.
    Each round points neighbours at the least node around them and is written
    to the shared folder, so a lost executor repeats one round at most. Rounds
    grow with the logarithm of the longest chain.
    """
    edges = _distinct(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")), links.sparkSession)
    before = None
    while (state := _state(edges)) != before:
        before = state
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = _distinct(large, links.sparkSession)
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = _distinct(small.union(least), links.sparkSession)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _distinct(edges: DataFrame, spark) -> DataFrame:
    return stage(edges.where("a <> b").distinct(), "edges")


def _state(edges: DataFrame) -> tuple:
    """Count and checksum, from which a round that changed nothing is known."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 30))),
            F.sum(F.pmod(F.xxhash64("b", "a"), F.lit((1 << 30) - 35))),
        ).first()
    )
