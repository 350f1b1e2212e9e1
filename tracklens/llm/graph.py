"""Connected components of a table of links, as rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.session import written

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node in ``links`` (``a, b``): the smallest node its links lead to.

    Alternates two steps until nothing changes: every node hands the smallest node around it to its larger
    neighbours, then to its smaller ones. The number of rounds grows with the logarithm of the longest chain. The
    links of a round are written to the shared folder, so that a lost executor costs one round; the smallest
    neighbour is an aggregate, so a node with very many links is combined before the shuffle.
    """
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")
    )
    edges = written(edges.distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        large = _large_star(edges)
        edges = written(_small_star(large), "links")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if after == before:
            return _named(edges)
        before = after
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it, itself included."""
    both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
    least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
    moved = both.where(F.col("u") > F.col("v")).join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.where(F.col("v") != F.col("u")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node's smaller neighbours, and itself, to the smallest of them. Rows have ``v > u``."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").where(F.col("u") != F.col("m")).select(F.col("u").alias("v"), F.col("m").alias("u"))
    own = least.select("v", F.col("m").alias("u"))
    return moved.unionByName(own).where(F.col("v") != F.col("u")).distinct()


def _named(edges: DataFrame) -> DataFrame:
    """Settled links are stars: each node has one link, to its component's smallest node."""
    named = edges.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
    centres = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return named.unionByName(centres)
