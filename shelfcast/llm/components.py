"""Connected components of an edge table, by large and small stars.

A large star ties every larger neighbour of a node to the smallest of its neighbourhood, a
small star does so for the smaller ones. Both keep components as they are, and repeating
them ends in one star around each component's smallest node. Edges stay in tables of the
shared folder between rounds; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import written

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    ties = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return ties.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges go from the larger node u to the smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (a, b) with the smallest node it is tied to."""
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = written(links.filter(F.col("a") != F.col("b")).select(high, low).distinct(), "stars")
    seen = _print(edges)
    for _ in range(MAX_ROUNDS):
        edges = written(_small_star(_large_star(edges)), "stars")
        now = _print(edges)
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
