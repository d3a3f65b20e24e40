"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cambio.llm.common import written


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the vertex's smallest neighbour (or itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("m").alias("a"), "b")
        .where("a <> b")
        .distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Every vertex and its smaller neighbours are linked to the smallest of them. Edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    neighbours = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return neighbours.unionByName(least.select(F.col("m").alias("a"), "b")).where("a <> b").distinct()


def settled(edges: DataFrame) -> bool:
    """Whether the edges (a < b) are stars: no vertex hangs on two, and none that hangs on another has any itself."""
    per_vertex = (
        edges.select(F.col("b").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        .unionByName(edges.select(F.col("a").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        .groupBy("v")
        .agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    )
    return per_vertex.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every vertex of the links (a, b): the smallest id that can be reached.

    Loops and links with a null end are left out; without links the result is empty. Each round is written, so rounds
    don't repeat each other's work and lost executors cost one round. A vertex with very many links is summed up in every
    task first, and its join partition is split by adaptive execution.
    """
    a, b = F.least("a", "b").cast("bigint"), F.greatest("a", "b").cast("bigint")
    proper = links.where("a <> b").select(a.alias("a"), b.alias("b")).distinct()
    edges = written(proper, "links")
    while not settled(edges):
        edges = written(small_star(large_star(edges)), "links")
    roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(roots)
