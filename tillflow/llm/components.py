"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.session import stored


def components(links: DataFrame) -> DataFrame:
    """(vertex, component) for a table of links (a, b) of longs; the component is the
    least vertex of it. Vertices without a link to another are not listed.

    Alternates two steps until nothing changes: every vertex hands its larger
    neighbours, then its smaller ones, to the least neighbour it knows. The links
    become stars around the least vertices in about log n rounds. The minimum of a
    vertex comes from a pre-aggregated count, and a vertex with very many links is only
    ever a skewed join key, which adaptive execution splits; each round is written to
    the shared folder.
    """
    edges = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("vertex"), F.col("b").alias("component"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(
        "a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
