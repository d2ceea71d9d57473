"""Connected components of a graph of links, by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from meterloom.session import settle


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large: every larger neighbour of a node is linked to the node's smallest one. Small: every smaller one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    near = both.where("b > a") if large else both
    linked = near.join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    if not large:
        linked = linked.unionByName(least.select(F.col("a").alias("x"), F.col("m").alias("y")))
    return linked.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: (a long, b long). Returns (node, component): every node that has a link and the smallest node it reaches.
    Each round is written to the shared folder, so lineage stays short. Stops when a round changes no edge."""
    def state(edges):
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = state(edges)
    while seen[0]:
        edges = settle(_stars(settle(_stars(edges, True), "large-stars"), False), "small-stars")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
