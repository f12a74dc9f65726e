"""Connected components of an undirected graph, by alternating star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.storage import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has an edge (u, v).

    Each round links every neighbour to the smallest one around it, first the
    larger neighbours, then the smaller. Edges are as many as before at most,
    however large a component is, and about log(path length) rounds suffice.
    """
    edges = materialise(_ordered(edges.select("u", "v").where("u <> v")), "edges")
    while not _are_stars(edges):
        edges = materialise(_small_star(_large_star(edges)), "stars")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root")))


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one or is such a smaller one: then that is its root."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("above").alias("above"), F.max("below").alias("below"))
    return nodes.where("above > 1 OR (above = 1 AND below = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _ordered(linked.union(least.select("u", F.col("m").alias("v"))))
