"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.settings import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (around.join(least, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a")
    return (tied.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())


def _mark(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Loops and repeated edges are dropped; rows with a NULL end are no edges; an
    empty table gives an empty result. Every round is cut off in the checkpoint
    folder, and only two numbers per round reach the driver.
    """
    edges = cut_lineage(edges.select("a", "b").filter("a <> b").distinct())
    mark = _mark(edges)
    while mark[0]:
        edges = cut_lineage(_small_star(_large_star(edges)))
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.unionByName(roots)
