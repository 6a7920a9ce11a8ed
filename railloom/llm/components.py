"""Connected components of a table of links, by alternating stars; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railloom.operators.staging import stage


def connected(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): component is the smallest id it can reach.

    Each round hangs the larger neighbours of a node, then all its smaller ones, on its smallest neighbour. A round
    is two aggregations and two joins; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = stage(edges, "links")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = stage(large, "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        new = stage(small.where("u > v").distinct(), "links")
        if _print(new) == _print(edges):
            break
        edges = new
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())
