"""Connected components by alternating large-star and small-star on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import forget, stored


def _is_forest_of_stars(edges: DataFrame) -> bool:
    heads = edges.select(F.col("b").alias("a")).distinct()
    row = edges.agg(F.count("*").alias("n"), F.count_distinct("a").alias("d")).first()
    return row["n"] == row["d"] and not edges.join(heads, "a", "left_semi").limit(1).count()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest node reachable.

    Links have no direction; loops, repeats and nulls are dropped. Each node with another's smaller id as
    its component has one row; a component's smallest node has none. Every round is written to the shared
    folder, so no round depends on executors of an earlier one.
    """
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    links = stored(links, "links")
    while not _is_forest_of_stars(links):
        old, links = links, stored(_small_star(_large_star(links)), "links")
        forget(old)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
