"""Connected components of a graph by alternating large-star and small-star steps on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe.scratch import stored


def _settled(edges: DataFrame) -> DataFrame:
    return stored(edges.where("a > b").distinct(), "edges")


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
    return row["n"], int(row["s"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that an edge (a, b) touches.

    Edges may repeat, run either way or from a node to itself (such nodes without another edge are left out). Every
    step groups and joins by node, writes its edges to the shared folder and ends when they no longer change; a node
    with very many edges is pre-aggregated for its minimum, and its rows of a join are split by adaptive execution.
    """
    now = _settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    mark = _mark(now)
    while mark[0]:
        # Large star: larger neighbours go to the smallest node around.
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = now.select(F.col("a").alias("v"), F.col("b").alias("a")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = _settled(large)
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = _settled(small)
        if (after := _mark(now)) == mark:
            break
        mark = after
    return now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
