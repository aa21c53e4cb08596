"""Connected components by alternating large and small stars, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("v", "u"))


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root (the smallest node of its component) of edges u, v; loops and repeats are harmless.

    Large star: each node's larger neighbours are linked to the least of its neighbourhood; small star: the smaller ones
    are.  Minima come from partial aggregation and are joined back, so a star's centre is no group in one task.
    Each round is a table in the shared folder.  Rounds grow with the logarithm of the input.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        sides = _both(now)
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "at")
        large = sides.where("v > u").join(least, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "at")
        small = large.join(low, F.col("u") == F.col("at"))
        stars = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        last, now = now, materialize(stars.where("u <> v").distinct(), "stars")
        dropped(last)
        # A root is never on the left, and every node has one root, when nothing is left to do.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
