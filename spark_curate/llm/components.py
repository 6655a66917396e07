"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_curate.functions.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node reached.

    Alternates large and small stars until nothing changes: a logarithmic number of
    rounds, each a few joins whose state stays at one row per edge at most. No
    component is ever gathered; minima are formed before the shuffle, and joins on
    hub nodes are plain inner joins that adaptive execution may split. Each round is
    written to the shared folder, so a lost executor costs its tasks only. Self loops
    and repeated edges are harmless; no edges give no rows.
    """
    now = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        if seen == state or not state[0]:
            break
        seen = state
        now = materialize(_small_star(_large_star(now)).distinct())
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
