"""Connected components of a graph given as pairs, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textmill.functions.stage import materialize


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    up = both.join(least, "a").where("b > a")
    return up.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    others = pairs.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.withColumnRenamed("m", "b")).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node that can be reached.

    Each round connects nodes to lesser ones and keeps components; rounds grow with the logarithm of the longest
    path. Every round is written, so that none is worked out twice. No edges give no rows.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    pairs, mark = materialize(pairs, "edges"), None
    while True:
        # Pairs are distinct, so equal counts and hash sums mean equal sets.
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        found = pairs.agg(F.count("*").alias("n"), digest.alias("h")).first()
        if found.n == 0 or (found.n, found.h) == mark:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = (found.n, found.h)
        pairs = materialize(_small_star(_large_star(pairs)), "stars")
