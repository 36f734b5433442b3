"""Connected components by alternating large-star and small-star steps, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import discard, written

#: Shares into which the edges of every node are dealt, so that a hub's meet in as many tasks.
SALTS = 16


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def salted_join(rows: DataFrame, one: DataFrame, key: str, by: str) -> DataFrame:
    """rows joined to `one`, which has a row for each key.  The key is salted by another column: that row goes to every share, each of rows to one."""
    shares = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(shares, [key, "_salt"]).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for each node of edges (u long, v long), as a written table.

    Each round is written to the shared folder, and the one before deleted; rounds grow with the logarithm of the longest path.
    Per node only minima are gathered, so a node with many edges is combined before the shuffle, and its edges are dealt into shares."""
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = salted_join(both.where("v > u"), least, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(large, least, "u", "v").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        last, edges = edges, written(small)
        discard(last)
        before, state = state, _state(edges)
        if state == before:
            out = written(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
            discard(edges)
            return out
