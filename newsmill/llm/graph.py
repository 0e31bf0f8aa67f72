"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsmill.session import materialize


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component): for every node of an edge the smallest node it can reach.  Isolated nodes are not listed.

    Each step links every neighbour of a node to the smallest of them, by a partial minimum and an equi-join (no
    neighbour list is gathered, a hot node is split like any skewed join side), and is written to shared storage, so
    lost executors re-read files.  The number of steps grows with the logarithm of the longest chain."""
    e = materialize(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct())
    seen = _mark(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                                              F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                                            .alias("e")).select("e.*").where("u <> v")
        e = materialize(small.distinct())
        now = _mark(e)
        if now == seen:
            break
        seen = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
