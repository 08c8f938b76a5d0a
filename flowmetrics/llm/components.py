"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is a few joins and minimum aggregates over edges, written to the
shared folder; nothing about links or components reaches the driver but a
count and a checksum per round. The minima are written before they are joined
back, so that the join's large side, which a hub can dominate, is split by
Spark's skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _round(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), "large_star")
    large = (both.filter("v > u").join(least, "u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    large = staged(large, "large_edges")
    least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "small_star")
    small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
             .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return staged(small, "small_edges")


def _signature(e: DataFrame):
    return e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)`` but the roots themselves; the
    root is the smallest node of its component."""
    e = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .filter("u <> v").distinct(), "edges")
    seen = _signature(e)
    while seen["n"]:
        e = _round(e)
        now = _signature(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
