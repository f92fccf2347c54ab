"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum joined back to the edges. Minima are combined before the shuffle, and
nodes with very many neighbours (at most ``HOT_KEYS``) are joined by broadcast, so none has to fit in one
task. Every round is stored in the shared folder, which keeps the lineage short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, join_hot, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    pair = F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return edges.select(F.explode(pair).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    near = _both_ways(edges)
    low = near.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return join_hot(near, low, "u", 2 * total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
    return join_hot(down, low, "u", total).select(F.explode(moved).alias("e")).select("e.u", "e.v").where("u <> v")


def _print(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)``, longs, in any direction, repeats allowed -> ``(u, v)``: every node that is not
    the smallest of its component, with that smallest node. Nodes without edges do not appear."""
    spark = edges.sparkSession
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    was = _print(now)
    while was[0]:
        new = stored(_small_star(_large_star(now, was[0]), was[0]).distinct())
        then = _print(new)
        discard(spark, now)
        now = new
        if then == was:
            break
        was = then
    return now
