"""Connected components of an undirected graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, staged


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least_neighbour(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of a node, and the node itself, to the least of them."""
    least = _least_neighbour(edges)
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node of ``edges`` but the
    roots themselves.  Links of a node with itself and null ends say nothing and are left out.

    Each round halves the longest path at least; rounds are written to the shared folder, and the
    minima are pre-aggregated, so a node with very many links does not meet in one task."""
    spark = edges.sparkSession
    start = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    now, path = staged(start, "links")
    mark = _mark(now)
    while mark["n"]:
        after, new = staged(_small_star(_large_star(now)), "links")
        release(spark, path)
        now, path, last, mark = after, new, mark, _mark(after)
        if mark == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
