"""Connected components of an edge table by alternating star contractions.

Every round rewrites the edges so that each node points at smaller nodes (large star), then at
the smallest of them (small star); a star forest is the fixed point, reached in a number of
rounds that is logarithmic in practice. All steps are joins and grouped minima: a hub is one
group of a mergeable minimum, never a list, and its join rows can be split by the skew-join rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut


def _minimum(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_minimum(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = _minimum(edges)
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = low.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                 .first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of one comparable type -> ``(node, root)`` for every node of an edge,
    where root is the smallest node reachable. Loops and NULL ends are ignored; an empty table
    gives an empty result."""
    edges = cut(edges.where("u <> v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _signature(edges)
    while seen[0]:
        edges = cut(_small_star(_large_star(edges)))
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
