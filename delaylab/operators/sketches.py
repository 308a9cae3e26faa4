"""Distinct counts that can be added up: stored HyperLogLog sketches per file or year.

A sketch has a few kilobytes whatever it has seen, and the sketch of a union is the union of the
sketches, so the distinct counts of several years come from the stored sketches of each: a new year
adds its own, and the years before are never read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .._util import as_list
from ..sources.layout import read_partitioned, write_partitioned

#: Base-two logarithm of a sketch's cells; the relative standard error is 1.04 / sqrt(cells).
LG_CELLS = 12


def standard_error(lg_cells: int = LG_CELLS) -> float:
    return 1.04 / (1 << lg_cells) ** 0.5


def distinct_sketches(df: DataFrame, cols, by="Year", lg_cells: int = LG_CELLS) -> DataFrame:
    """(``by``..., column, rows, sketch): per group and column of ``cols`` the rows with a value and
    a sketch of its different values, in one pass (partial aggregation; NULLs do not count)."""
    by, cols = as_list(by), list(cols)
    aggs = [x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"_n{i}"),
        F.hll_sketch_agg(F.col(c).cast("string"), lg_cells).alias(f"_s{i}"))]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("rows"),
                               F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(cols)])
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(cells))


def merge_sketches(sketches: DataFrame, by=None) -> DataFrame:
    """(``by``..., column, rows, n_distinct): estimates for the union of the groups."""
    by = as_list(by)
    return sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def store_sketches(df: DataFrame, path: str, cols, by="Year", lg_cells: int = LG_CELLS) -> None:
    """Write the sketches of ``df``'s groups beside those that ``path`` has of other groups (those
    of the same groups are replaced)."""
    write_partitioned(distinct_sketches(df, cols, by, lg_cells), path, by)


def stored_distinct(spark: SparkSession, path: str, by="Year", only: dict | None = None
                    ) -> DataFrame:
    """(column, rows, n_distinct) over all stored groups, or over those that ``only`` names, from
    the sketches alone."""
    return merge_sketches(read_partitioned(spark, path, by, only))
