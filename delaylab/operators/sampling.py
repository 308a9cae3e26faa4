"""Sampling, splitting and set operations.

``hash_split`` and ``disjoint_chunks`` derive a uniform number from ``md5(seed:key)`` per row.
The assignment depends only on the key, never on partitioning, row order or executor count,
so it is reproducible across runs, survives task retries unchanged, and can be reproduced in
SQL. Disjoint chunks are ranges of that number: one scan, no chain of anti-joins.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._util import as_list
from ._plan import null_safe_join

#: Copies of a value regenerated by one row's expansion.
COPY_BLOCK = 10_000

HASH_BITS = 60


def hash_unit(keys, seed: int = 42) -> Column:
    """Integer in [0, 2^60) from the first 15 hex digits of ``md5("<seed>:<k1>:<k2>...")``."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(k).cast("string"), F.lit(""))
                                  for k in as_list(keys)]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def hash_bound(share: float) -> int:
    """The bound below which a share of all hashes lies."""
    return int(Fraction(share).limit_denominator(10 ** 15) * (1 << HASH_BITS))


def hash_split(df: DataFrame, keys, weights=(0.7, 0.3), seed: int = 42,
               out: str = "split") -> DataFrame:
    """Add ``out`` = index of the split each row falls into (weights are normalized); the whole
    60-bit hash is compared with the bounds."""
    total = sum(weights)
    if any(w < 0 for w in weights) or total <= 0:
        raise ValueError("weights must not be negative and must not all be zero")
    h = hash_unit(keys, seed)
    bounds = [hash_bound(sum(weights[:i + 1]) / total) for i in range(len(weights) - 1)]
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(bounds))):
        expr = F.when(h < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return df.withColumn(out, expr)


def split_frames(df: DataFrame, keys, weights=(0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    """``hash_split`` as separate frames (each a filter over the same scan)."""
    tagged = hash_split(df, keys, weights, seed, "_split")
    return [tagged.where(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def disjoint_chunks(df: DataFrame, keys, n: int = 6, fraction: float = 0.001, seed: int = 42,
                    out: str = "chunk", keep_unassigned: bool = False) -> DataFrame:
    """Tag rows with ``out`` in 0..n-1: chunk i is the hash range [i*f, (i+1)*f) of the unit
    interval, so chunks are disjoint, each about ``fraction`` of the rows."""
    if n * fraction > 1.0:
        raise ValueError("n * fraction must be at most 1")
    width = hash_bound(fraction)
    if width < 1:
        raise ValueError("fraction is too small: its hash range is empty")
    # the hash is a column of its own, so that a row has it evaluated once
    place = F.expr(f"_hash div {width}")
    tagged = df.withColumn("_hash", hash_unit(keys, seed)).withColumn(
        out, F.when(place < n, place.cast("int"))).drop("_hash")
    return tagged if keep_unassigned else tagged.where(F.col(out).isNotNull())


def train_test_chunks(chunked: DataFrame, n_train: int = 5, col: str = "chunk"
                      ) -> tuple[DataFrame, DataFrame]:
    """Chunks 0..n_train-1 for training, chunk ``n_train`` for testing (no overlap)."""
    return (chunked.where(F.col(col) < n_train), chunked.where(F.col(col) == n_train))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42, keys=None) -> DataFrame:
    """Row-wise Bernoulli sample without replacement. With ``keys`` a row is drawn by the md5 hash
    of its key: the same sample whatever the layout of the table, its retries or its engine.
    Without, Spark's ``sample`` draws by the row's place, which depends on the layout."""
    if keys is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    return df.where(hash_unit(keys, seed) < F.lit(hash_bound(fraction)))


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 42, keys=None) -> list[DataFrame]:
    """Random parts of the table by weight. With ``keys`` by the md5 hash of the key (see
    ``split_frames``); without, Spark's ``randomSplit``, whose parts agree between reruns only on
    the same input layout."""
    if keys is not None:
        return split_frames(df, keys, weights, seed)
    return df.randomSplit(list(weights), seed)


def remaining_rows(df: DataFrame, used: DataFrame, distinct: bool = True) -> DataFrame:
    """Rows of ``df`` not in ``used``: EXCEPT (distinct, drops duplicates) or EXCEPT ALL.

    EXCEPT is a NULL-safe anti join on all columns of the deduplicated sides. The used side is
    collapsed by a partial aggregation; when it is small the anti join is a broadcast
    (map-side) join and the remaining rows' copies are collapsed map-side before the only
    shuffle, so a row repeated across a third of the table costs one row per task. With a
    large used side AQE splits skewed anti-join partitions. EXCEPT ALL counts the copies of each
    value on both sides (partially aggregated) and regenerates the difference in blocks of
    ``COPY_BLOCK`` copies that are dealt over the tasks, so one value with very many copies is
    not one task's work."""
    names = df.columns
    if distinct:
        return null_safe_join(df.dropDuplicates(), used.dropDuplicates(), names, "left_anti")
    have = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_have"))
    gone = used.groupBy(*names).agg(F.count(F.lit(1)).alias("_gone"))
    left = null_safe_join(have, gone, names, "left").withColumn(
        "_left", F.col("_have") - F.coalesce("_gone", F.lit(0))).where("_left > 0")
    blocks = left.select(*names, "_left", F.explode(
        F.expr(f"sequence(0, (_left - 1) div {COPY_BLOCK})")).alias("_block"))
    dealt = blocks.repartition(*names, "_block")
    return dealt.select(*names, F.explode(F.expr(
        f"sequence(1, least({COPY_BLOCK}, _left - _block * {COPY_BLOCK}))")).alias("_copy")
    ).drop("_copy")
