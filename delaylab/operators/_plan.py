"""Plan-shaping helpers shared by the operators: lineage cuts, size-checked broadcast joins."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

# Upper bound on what is ever broadcast. The small side is materialized and its size measured
# (row count and string bytes) before the hint is given; beyond the bound the join stays a
# shuffle join, where AQE splits skewed partitions.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# The JVM compiles no method of more bytes; Spark's own bound for a generated method is 65,535.
COMPILED_METHOD_BYTES = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage in the shared checkpoint folder named by the
    session (``spark.checkpoint.dir``); a local session without one gets a scratch folder, a
    cluster session without one is an error."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured_bytes(df: DataFrame) -> int:
    """Rows x fixed-width bytes + the actual bytes of every string, in one small job over an
    already materialized table (nested values are counted at a generous fixed width)."""
    fixed = 16
    strings = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            strings.append(F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)))
            fixed += 8
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            fixed += 256
        else:
            fixed += 8
    row = df.agg(F.count(F.lit(1)), *strings).first()
    return int(row[0]) * fixed + sum(int(v) for v in row[1:])


def null_safe_join(big: DataFrame, small: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join on ``keys`` treating NULL as a value (like a window's PARTITION BY)."""
    keys = list(keys)
    renamed = small.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                           *[c for c in small.columns if c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [big[k].eqNullSafe(renamed[f"__k{i}"]) for i, k in enumerate(keys)])
    return big.join(renamed, cond, how).drop(*[f"__k{i}" for i in range(len(keys))])


def attach_small(big: DataFrame, small: DataFrame, keys, how: str = "left",
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join a per-key table onto ``big``. ``small`` is materialized and measured; it is
    broadcast only when its measured size is under ``max_broadcast_bytes`` (so ``big`` is never
    shuffled and a hot key costs nothing extra), otherwise it is a shuffle join."""
    small = materialize(small)
    if measured_bytes(small) <= max_broadcast_bytes:
        small = F.broadcast(small)
    return null_safe_join(big, small, keys, how)


def split_as(df: DataFrame, rows: int, per_task: int = 500_000, least: int = 8) -> int | None:
    """Tasks that a table made from ``rows`` rows of ``df`` is to be dealt over: one per
    ``per_task`` rows, at least ``least``; None where its input has as many splits already. A
    property of the data, not of the cluster."""
    wanted = max(least, -(-rows // per_task))
    return None if df.rdd.getNumPartitions() >= wanted else wanted


@contextmanager
def compiled_methods(spark):
    """Plans that start in here use whole-stage code only where the JVM compiles its methods. A
    wide projection generates a method beyond that size, which is interpreted row by row;
    operator by operator the same expressions run compiled."""
    before = spark.conf.get(_METHOD_LIMIT, None)
    spark.conf.set(_METHOD_LIMIT, str(COMPILED_METHOD_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_METHOD_LIMIT)
        else:
            spark.conf.set(_METHOD_LIMIT, before)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal the rows round-robin over ``partitions`` tasks before iterative or CPU-heavy work on
    an under-split input (one unsplittable file); ``None`` leaves the layout alone. The number is
    the caller's choice, so that seeded estimators see the same layout on every cluster."""
    return df if partitions is None else df.repartition(partitions)
