"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# A-Z lowered byte by byte, all other characters left alone.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, so every engine agrees on the result."""
    return F.translate(text, UPPER, LOWER)


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the cluster's shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (NULL ids hash the empty text)."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(mod))


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, b'' for NULL."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def seeded_rows(df: DataFrame, key: str, bound: int, seed: int) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hashes of ``key``. All but about half as
    many again are filtered where they lie, so a task sends few rows on whatever the table's
    size."""
    h, n = F.xxhash64(F.col(key), F.lit(seed)), df.count()
    if n > 2 * bound:
        df = df.where(h < F.lit(int(1.5 * bound / n * 2.0 ** 64) - (1 << 63)))
    return df.orderBy(h, key).limit(bound)


def pieces(batch: pa.RecordBatch, column: int, size: int):
    """The batch in slices of about ``size`` bytes of text, so that few texts are Python objects
    at a time."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    turn = np.cumsum(lengths, dtype=np.int64) // size
    starts = np.flatnonzero(np.r_[True, turn[1:] != turn[:-1]]) if len(turn) else []
    for a, b in zip(starts, [*starts[1:], len(turn)]):
        yield batch.slice(int(a), int(b - a))


def release() -> None:
    """Give the memory that Arrow keeps for further batches back to the machine: workers live on
    after their task, beside those of other stages."""
    pa.default_memory_pool().release_unused()


def process_cache() -> dict:
    """What a worker process keeps from one task to the next (vocabularies)."""
    return sys.__dict__.setdefault("_delaylab_process_cache", {})


def with_text_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id`` and ``_text`` beside a digest ``_key`` of the text, without the other columns, so
    that columns of any other name cannot clash."""
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                       F.xxhash64(F.col(text_col)).alias("_key"))
