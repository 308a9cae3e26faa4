"""SimHash near-dedup by multi-index hashing.

Fingerprints are computed where the documents lie; only (id, 64 bits) is shuffled. Equal
fingerprints collapse to one row first, so a group of copies of any size is one entry. Each
distinct fingerprint is entered once per segment in the index and looks up the small Hamming
ball around its own segment; by the pigeonhole rule any pair within ``max_distance`` agrees to
``max_distance // segments`` bits in one segment. The complete distance is part of the join
condition, so only true links leave the join.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import LOWER_BYTES, cut, pieces, release, texts
from .components import connected_components

SEED = 42
#: Bytes of text taken out of an Arrow batch at a time.
BLOCK_BYTES = 4 << 20


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of one text (0 for a text without words)."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    width = min(shingle, len(words))
    last = len(words) - width + 1
    ends = (starts + lengths)[width - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in
                          zip(starts[:last].tolist(), ends.tolist())), dtype="<u8", count=last)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, last, 1 << 16):
        block = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """One row (doc_id, key, fp) per row of ``docs``; key is xxhash64 of the text, fp holds the 64
    bits as a signed long."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1, BLOCK_BYTES):
                values = [fingerprint(t, shingle) for t in texts(part.column(1))]
                signed = np.array(values, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(signed)], ["doc_id", "key", "fp"])
            release()

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("key"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, key long, fp long")


def _masks(bits: int, radius: int) -> list[int]:
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _segment(fp: Column, index: int, bits: int) -> Column:
    part = F.shiftrightunsigned(fp, index * bits).bitwiseAND(F.lit((1 << bits) - 1))
    return part + F.lit(index << bits)


def links(distinct: DataFrame, max_distance: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (u, v) of different fingerprints at most ``max_distance`` bits apart.

    ``segments`` divides 64. A ball member is looked up only if it is not smaller than the own
    segment: of two differing segments one has the smaller value, so each pair is found, and
    found from one side."""
    if 64 % segments or segments < 2:
        raise ValueError("segments must divide 64 and be at least 2")
    bits = 64 // segments
    balls = F.array(*[F.lit(m).cast("long") for m in _masks(bits, max_distance // segments)])
    own = F.array(*[_segment(F.col("fp"), i, bits) for i in range(segments)])
    index = distinct.select(F.explode(own).alias("key"), F.col("fp").alias("a"))
    probes = (distinct.select(F.explode(own).alias("segment"), F.col("fp").alias("b"))
              .select("segment", "b", F.explode(balls).alias("mask"))
              .select("b", (F.col("segment").bitwiseXOR(F.col("mask"))).alias("key"), "segment")
              .where("key >= segment"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    once = (F.col("key") > F.col("segment")) | (F.col("a") < F.col("b"))
    return (probes.join(index, "key").where(near & once & (F.col("a") != F.col("b")))
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 3, max_distance: int = 3, segments: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of ``docs``.

    component_id is the smallest id reachable over links of ``max_distance`` bits or fewer,
    itself included. A NULL or empty text has fingerprint zero and links like any other; a NULL
    id never names a component unless all its members have none; repeated rows are repeated in
    the result; an empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    return simhash_classes(docs, id_col, text_col, shingle, max_distance, segments).drop(
        "root", "key")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_distance: int = 3, segments: int = 2) -> DataFrame:
    """``simhash_dedup`` with root (the smallest fingerprint of the component, which names it also
    where its documents have no id) and key (xxhash64 of the text)."""
    prints = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(links(classes.select("fp"), max_distance, segments))
    joined = (classes.join(roots, classes.fp == roots.node, "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    best = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(best, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        "root", "key")
