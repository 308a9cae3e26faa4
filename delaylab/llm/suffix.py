"""Removal of long passages that occur more than once, by prefix-free parsing.

Every document is parsed at triggers of a rolling hash: the trigger of a 200-byte string is the
leftmost smallest hash in its middle, so equal strings have the same trigger at the same place,
whatever stands around them. The strings of one trigger, read together, are a phrase; phrases
overlap by 200 bytes, as in prefix-free parsing, so every suffix of the corpus, compared over 200
bytes, is a suffix of a phrase. Phrases are counted over the corpus (the dictionary and the
frequencies of the parse). A phrase whose trigger context occurs nowhere else holds no repeated
string; one that is the only phrase of a repeated context is repeated as a whole. Only phrases
that share their context with another one need order within: their suffixes are sorted (the
suffix array of the dictionary) and equal neighbours are counted over the corpus.

A fixed-size filter of the repeated contexts keeps unique phrases out of the second shuffle; a
false hit of the filter costs a row and never changes the result, which rests on exact counts of
128-bit digests.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ._common import pieces, texts

LENGTH = 200
GRAM = 8
#: Bytes of text taken through numpy at once.
BLOCK_BYTES = 1 << 19
#: Largest size of each filter, in bits.
FILTER_BITS = 1 << 28
CHUNK = 1 << 16
#: Contexts of more phrases than this are not ordered in one task.
HOT_PHRASES = 20_000


def _layout(length: int) -> tuple[int, int, int]:
    """Bytes before the trigger range, its width, and bytes of context from the trigger on."""
    lead = max(1, length // 6)
    span = max(1, length - 2 * lead - GRAM)
    return lead, span, length - lead - span + 1


def _words(raw: bytes, n: int) -> np.ndarray:
    """The 8 bytes from each of the first ``n`` positions on, as integers."""
    out = np.empty(n, dtype=np.uint64)
    for k in range(min(GRAM, n)):
        out[k::GRAM] = np.frombuffer(raw, dtype="<u8", count=len(range(k, n, GRAM)), offset=k)
    return out


def _triggers(words: np.ndarray, span: int) -> np.ndarray:
    """For each position the leftmost smallest hash of 8 bytes among ``span`` positions from it."""
    n = len(words)
    rows = -(-n // span) + 1
    padded = np.full(rows * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    grams = padded[:n]
    np.multiply(words, np.uint64(0x9E3779B97F4A7C15), out=grams)
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams &= np.uint64(0xFFFFFFFF00000000)
    grams |= np.arange(n, dtype=np.uint64)
    table = padded.reshape(rows, span)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:n], ahead[span - 1:span - 1 + n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def phrases(block: list[bytes], length: int = LENGTH):
    """The parse of some texts: the joined bytes, per phrase the text it is of and its first and
    last string starts (offsets into the joined bytes), the texts' offsets, and per phrase the
    hash of its trigger's context."""
    lead, span, tail = _layout(length)
    sizes = np.array([len(t) for t in block], dtype=np.int64)
    offsets = np.cumsum(sizes) - sizes
    joined = b"".join(block)
    empty = np.empty(0, dtype=np.int64)
    if not (sizes >= length).any():
        return joined, empty, empty, empty, offsets, empty
    words = _words(joined + b"\0" * (2 * GRAM + span + lead), len(joined) + span + lead)
    trigger = _triggers(words, span)[lead:lead + len(joined)]
    steps = np.zeros(len(joined) + 1, dtype=np.int8)
    long = sizes >= length
    np.add.at(steps, offsets[long], 1)
    np.add.at(steps, offsets[long] + sizes[long] - length + 1, -1)
    inside = np.cumsum(steps[:-1], dtype=np.int8).astype(bool)
    change = np.empty(len(joined), dtype=bool)
    change[0] = True
    change[1:] = (trigger[1:] != trigger[:-1]) | ~inside[:-1]
    first = np.flatnonzero(inside & change)
    ends = np.empty(len(joined), dtype=bool)
    ends[-1] = True
    ends[:-1] = change[1:] | ~inside[1:]
    last = np.flatnonzero(inside & ends)
    owner = np.searchsorted(offsets, first, side="right") - 1
    at = trigger[first] - lead
    context = np.full(len(first), lead + tail, dtype=np.uint64)
    for k in [*range(0, lead + tail - GRAM, GRAM), lead + tail - GRAM]:
        context ^= words[at + k]
        context *= np.uint64(0x9FB21C651E98DF25)
        context ^= context >> np.uint64(32)
    return joined, owner, first, last, offsets, context.view(np.int64)


def _digests(joined: bytes, first, last, length: int) -> np.ndarray:
    """Hash of each phrase with its overlap."""
    view, digest = memoryview(joined), xxhash.xxh3_64_intdigest
    return np.array([digest(view[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())],
                    dtype=np.uint64).view(np.int64)


def _census(source: DataFrame, length: int) -> DataFrame:
    """(context, mixed): trigger contexts seen twice or more, and whether in different phrases."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 0, BLOCK_BYTES):
                joined, _, first, last, _, context = phrases(texts(part.column(0)), length)
                if not len(first):
                    continue
                phrase = _digests(joined, first, last, length)
                order = np.argsort(context, kind="stable")
                context, phrase = context[order], phrase[order]
                at = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(context[at]), pa.array(np.diff(np.r_[at, len(context)])),
                     pa.array(np.minimum.reduceat(phrase, at)),
                     pa.array(np.maximum.reduceat(phrase, at))], ["context", "n", "lo", "hi"])

    seen = source.select("_text").mapInArrow(run, "context long, n long, lo long, hi long")
    return (seen.groupBy("context").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"),
                                        F.max("hi").alias("hi"))
            .where("n > 1").select("context", (F.col("lo") != F.col("hi")).alias("mixed")))


def _filter(spark: SparkSession, contexts: DataFrame, most_bits: int):
    """Bit sets of the repeated and of the mixed contexts, as (bits, bytes, bytes). Their size is
    fixed by ``most_bits`` whatever the input; each task fills one piece of ``CHUNK`` bits."""
    bits = CHUNK
    wanted = 16 * contexts.count()
    while bits < min(wanted, most_bits):
        bits *= 2

    def fill(table: pa.Table) -> pa.Table:
        out = []
        at = table.column("bit").to_numpy() % CHUNK
        mixed = table.column("mixed").to_numpy(zero_copy_only=False)
        for part in (at, at[mixed]):
            flags = np.zeros(CHUNK, dtype=bool)
            flags[part] = True
            out.append(np.packbits(flags).tobytes())
        return pa.table({"piece": [table.column("piece")[0].as_py()], "seen": [out[0]],
                         "mixed": [out[1]]}, schema=pa.schema(
            [("piece", pa.int64()), ("seen", pa.binary()), ("mixed", pa.binary())]))

    pieces = (contexts.select(F.pmod("context", F.lit(bits)).alias("bit"), "mixed")
              .groupBy("bit").agg(F.max("mixed").alias("mixed"))
              .withColumn("piece", F.expr(f"bit div {CHUNK}"))
              .groupBy("piece").applyInArrow(fill, "piece long, seen binary, mixed binary"))
    seen, mixed = bytearray(bits // 8), bytearray(bits // 8)
    for row in pieces.toLocalIterator():
        at = row["piece"] * CHUNK // 8
        seen[at:at + CHUNK // 8] = row["seen"]
        mixed[at:at + CHUNK // 8] = row["mixed"]
    return spark.sparkContext.broadcast((bits, bytes(seen), bytes(mixed)))


def _hits(flags: bytes, bits: int, context: np.ndarray) -> np.ndarray:
    at = np.mod(context, bits)
    table = np.frombuffer(flags, dtype=np.uint8)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def suffix_classes(dictionary: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Suffix array of some phrases over ``length`` bytes, cut into runs of equal neighbours:
    lists of (phrase, offset)."""
    suffixes = sorted((text[at:at + length], i, at) for i, text in enumerate(dictionary)
                      for at in range(len(text) - length + 1))
    return [[(i, at) for _, i, at in run] for _, run in groupby(suffixes, key=lambda s: s[0])]


def _occurrences(source: DataFrame, filters, length: int) -> DataFrame:
    """(context, phrase, _id, _key, begin, n, body): the phrases that the filter lets through and
    the runs of string starts they stand for; body is the phrase with its overlap if the context
    is a mixed one, given once per block of texts."""
    def run(batches):
        bits, seen, mixed = filters.value
        for batch in batches:
            for part in pieces(batch, 2, BLOCK_BYTES):
                ids, keys = part.column(0), part.column(1)
                joined, owner, first, last, offsets, context = phrases(
                    texts(part.column(2)), length)
                some = np.flatnonzero(_hits(seen, bits, context))
                if not len(some):
                    continue
                owner, first, last, context = (x[some] for x in (owner, first, last, context))
                phrase = _digests(joined, first, last, length)
                given, body = set(), [None] * len(some)
                for k in np.flatnonzero(_hits(mixed, bits, context)).tolist():
                    if phrase[k] not in given:
                        given.add(phrase[k])
                        body[k] = joined[first[k]:last[k] + length]
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(context), pa.array(phrase), ids.take(rows), keys.take(rows),
                     pa.array((first - offsets[owner]).astype(np.int32)),
                     pa.array((last - first + 1).astype(np.int32)),
                     pa.array(body, type=pa.binary())],
                    ["context", "phrase", "_id", "_key", "begin", "n", "body"])

    kind = source.schema["_id"].dataType.simpleString()
    return source.select("_id", "_key", "_text").mapInArrow(
        run, f"context long, phrase long, _id {kind}, _key long, begin int, n int, body binary")


def _runs(places: list[int]) -> tuple[list[int], list[int]]:
    """First members and lengths of the runs of consecutive integers in a set."""
    at = np.unique(np.array(places, dtype=np.int32))
    new = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    return at[new].tolist(), np.diff(np.r_[new, len(at)]).tolist()


def _shared(dictionary: DataFrame, length: int) -> DataFrame:
    """(context, phrase, begins, counts): runs of string starts of a phrase that are also in
    another phrase of its context, by the suffix array of the phrases of some contexts at a time.
    Phrases of a context arrive together, ordered; memory holds one batch and one context."""
    def solve(rows):
        keys = list(rows)
        places: dict[int, list[int]] = {}
        for run_ in suffix_classes([rows[k] for k in keys], length):
            if len(run_) > 1:
                for i, at in run_:
                    places.setdefault(i, []).append(at)
        found = [(*keys[i], *_runs(at)) for i, at in places.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, type=t) for x, t in zip(zip(*found) if found else ((),) * 4, (
                pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
            ["context", "phrase", "begins", "counts"])

    def run(batches):
        rows: dict[tuple[int, int], bytes] = {}
        for batch in batches:
            for context, phrase, body in zip(*(c.to_pylist() for c in batch.columns)):
                if len(rows) >= 2000 and context != last:
                    yield solve(rows)
                    rows = {}
                rows[context, phrase] = body
                last = context
        if rows:
            yield solve(rows)

    return (dictionary.repartition("context").sortWithinPartitions("context")
            .select("context", "phrase", "body")
            .mapInArrow(run, "context long, phrase long, begins array<int>, counts array<int>"))


def _shared_hot(dictionary: DataFrame, length: int) -> DataFrame:
    """The same for contexts of very many phrases: every string by itself, counted by digest."""
    strings = dictionary.select("context", "phrase", "body", F.explode(F.expr(
        f"sequence(1, octet_length(body) - {length - 1})")).alias("at"))
    strings = strings.select("context", "phrase", F.col("at") - 1, F.md5(
        F.expr(f"substring(body, at, {length})")).alias("digest")).toDF(
        "context", "phrase", "at", "digest")
    again = (strings.groupBy("context", "digest").agg(F.count(F.lit(1)).alias("c"))
             .where("c > 1").drop("c"))
    return (strings.join(again, ["context", "digest"]).groupBy("context", "phrase")
            .agg(F.collect_set("at").alias("begins"))
            .withColumn("counts", F.transform("begins", lambda _: F.lit(1))))


def _merge(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of a set of half-open intervals."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, begin[1:] > reach[:-1]])
    return begin[new], reach[np.r_[new[1:] - 1, len(reach) - 1]]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, filter_bits: int = FILTER_BITS,
                   hot_phrases: int = HOT_PHRASES) -> DataFrame:
    """(_id, _key, begins, counts): per document with repeated strings the runs of their starts;
    _key is xxhash64 of the text."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"),
                         F.col(text_col).alias("_text"))
    path = scratch_path(spark, "contexts")
    _census(source, length).write.parquet(path)
    filters = _filter(spark, spark.read.schema("context long, mixed boolean").parquet(path),
                      filter_bits)
    path = scratch_path(spark, "occurrences")
    occurrences = _occurrences(source, filters, length)
    occurrences.write.parquet(path)
    filters.destroy()  # 64 MB at most on every executor, not needed again
    found = spark.read.schema(occurrences.schema).parquet(path)
    counted = found.groupBy("context", "phrase").agg(F.count(F.lit(1)).alias("c"))
    whole = counted.where("c > 1").select(
        "context", "phrase", F.lit(None).cast("array<int>").alias("begins"),
        F.lit(None).cast("array<int>").alias("counts"))
    bodies = found.where("body is not null").select("context", "phrase", "body")
    hot = (bodies.groupBy("context").agg(F.count(F.lit(1)).alias("c"))
           .where(F.col("c") > hot_phrases).select("context"))
    path = scratch_path(spark, "hot")
    hot.write.parquet(path)
    hot = spark.read.schema("context long").parquet(path)
    parts = _shared(bodies.join(hot, "context", "left_anti"), length)
    if not hot.isEmpty():
        few = bodies.join(hot, "context", "left_semi").dropDuplicates(["context", "phrase"])
        parts = parts.unionByName(_shared_hot(few, length))
    verdicts = parts.unionByName(whole)
    runs = found.drop("body").join(verdicts, ["context", "phrase"]).select(
        "_id", "_key", F.when(F.col("begins").isNull(), F.array(F.struct("begin", "n"))).otherwise(
            F.expr("transform(arrays_zip(begins, counts), "
                   "x -> struct(int(begin + x.begins) AS begin, x.counts AS n))")).alias("runs"))
    runs = runs.groupBy("_id", "_key").agg(F.flatten(F.collect_set("runs")).alias("runs"))
    return runs.select("_id", "_key", F.col("runs.begin").alias("begins"),
                       F.col("runs.n").alias("counts"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, into: str = "repeats", filter_bits: int = FILTER_BITS,
                   hot_phrases: int = HOT_PHRASES) -> DataFrame:
    """The rows of ``docs`` with one more column ``into``, a struct (n_bytes, n_removed, n_spans,
    kept, text): each byte covered by a ``length``-byte string that also starts elsewhere in the
    table is removed, judged on the input; kept holds the remaining bytes, text the whole
    characters among them.

    NULL and empty texts have no bytes and nothing is removed; texts shorter than ``length`` are
    left whole; a repeated row repeats all its strings; an empty table gives an empty result;
    ``docs`` must not have a column named ``into``, all its other columns pass through.
    """
    if into in docs.columns:
        raise ValueError(f"docs already has a column {into}")
    if length < 4 * GRAM:
        raise ValueError(f"length must be {4 * GRAM} or more")
    spans = repeated_spans(docs, id_col, text_col, length, filter_bits, hot_phrases)
    names = docs.columns
    rest = [docs[c] for c in names if c != text_col] or [F.lit(True).alias("_none")]
    packed = docs.select(F.struct(*rest).alias("_row"), docs[id_col].alias("_i"),
                         F.xxhash64(docs[text_col]).alias("_k"), docs[text_col].alias("_text"))
    same = packed["_i"].eqNullSafe(spans["_id"]) & (packed["_k"] == spans["_key"])
    joined = packed.join(spans.hint("shuffle_merge"), same, "left").select(
        "_row", "_text", "begins", "counts")
    kinds = [("n_bytes", pa.int64(), T.LongType()), ("n_removed", pa.int64(), T.LongType()),
             ("n_spans", pa.int64(), T.LongType()), ("kept", pa.binary(), T.BinaryType()),
             ("text", pa.string(), T.StringType())]

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1, BLOCK_BYTES):
                out = []
                for text, begins, counts in zip(texts(part.column(1)),
                                                part.column(2).to_pylist(),
                                                part.column(3).to_pylist()):
                    if not begins:  # nothing removed: the text stands beside
                        out.append((len(text), 0, 0, None, None))
                        continue
                    begin = np.array(begins, dtype=np.int64)
                    begin, end = _merge(
                        begin, begin + np.array(counts, dtype=np.int64) + length - 1)
                    keep = [text[a:b] for a, b in zip([0, *end.tolist()],
                                                      [*begin.tolist(), len(text)])]
                    kept = b"".join(keep)
                    out.append((len(text), len(text) - len(kept), len(begin), kept,
                                kept.decode("utf-8", "ignore")))
                new = pa.StructArray.from_arrays(
                    [pa.array(x, type=t) for x, (_, t, _) in zip(zip(*out), kinds)],
                    [n for n, _, _ in kinds])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), new],
                                                 ["_row", "_text", "_new"])

    new = T.StructType([T.StructField(n, t) for n, _, t in kinds])
    done = joined.mapInArrow(run, T.StructType([joined.schema["_row"], joined.schema["_text"],
                                                T.StructField("_new", new)]))
    whole = F.coalesce("_text", F.lit(""))
    repeats = F.struct(
        *[F.col("_new")[n].alias(n) for n in ("n_bytes", "n_removed", "n_spans")],
        F.coalesce(F.col("_new")["kept"], whole.cast("binary")).alias("kept"),
        F.coalesce(F.col("_new")["text"], whole).alias("text"))
    return done.select(*[F.col("_text").alias(c) if c == text_col else F.col("_row")[c].alias(c)
                         for c in names], repeats.alias(into))
