"""MinHash near-dedup with sequential Bayesian verification.

Documents collapse to their distinct shingle sets first, so copies of any number are one entry.
A set's signature is banded; sets that share a band are candidates. Candidates are compared in
batches of signature positions: after each batch the posterior of their similarity, given the
matches so far and a uniform prior, is held against the threshold, and a pair whose probability of
reaching it is below ``miss`` is dropped. All survivors are verified exactly on their full sets.

Positions are compared by their low two bits, 32 to a 64-bit word, with a few operations on whole
words, so the sequence of tests is a join condition of built-in functions and only survivors leave
the join. Two sets meet in the first band they share. In every band the smallest set is first
compared with all others (pairs in proportion to the sets); what is still in different components
afterwards is compared completely, in blocks, so that no link between components is lost and pairs
inside a component found before are never made.
"""

from __future__ import annotations

from math import lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import LOWER_BYTES, cut, pieces, texts
from .components import connected_components

SEED = 42
#: Bands and rows of the index; at the default threshold a link of exactly 0.85 is missed by all
#: bands with probability 1.2e-5, one of 0.9 with 1.3e-8.
BANDS, ROWS = 24, 6
#: Signature positions compared before each test; the last is the length of a signature.
TESTS = (128, 256, 512, 1024)
#: Posterior probability of a link below which a pair is dropped.
MISS = 1e-4
#: Bytes of text taken out of an Arrow batch at a time; shingles hashed at a time.
BLOCK_BYTES, BLOCK_SHINGLES = 2 << 20, 1 << 15
#: Sets of one band that are compared with the band in one piece, and pivots of a bucket.
PIECE, PIVOTS = 1024, 4

_U, _W = np.uint64, np.uint32
_BITS, _PER_WORD = 2, 32


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalisation of 64-bit words (xor-shift and multiply)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: bytes, shingle: int = 3) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles of a text (fewer words: of the whole
    sequence; no words: none)."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return np.zeros(0, dtype=_U)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(w, SEED) for w in words), dtype=_U, count=len(words))
    width = min(shingle, len(words))
    out = np.full(len(words) - width + 1, width, dtype=_U)
    for i in range(width):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i])
    return np.unique(out)


def _functions(positions: int) -> tuple[np.ndarray, np.ndarray]:
    rnd = np.random.default_rng(SEED)
    a = rnd.integers(0, 1 << 31, positions, dtype=_W) * _W(2) + _W(1)
    return a, rnd.integers(0, 1 << 32, positions, dtype=_W)


def signatures(sets: list[np.ndarray], positions: int = TESTS[-1]) -> np.ndarray:
    """MinHash signatures (32-bit minima, one linear function of the hashes' upper halves per
    position) of sets that are not empty."""
    a, b = _functions(positions)
    out = np.full((len(sets), positions), np.iinfo(_W).max, dtype=_W)
    at, group, size = 0, [], 0

    def done(first: int, group: list[np.ndarray]):
        values = (np.concatenate(group) >> _U(32)).astype(_W)
        starts = np.cumsum([0, *map(len, group[:-1])])
        rows, moved = slice(first, first + len(group)), np.empty_like(values)
        for i in range(positions):
            np.add(np.multiply(values, a[i], out=moved), b[i], out=moved)
            least = np.minimum.reduceat(moved, starts)
            np.minimum(out[rows, i], least, out=out[rows, i])

    for i, s in enumerate(sets):
        for part in range(0, len(s), BLOCK_SHINGLES):
            piece = s[part:part + BLOCK_SHINGLES]
            if group and (size + len(piece) > BLOCK_SHINGLES or part):
                done(at, group)
                group, size = [], 0
            if not group:
                at = i
            group.append(piece)
            size += len(piece)
    if group:
        done(at, group)
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of every signature."""
    parts = signature[:, :bands * rows].reshape(len(signature), bands, rows).astype(_U)
    key = np.broadcast_to(np.arange(bands, dtype=_U), parts.shape[:2])
    for i in range(rows):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def packed(signature: np.ndarray) -> np.ndarray:
    """Two bits of every position, 32 to a word."""
    low = ((signature ^ (signature >> _W(15))) & _W(3)).astype(_U).reshape(len(signature), -1, _PER_WORD)
    shifts = np.arange(_PER_WORD, dtype=_U) * _U(_BITS)
    return np.bitwise_or.reduce(low << shifts, axis=2).view(np.int64)


def least_matches(threshold: float, tests: tuple = TESTS, miss: float = MISS,
                  chance: float = 0.5 ** _BITS) -> list[int]:
    """Per number of compared positions: the fewest matches at which a pair still has a posterior
    probability of ``miss`` or more to reach the threshold.

    A position matches with probability p = s + (1 - s) * chance for similarity s. Under a uniform
    prior of s, p has the density of Beta(m + 1, n - m + 1) above ``chance``, whose tail beyond q is
    the probability of m or fewer successes among n + 1 trials with q."""
    def tails(n: int, q: float) -> np.ndarray:
        """For every m the probability of m or fewer successes among n + 1 trials."""
        logs = [lgamma(n + 2) - lgamma(j + 1) - lgamma(n + 2 - j) + j * log(q)
                + (n + 1 - j) * log(1 - q) for j in range(n + 1)]
        return np.cumsum(np.exp(logs))

    q = threshold + (1 - threshold) * chance
    return [int(np.argmax(tails(n, q) >= miss * tails(n, chance))) for n in tests]


def _different(a: str, b: str, word: int) -> str:
    """Positions that differ in one word of two packed signatures, as SQL."""
    x = f"({a}{word} ^ {b}{word})"
    return f"bit_count(({x} | shiftrightunsigned({x}, 1)) & {0x5555555555555555}L)"


def likely(a: str, b: str, threshold: float, tests: tuple = TESTS, miss: float = MISS) -> Column:
    """The sequence of tests as one condition on the words ``<a>0``, ``<a>1``, ... of two
    signatures; a pair that fails one is not compared further."""
    return F.expr(" AND ".join(
        f"{' + '.join(_different(a, b, w) for w in range(n // _PER_WORD))} <= {n - least}"
        for n, least in zip(tests, least_matches(threshold, tests, miss))))


def _words(array: str, name: str, n: int) -> list[Column]:
    """The elements of an array of longs as columns ``<name>0``, ``<name>1``, ...; short and never
    NULL, so that a join condition over them stays a small compiled method."""
    return [F.expr(f"coalesce(get({array}, {i}), 0L) AS {name}{i}") for i in range(n)]


def _similar_size(a: str, b: str, num: int, den: int) -> Column:
    return den * F.least(a, b) >= num * F.greatest(a, b)


def prints(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int,
           positions: int) -> DataFrame:
    """doc_id, key (of the text), node (128-bit digest of the set, NULL if empty), n, bands, sig
    for every row of ``docs``."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1, BLOCK_BYTES):
                sets = [shingle_set(t, shingle) for t in texts(part.column(1))]
                full = [s for s in sets if len(s)]
                at = np.cumsum([bool(len(s)) for s in sets]) - 1
                sig = signatures(full, positions) if full else None
                keys = band_keys(sig, bands, rows).tolist() if full else []
                words = packed(sig).tolist() if full else []
                have = [bool(len(s)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                               for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([keys[i] if h else None for i, h in zip(at, have)],
                              pa.list_(pa.int64())),
                     pa.array([words[i] if h else None for i, h in zip(at, have)],
                              pa.list_(pa.int64()))],
                    ["doc_id", "key", "node", "n", "bands", "sig"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("key"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, key long, node binary, n long, "
                                  "bands array<long>, sig array<long>")


def full_sets(docs: DataFrame, text_col: str, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) for the sets ``wanted(node, key)``, hashed again from one text each."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1, BLOCK_BYTES):
                sets = [shingle_set(t, shingle) for t in texts(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["node", "shingles"])

    keyed = docs.select(F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    # copies of a text meet once, combined where they lie
    one = keyed.join(wanted.select("key").distinct(), "key", "left_semi").groupBy("key").agg(
        F.min("text").alias("text"))
    return one.select("key", "text").mapInArrow(run, "node binary, shingles array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (u, v) whose full sets reach the threshold."""
    one = sets.select(F.col("node").alias("u"), F.col("shingles").alias("s"))
    two = sets.select(F.col("node").alias("v"), F.col("shingles").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    return (pairs.join(one, "u").join(two, "v")
            .where(den * both >= num * (F.size("s") + F.size("t") - both)).select("u", "v"))


def shared_bands(nodes: DataFrame) -> DataFrame:
    """(band, hash, node, n, pivots, members) for every band of a set that another set shares;
    pivots are up to ``PIVOTS`` sets of the band's bucket, chosen by hashes of their digests."""
    index = nodes.select("node", "n", F.posexplode("bands").alias("band", "hash"))
    drawn = [F.min(F.struct(F.xxhash64("node", F.lit(i)), "node"))["node"] for i in range(PIVOTS)]
    buckets = index.groupBy("band", "hash").agg(
        F.array_distinct(F.array(*drawn)).alias("pivots"),
        F.count(F.lit(1)).alias("members")).where("members > 1")
    return index.join(buckets, ["band", "hash"])


def near_links(nodes: DataFrame, shared: DataFrame, sets: DataFrame, num: int, den: int,
               bands: int, tests: tuple, miss: float) -> DataFrame:
    """(node, root) of all sets that have a link; ``nodes(node, n, bands, sig)``."""
    words = tests[-1] // _PER_WORD

    def alike(a: str, b: str) -> Column:
        return (_similar_size(f"n_{a}", f"n_{b}", num, den)
                & likely(f"sig_{a}", f"sig_{b}", num / den, tests, miss))

    # every member with the pivots of its bucket
    one, two = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"),
                             *_words("sig", f"sig_{x}", words)) for x in "uv")
    stars = (shared.select("node", F.explode("pivots").alias("pivot"))
             .where("node <> pivot").select(F.greatest("node", "pivot").alias("u"),
                                            F.least("node", "pivot").alias("v")).distinct())
    near = (F.col("u") == F.col("u2")) & alike("u", "v")
    tried = cut(stars.join(two, "v").join(one.withColumnRenamed("u", "u2"), near).select("u", "v"))
    roots = cut(connected_components(_verified(tried, sets, num, den)))

    # what is still in different components and shares a bucket
    placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = (placed.groupBy("band", "hash").agg(
        F.min("root").alias("first"), F.max("root").alias("last"))
        .where(F.col("first") != F.col("last")).select("band", "hash"))
    rest = cut(placed.join(mixed, ["band", "hash"]).join(
        nodes.select("node", "bands", "sig"), "node"))
    blocks = F.ceil(F.col("members") / F.lit(PIECE)).cast("int")

    def side(x: str, block: Column) -> DataFrame:
        return rest.select(
            "band", "hash", *[F.col(c).alias(a) for c, a in (
                ("node", x), ("n", f"n_{x}"), ("root", f"root_{x}"))],
            *_words("sig", f"sig_{x}", words), *_words("bands", f"key_{x}", bands),
            block.alias("block"))

    one = side("u", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    two = side("v", F.explode(F.sequence(F.lit(0), blocks - 1)))
    before = F.expr(" OR ".join(f"(band > {i} AND key_u{i} = key_v{i})" for i in range(bands)))
    crossing = (alike("u", "v") & (F.col("u") > F.col("v"))
                & (F.col("root_u") != F.col("root_v")) & ~before)
    met = (one.join(two.withColumnsRenamed({"band": "band_v", "hash": "hash_v",
                                            "block": "block_v"}),
                    (F.col("hash") == F.col("hash_v")) & (F.col("block") == F.col("block_v"))
                    & (F.col("band") == F.col("band_v")) & crossing))
    more = met.select("u", "v").join(tried, ["u", "v"], "left_anti")
    links = _verified(cut(more), sets, num, den)
    return connected_components(
        roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links))


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 3, num: int = 85, den: int = 100, bands: int = BANDS,
                  rows: int = ROWS, tests: tuple = TESTS, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Two documents are linked if the intersection of their sets of word shingles has ``num`` /
    ``den`` or more of the union. component_id is the smallest id reachable over links, itself
    included; kept marks the rows of that id. An empty or NULL text, or one without words, has no
    shingles, is linked with nothing and is its own component. A NULL id never names a component
    unless all its members have none; then all of them are kept. Repeated rows are repeated in the
    result; an empty table gives an empty result. Other columns of ``docs`` are not read.

    Sets are held as 64-bit hashes of their shingles: within a pair of sets of a million shingles
    two different ones fall together with probability 2e-7.
    """
    if any(n % _PER_WORD for n in tests) or sorted(tests) != list(tests) or (
            tests[-1] < bands * rows):
        raise ValueError(f"tests must rise, be multiples of {_PER_WORD} and cover all bands")
    table = cut(prints(docs, id_col, text_col, shingle, bands, rows, tests[-1]))
    full = table.where(F.col("node").isNotNull())
    nodes = cut(full.groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("key").alias("key"),
        F.min("bands").alias("bands"), F.min("sig").alias("sig")))
    shared = cut(shared_bands(nodes))
    paired = nodes.join(shared.select("node").distinct(), "node", "left_semi")
    sets = cut(full_sets(docs, text_col, paired, shingle))
    roots = near_links(paired.select("node", "n", "bands", "sig"), shared, sets, num, den, bands,
                       tests, miss)
    joined = (nodes.select("node", "least").join(roots, "node", "left")
              .select("node", "least", F.coalesce("root", "node").alias("root")))
    best = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(best, "root").select("node", "component_id")
    linked = full.select("doc_id", "n", "node").join(named, "node").drop("node")
    alone = table.where(F.col("node").isNull()).select("doc_id", "n",
                                                       F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
