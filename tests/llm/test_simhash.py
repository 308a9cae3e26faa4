from __future__ import annotations

import re

import xxhash

from delaylab.llm import simhash
from delaylab.llm.components import connected_components

from .helpers import awkward_rows, same_rows, table


def slow_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or (
        [" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64)
               if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, distance):
    root = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return root


def expected(rows, distance=3):
    prints = [slow_fingerprint(r[1]) for r in rows]
    root = classes(prints, distance)
    out = []
    for i, (r, p) in enumerate(zip(rows, prints)):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i]
               and rows[j][0] is not None]
        out.append((r[0], f"{p:016x}", min(ids) if ids else None))
    return out


def test_matches_brute_force_on_awkward_rows(spark):
    rows = awkward_rows()
    for distance in (0, 3, 20):
        got = simhash.simhash_dedup(table(spark, rows), max_distance=distance,
                                    segments=2 if distance < 4 else 8).collect()
        same_rows([tuple(g) for g in got], expected(rows, distance))


def test_empty_table(spark):
    assert simhash.simhash_dedup(table(spark, [])).collect() == []


def test_links_find_every_pair(spark):
    import random

    rnd = random.Random(5)
    values = {rnd.getrandbits(64)}
    for _ in range(150):
        near = rnd.choice(sorted(values))
        for _ in range(rnd.randrange(0, 6)):
            near ^= 1 << rnd.randrange(64)
        values.add(near)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {(r.u, r.v) for r in simhash.links(
        spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    want = {(max(a, b), min(a, b)) for a in signed for b in signed
            if a != b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3}
    assert got == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = {r.node: r.root for r in connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}
