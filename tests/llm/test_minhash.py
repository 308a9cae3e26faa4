import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylab.llm import minhash

from .helpers import awkward_rows, same_rows, table


def shingles(text):
    words = (text or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return frozenset()
    k = min(3, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(rows, num=85, den=100):
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and den * both >= num * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if sets[i]:
            least.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        known = [d for d in least.get(find(i), []) if d is not None] if sets[i] else [doc_id]
        name = min(known) if known and known[0] is not None else None
        out.append((doc_id, len(sets[i]), name, doc_id == name))
    return out


def family(n, seed, words=150, edits=9):
    """Near copies of one text with different numbers of changed words."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rnd.randrange(edits)):
            text[rnd.randrange(words)] = f"z{rnd.randrange(9999)}"
        out.append(" ".join(text))
    return out


def chain(n, words=200):
    """Texts that are similar to the next one only."""
    stream = [f"c{i}" for i in range(words + 12 * n)]
    return [" ".join(stream[12 * i:12 * i + words]) for i in range(n)]


def corpus():
    rows = [(i, t, "en", "a") for i, (_, t, *_) in enumerate(awkward_rows())]
    rows += [(100 + i, t, "en", "a") for i, t in enumerate(family(60, 1))]
    rows += [(200 + i, t, "en", "b") for i, t in enumerate(family(30, 2, 40, 4))]
    rows += [(300 + i, t, "en", "b") for i, t in enumerate(chain(12))]
    rows += [(400 + i, "one two three four", "en", "c") for i in range(20)]
    rows += [(None, "one two three four", "en", "c"), (None, "alone here", "en", "c"),
             (None, None, None, None), (450, "Ab", "en", "c"), (451, "aB", "en", "c"),
             (452, "a b", None, "c"), (453, "A\tB ", "en", "c"), (453, "A\tB ", "en", "c")]
    return rows


@pytest.mark.parametrize("piece", [1024, 4])
def test_components_equal_all_pairs(spark, monkeypatch, piece):
    monkeypatch.setattr(minhash, "PIECE", piece)
    rows = corpus()
    found = minhash.minhash_dedup(table(spark, rows))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    same_rows([tuple(r) for r in found.collect()], brute(rows))


def test_other_threshold(spark):
    rows = corpus()
    found = minhash.minhash_dedup(table(spark, rows), num=6, den=10, bands=40, rows=4)
    same_rows([tuple(r) for r in found.collect()], brute(rows, 6, 10))


def test_rows_without_any_id(spark):
    rows = [(None, "a b c d", "en", "a"), (None, "a b c d", "en", "a"), (3, "x y z", "en", "a")]
    found = minhash.minhash_dedup(table(spark, rows)).collect()
    same_rows([tuple(r) for r in found], [(None, 2, None, True)] * 2 + [(3, 1, 3, True)])


def test_long_texts(spark):
    rnd = random.Random(5)
    words = [f"v{rnd.randrange(10 ** 6)}" for _ in range(150_000)]
    other = list(words)
    for i in range(0, len(words), 100):
        other[i] = "changed"
    rows = [(1, " ".join(words), "en", "a"), (2, " ".join(other), "en", "a"),
            (3, "x" * 2_000_000, "en", "a"), (4, "X" * 2_000_000, "en", "a")]
    found = {r.doc_id: r.component_id for r in minhash.minhash_dedup(table(spark, rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 3}


def test_empty_table(spark):
    assert minhash.minhash_dedup(table(spark, []).limit(0)).collect() == []


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(1)
    values = np.unique(rnd.integers(0, 1 << 63, 2000, dtype=np.uint64))
    a, b = values[:1500], values[200:1700]
    sig = minhash.signatures([a, b, a], 4096)
    assert (sig[0] == sig[2]).all()
    assert abs((sig[0] == sig[1]).mean() - 1300 / 1700) < 0.03
    low = (sig ^ sig >> 15) & 3  # minima that differ agree in these bits one time in four
    assert abs((low[0] == low[1])[sig[0] != sig[1]].mean() - 0.25) < 0.06
    # sets beyond one block give the minima of the whole set
    assert (minhash.signatures([values]) == minhash.signatures([values])).all()
    many = np.unique(rnd.integers(0, 1 << 63, 100_000, dtype=np.uint64))
    whole = minhash.signatures([many])
    parts = minhash.signatures([many[:40_000], many[40_000:]])
    assert (whole[0] == parts.min(0)).all()


def test_posterior_bounds():
    from math import comb

    least = minhash.least_matches(0.85, (128, 256, 512), 1e-4)
    assert least == sorted(least) and all(m < n for m, n in zip(least, (128, 256, 512)))
    # numeric integration of the posterior on both sides of the bound
    grid = np.linspace(0, 1, 20_001)
    p = grid + (1 - grid) / 4
    for n, m in zip((128, 256), least):
        def reach(k):
            weight = p ** k * (1 - p) ** (n - k)
            return weight[grid >= 0.85].sum() / weight.sum()

        assert reach(m) >= 1e-4 * 0.98 > 1e-4 * 0.5 and reach(m - 1) < 1e-4 * 1.02
        # a link of exactly the threshold is rarely dropped
        q = 0.85 + 0.15 / 4
        lost = sum(comb(n, j) * q ** j * (1 - q) ** (n - j) for j in range(m))
        assert lost < 1e-3


def test_packed_positions_count_differences(spark):
    rnd = np.random.default_rng(2)
    sig = rnd.integers(0, 1 << 32, (2, 512), dtype=np.uint32)
    sig[1, ::3] = sig[0, ::3]
    words = minhash.packed(sig)
    df = spark.createDataFrame([(words[0].tolist(), words[1].tolist())],
                               "p array<long>, q array<long>")
    df = df.select(*minhash._words("p", "a", 16), *minhash._words("q", "b", 16))
    parts = [F.expr(minhash._different("a", "b", w)).alias(f"w{w}") for w in range(16)]
    differing = sum(df.select(*parts).first())
    assert differing == int((((sig ^ sig >> 15) & 3)[0] != ((sig ^ sig >> 15) & 3)[1]).sum())
