import math
import random

import pytest
from pyspark.sql import functions as F

from delaylab.llm import rtree

from .helpers import same_rows

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, part int, block int"


def brute(rows, k=5, positives=5, ratio=(80, 100), every=10):
    import numpy as np

    pts = []
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(
                x is None or not math.isfinite(x) for x in v):
            continue
        pts.append((i, lab, [math.floor(256 * float(np.float32(x))) for x in v]))
    out, seen = [], set()
    for a, lab, av in pts:
        if a % every or (a, lab, tuple(av)) in seen:
            continue
        seen.add((a, lab, tuple(av)))
        s = [(-sum(x * y for x, y in zip(av, v)), i, q) for i, q, v in pts]
        for ps, p, q in sorted(x for x in s if x[2] == lab and x[1] != a)[:positives]:
            neg = sorted(x for x in s if x[2] != lab
                         and ratio[0] * -ps <= ratio[1] * -x[0] <= ratio[1] * -ps)[:k]
            out += [(a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(neg, 1)]
    return out


def points(n=900, dim=5, seed=1, labels=4):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0.05, 0.3) for _ in range(dim)], rnd.randrange(labels))
            for i in range(n)]
    rows += [(n + i, [0.2] * dim, i % 3) for i in range(200)]  # a common vector: ties
    rows += [(n + 300, [0.1] * (dim - 2), 1), (n + 310, [], 2), (n + 320, [0.0] * dim, 0),
             (n + 330, [float("nan")] * dim, 1), (n + 340, [float("inf")] * dim, 1),
             (n + 350, [None] * dim, 1), (n + 360, None, 1), (n + 370, [0.1] * dim, None),
             (None, [0.1] * dim, 1), (n + 380, [0.3] * dim, 77),  # a label of its own
             (n + 390, [0.25] * dim, 1), (n + 390, [0.25] * dim, 1)]  # a repeated anchor
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("leaf,part,block", [(128, 8192, 1024), (8, 100, 7)])
def test_equals_all_products(spark, monkeypatch, leaf, part, block):
    monkeypatch.setattr(rtree, "LEAF", leaf)
    monkeypatch.setattr(rtree, "PART_ROWS", part)
    monkeypatch.setattr(rtree, "BLOCK_ANCHORS", block)
    rows = points()
    found = rtree.hard_negatives(table(spark, rows), F.col("id") % 10 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                             "negative_score"]
    same_rows([tuple(r) for r in found.collect()], brute(rows))


def test_other_bounds(spark):
    rows = points(300, 3, 2, 2)
    found = rtree.hard_negatives(table(spark, rows), F.col("id") % 10 == 0, k=2, positives=3,
                                 ratio=(50, 100))
    same_rows([tuple(r) for r in found.collect()], brute(rows, 2, 3, (50, 100)))


def test_large_components_stay_exact(spark):
    rows = [(i, [float((-1) ** j * 2.0 ** 14 * (i + 1 + j)) for j in range(4)], i % 2)
            for i in range(40)]
    found = rtree.hard_negatives(table(spark, rows), F.col("id") % 10 == 0)
    same_rows([tuple(r) for r in found.collect()], brute(rows))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rtree.hard_negatives(empty, F.col("id") % 10 == 0).collect() == []
    rows = table(spark, [(1, [0.1], 1), (3, None, None)])
    assert rtree.hard_negatives(rows, F.col("id") % 10 == 0).collect() == []


def test_queue_skips_boxes():
    """Well separated groups: a search opens few leaves and gives what a full scan gives."""
    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(3)
    vectors = [(rnd.integers(-5, 5, (50, 3)) + 1000 * np.array([g, 0, 0])).astype(np.int64)
               for g in range(64)]
    leaves = pa.table({
        "label": pa.array([0] * 64, pa.int32()),
        "ids": [np.arange(50 * g, 50 * g + 50).tobytes() for g in range(64)],
        "vectors": [v.tobytes() for v in vectors],
        "low": [v.min(0).tobytes() for v in vectors],
        "high": [v.max(0).tobytes() for v in vectors]})
    tree = rtree.Tree(leaves, 3)
    anchor = np.array([[3, 1, -2]])
    levels = tree.intervals(anchor)
    every = sorted(((int(s), int(i)) for g, v in enumerate(vectors)
                    for s, i in zip(v @ anchor[0], range(50 * g, 50 * g + 50))),
                   key=lambda x: (-x[0], x[1]))
    for least, most in [(-10 ** 9, 10 ** 9), (60_000, 90_000), (1, 2000), (0, 3)]:
        opened: dict = {}
        found = tree.search(levels, 0, anchor[0].astype(tree.kind), lambda _: True, (least, most),
                            5, opened)
        assert found == [x for x in every if least <= x[0] <= most][:5]
        assert len(opened) <= 3
