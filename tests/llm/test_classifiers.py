from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from delaylab.llm import quality_pu, toxicity

from .helpers import awkward_rows, table


def slow_segments(scores):
    def split(lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                if total > 1e-9 and (best is None or total > best[0] + 1e-9):
                    best = total, i, j
        if best is None:
            return []
        return [*split(lo, best[1]), (best[1], best[2]), *split(best[2] + 1, hi)]
    return split(0, len(scores))


def test_segments_match_recursive_definition():
    rnd = random.Random(2)
    for _ in range(600):
        gap = -rnd.choice([0.37, 1.13])
        scores = [gap if rnd.random() < 0.6 else rnd.choice([1.019, 2.303, -0.511, 0.707])
                  for _ in range(rnd.randrange(14))]
        at = [i for i, s in enumerate(scores) if s != gap]
        got = toxicity.segments(at, [scores[i] for i in at], gap)
        assert [(a, b) for a, b, _ in got] == slow_segments(scores)


def test_segments_take_linear_time():
    import time

    n = 200_000
    scores = [1.0 + (i % 7) / 10 if i % 2 else -1.3 for i in range(n)]
    began = time.perf_counter()
    toxicity.segments(range(n), scores, -1.0)
    toxicity.segments(range(n), [-s for s in scores], -1.0)
    assert time.perf_counter() - began < 5


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    n1 = int((y == 1).sum())
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


@pytest.mark.parametrize("label", ["toxic", "quality"])
def test_held_out_accuracy(spark, label):
    from delaylab.llm import queries

    sf = "/root/testdata/sf0.01"
    query = queries.op6_toxicity if label == "toxic" else queries.op7_quality
    got = query(spark, sf)
    fold, mod = (2, 4) if label == "toxic" else (0, 5)
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select(
        "doc_id", "held_out", "score", "predicted", label).toPandas()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(h == (zlib.crc32(str(i).encode()) % mod == fold)
               for i, h in zip(rows["doc_id"], rows["held_out"]))
    held = rows[rows["held_out"]]
    assert auc(held["score"].to_numpy(), held[label].to_numpy()) > 0.85
    assert (held["predicted"] == held[label]).mean() > 0.9
    assert rows["score"].between(0, 1).all()


@pytest.mark.parametrize("run", [toxicity.toxicity, quality_pu.quality_scores])
def test_awkward_rows_and_empty_tables(spark, run):
    rows = awkward_rows()
    marks = spark.createDataFrame(
        [(i, i % 2, i % 3 % 2, "x") for i in range(30)] + [(None, 1, 1, "x"), (5, None, None, "x"),
                                                           (9999, 1, 1, "x")],
        "doc_id long, quality int, toxic int, label string")
    none = marks.limit(0)
    for labels in (marks, none):
        got = run(table(spark, rows), labels).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        assert run(table(spark, []), labels).collect() == []


def test_prior_and_non_negative_risk_on_gaussians():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (4000, 2)), rng.normal(-1.5, 1, (4000, 2))
    unlabelled = np.vstack([good[:2800], bad[:1200]])
    prior = quality_pu.class_prior(good[2800:], unlabelled, rng)
    assert abs(prior - 0.7) < 0.08
    net = quality_pu.fit(good[2800:], unlabelled, prior, rng, 20)
    assert (net.forward(good[:1000])[0] > 0).mean() > 0.93
    assert (net.forward(bad[2000:])[0] < 0).mean() > 0.9


def test_repeated_labelled_rows_count_once(spark):
    docs = spark.createDataFrame([(1, "bad word"), (1, "bad word"), (1, "bad word"),
                                  (2, "bad word"), (3, "good one")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    found = toxicity._labelled(docs, labels, "toxic", lambda _: F.lit(True))
    assert sorted(map(tuple, found.collect())) == [(1, "bad word", 1), (3, "good one", 0)]
