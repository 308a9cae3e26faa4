from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from delaylab.llm import mixing

from .helpers import awkward_rows, table


def slow_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    rest, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 2 * sizes[s]
            rest -= out[s]
            free.discard(s)
    return out


def test_targets_match_resharing():
    rnd = random.Random(1)
    for _ in range(300):
        sizes = {(None if i == 3 else f"s{i}"): rnd.randrange(1000)
                 for i in range(rnd.randrange(1, 12))}
        fast, slow = mixing.target_sizes(sizes), slow_targets(sizes)
        assert all(abs(fast[s] - slow[s]) < 1e-6 for s in sizes)


def test_flow_is_cheapest():
    """Against all integer splits of a small network."""
    supplies, members = {"A": 4, "B": 3, "AB": 3}, {"A": ["a"], "B": ["b"], "AB": ["a", "b"]}
    for qa in range(0, 15, 3):
        for qb in range(0, 13, 3):
            flow = mixing.min_cost_flow(supplies, {"a": qa, "b": qb}, members)
            best = None
            for a in range(9):
                for b in range(7):
                    for x in range(7):
                        for y in range(7 - x):
                            if a + x <= qa and b + y <= qb:
                                again = max(0, a - 4) + max(0, b - 3) + max(0, x + y - 3)
                                best = max(best or (-1, 0), (a + b + x + y, -again))
            used = {p: sum(f for (q, _), f in flow.items() if q == p) for p in supplies}
            again = sum(max(0, used[p] - supplies[p]) for p in supplies)
            assert (sum(used.values()), -again) == best
            assert all(sum(f for (_, s), f in flow.items() if s == t) <= q
                       for t, q in (("a", qa), ("b", qb)))


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = awkward_rows(n=300)
    got = mixing.mix(table(spark, rows)).collect()
    again = mixing.mix(table(spark, rows).repartition(7)).collect()
    pick = lambda out: sorted((str(r.doc_id), r.size, r.taken) for r in out)
    assert pick(got) == pick(again) and len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r.size for r in got) == sorted(size(r[1]) for r in rows)
    sources = {}
    for _, text, _, source in rows:
        sources[source] = sources.get(source, 0) + size(text)
    targets = slow_targets(sources)
    by_size = {v: k for k, v in sources.items()}
    for total, source in by_size.items():
        own = [r for r in got if r.source_size == total]
        largest = max(r.size for r in own)
        assert abs(sum(r.taken for r in own) - targets[source]) <= largest
        assert all(r.taken <= 2 * r.size and abs(r.target - targets[source]) < 1e-6 for r in own)


def test_overlapping_sources_and_empty_table(spark):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit("a"))).when(
            F.col("id") % 3 == 1, F.array(F.lit("b"))).otherwise(
            F.array(F.lit("b"), F.lit("a"))).alias("source"))
    got = mixing.mix(docs)
    assert got.count() == 900
    targets = mixing.target_sizes({"a": 1800, "b": 1800})
    assert abs(got.agg(F.sum("taken")).first()[0] - sum(targets.values())) <= 9
    assert mixing.mix(table(spark, [])).collect() == []


def test_reruns_agree_with_shared_and_missing_ids(spark):
    """The same words of the same texts are taken on any layout of the rows."""
    rnd = random.Random(8)
    rows = [(rnd.choice([None, 1, 2, 3]), " ".join(f"w{i}x{j}" for j in range(rnd.randrange(1, 40))),
             "en", rnd.choice(["a", "b", "c"])) for i in range(400)]
    taken = set()
    for parts in (1, 3, 7):
        docs = table(spark, rows).repartition(parts)
        found = mixing.mix(docs).select("doc_id", "_key", "size", "taken").collect()
        taken.add(tuple(sorted(map(tuple, found), key=str)))
    assert len(taken) == 1 and any(r[3] > 0 for r in next(iter(taken)))
