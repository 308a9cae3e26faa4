"""As-of join, mergeable distinct counts, matrix correlations and stable metrics."""

from __future__ import annotations

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylab.ml import evaluate
from delaylab.operators import explore, sketches
from delaylab.operators._plan import split_as
from delaylab.operators.asof import asof_join, nearest_event_distance
from delaylab.session import scratch_path


def brute(left, right, direction):
    out = []
    for i, k, t in left:
        past = [(x, v) for kk, x, v in right if kk == k and k is not None and t is not None
                and x is not None and x <= t]
        coming = [(x, v) for kk, x, v in right if kk == k and k is not None and t is not None
                  and x is not None and x >= t]
        a, b = max(past, default=None), min(coming, default=None)
        if direction == "backward":
            found = a
        elif direction == "forward":
            found = b
        else:
            found = b if b and (not a or b[0] - t < t - a[0]) else a
        out.append((i, k, t, *(found or (None, None))))
    return out


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("parts", [1, 13])
def test_equals_brute_force(spark, direction, parts):
    rnd = random.Random(parts)
    left = [(i, rnd.choice(["a", "b", "c", None]), rnd.choice([None, *range(0, 300, 3)]))
            for i in range(400)]
    left += [(1000 + i, "a", 50) for i in range(300)] + [left[0], left[0]]  # a crowded instant
    right = [(k, x, 10 * x + j) for j, k in enumerate("abd") for x in rnd.sample(range(300), 20)]
    right += [(None, 5, 1), ("a", None, 2)]
    lf = spark.createDataFrame(left, "id int, k string, t int").repartition(3)
    rt = spark.createDataFrame(right, "k string, t int, v int").repartition(2)
    found = asof_join(lf, rt, "t", "t", by="k", direction=direction, num_partitions=parts)
    assert found.columns == ["id", "k", "t", "t_event", "v"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        brute(left, right, direction), key=str)


def test_without_keys_a_crowded_instant_is_split(spark):
    left = spark.range(4000).select("id", F.when(F.col("id") < 3000, 7).otherwise(
        (F.col("id") % 100).cast("int")).alias("t"))
    right = spark.createDataFrame([(3, "x"), (7, "y"), (50, "z")], "t int, v string")
    found = asof_join(left, right, "t", "t", num_partitions=16)
    got = {(r.t, r.v) for r in found.select("t", "v").distinct().collect()}
    assert got == {(t, None if t < 3 else "x" if t < 7 else "y" if t < 50 else "z")
                   for t in range(100)}
    assert found.count() == 4000


def test_empty_tables_and_bad_arguments(spark):
    left = spark.createDataFrame([(1, 5)], "id int, t int")
    none = spark.createDataFrame([], "t int, v int")
    assert [tuple(r) for r in asof_join(left, none, "t", "t").collect()] == [(1, 5, None, None)]
    assert asof_join(left.where("id < 0"), none, "t", "t").collect() == []
    with pytest.raises(ValueError):
        asof_join(left, none, "t", "t", direction="sideways")
    with pytest.raises(ValueError):
        asof_join(left, none, "t", "t", suffix="")


def test_nearest_event_of_a_large_calendar(spark):
    rnd = random.Random(4)
    day = dt.date(1990, 1, 1)
    calendar = sorted({day + dt.timedelta(rnd.randrange(9000)) for _ in range(4000)})
    dates = [day + dt.timedelta(rnd.randrange(-100, 9100)) for _ in range(500)] + [None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "id int, d date")
    events = spark.createDataFrame([(d,) for d in calendar * 2], "e date")
    found = {r.id: r.n for r in nearest_event_distance(df, "d", events, "e", "n").collect()}
    assert found == {i: None if d is None else min(abs((d - c).days) for c in calendar)
                     for i, d in enumerate(dates)}


def test_a_year_is_added_without_reading_the_others(spark):
    path = scratch_path(spark, "sketch-test")
    df = spark.range(60_000).select(
        (F.lit(2005) + F.col("id") % 3).cast("string").alias("Year"),
        (F.col("id") % 20_011).alias("many"), F.lit("one").alias("one"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("few"))
    cols = ["many", "one", "few"]
    sketches.store_sketches(df.where("Year <> '2007'"), path, cols)
    local = path.removeprefix("file:")
    before = {f: os.path.getmtime(f"{local}/Year=2005/{f}") for f in os.listdir(
        f"{local}/Year=2005")}
    sketches.store_sketches(df.where("Year = '2007'"), path, cols)
    sketches.store_sketches(df.where("Year = '2007'"), path, cols)  # again: replaced, not added
    assert before == {f: os.path.getmtime(f"{local}/Year=2005/{f}") for f in os.listdir(
        f"{local}/Year=2005")}
    found = {r["column"]: r for r in sketches.stored_distinct(spark, path).collect()}
    assert {c: r["rows"] for c, r in found.items()} == {
        "many": 60_000, "one": 60_000, "few": 30_000}
    assert found["one"]["n_distinct"] == 1 and found["few"]["n_distinct"] == 25
    error = 4 * sketches.standard_error()
    assert abs(found["many"]["n_distinct"] - 20_011) <= error * 20_011
    some = sketches.stored_distinct(spark, path, only={"Year": ["2006"]}).where(
        "column = 'many'").first()
    assert some["rows"] == 20_000 and abs(some["n_distinct"] - 20_000) <= error * 20_000


def test_gram_equals_pairwise_correlations(spark):
    df = spark.range(500).select(*[
        (F.lit(1e9) + ((F.col("id") * (7 + k)) % (11 + k)) + F.col("id") * (k % 3)).alias(f"c{k}")
        for k in range(40)])
    cols = [f"c{k}" for k in range(40)]
    one = {(r.x, r.y): r["corr"] for r in explore.correlation_gram(df, cols).collect()}
    some = cols[:8]
    two = {(r.x, r.y): r["corr"] for r in explore.correlation_matrix(df, some).collect()}
    assert all(one[k] == pytest.approx(v, abs=1e-6) for k, v in two.items())
    i = np.arange(500)
    exact = np.corrcoef([(i * (7 + k)) % (11 + k) + i * (k % 3) for k in range(40)])
    assert len(one) == 1600
    for a, x in enumerate(cols):
        for b, y in enumerate(cols):
            assert one[x, y] == pytest.approx(exact[a, b], abs=1e-9)
    gaps = df.select(F.when(F.col("c1") > 1e9 + 3, F.col("c1")).alias("c1"), "c2")
    assert {(r.x, r.y): r["corr"] for r in explore.correlation_gram(gaps, ["c1", "c2"]).collect()
            }[("c1", "c2")] == pytest.approx(gaps.dropna().corr("c1", "c2"))
    assert explore.correlation_gram(df.limit(0), cols).count() == 0


def test_metrics_of_large_labels(spark):
    rnd = random.Random(6)
    rows = [(1e9 + rnd.gauss(0, 1), 1e9 + rnd.gauss(0.5, 2)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "y double, p double").repartition(5)
    m = evaluate.regression_metrics(df, "p", "y").first()
    ys = [y - 1e9 for y, _ in rows]
    ps = [p - 1e9 for _, p in rows]
    mean = sum(ys) / len(ys)
    var = sum((p - mean) ** 2 for p in ps) / len(ps)
    mse = sum((p - y) ** 2 for y, p in zip(ys, ps)) / len(ps)
    r2 = 1 - mse / (sum((y - mean) ** 2 for y in ys) / len(ys))
    assert (m["var"], m["mse"], m["r2"]) == pytest.approx((var, mse, r2), rel=1e-6)


def test_tasks_follow_from_the_rows(spark):
    few = spark.range(10).coalesce(1)
    assert split_as(few, 600_000) == 8 and split_as(few, 100_000_000) == 200
    assert split_as(spark.range(100).repartition(9), 600_000) is None
