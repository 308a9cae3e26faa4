"""Cleaning, sources, windows, exploration, transforms and sampling."""

from __future__ import annotations

import hashlib
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylab.operators import clean, explore, sampling, transform, windows
from delaylab.sources import flights as src


def test_csv_dropmalformed_golden(spark, scratch):
    path = os.path.join(scratch, "h8.csv")
    with open(path, "w") as fh:
        fh.write('a,b,c\n1,2,3\n1,2\n1,2,3,4\n,x,"q"\n"",y,NA\n')
    df = src.read_flights(spark, path, columns=("a", "b", "c"))
    assert df.count() == 3
    assert df.select("a").count() == 3
    assert len(df.collect()) == 3
    pruned = src.read_flights(spark, path, columns=("a", "b", "c"), prune=True)
    assert pruned.count() == 5  # Spark's pruned count: the documented hazard
    permissive = src.read_flights(spark, path, mode="PERMISSIVE", columns=("a", "b", "c"))
    assert permissive.count() == 5


def test_flights_source_and_leakage(flights):
    assert flights.count() == 1500 + 4 + 3 + 7 + 1 + 1 + 1 + 2  # malformed rows dropped
    kept = clean.drop_leakage(flights)
    assert set(kept.columns) == set(src.FLIGHT_COLUMNS) - set(src.LEAKAGE_COLUMNS)


def test_read_years_union(spark, flights_csv):
    both = src.read_years(spark, [flights_csv, flights_csv])
    one = src.read_flights(spark, flights_csv, mode="PERMISSIVE")
    assert both.count() == 2 * one.count()


def test_sentinel_filter_and_casts(flights):
    out = clean.clean_flights(flights)
    rows = out.collect()
    assert all(r["ArrDelay"] is not None for r in rows)
    assert all(isinstance(r["ArrDelay"], int) for r in rows)
    # 'NA' in a cast column without its own filter becomes NULL instead of failing (ANSI)
    assert any(r["CRSElapsedTime"] is None for r in rows)
    assert any(r["TaxiOut"] is None for r in rows)
    assert any(r["Date"] is None for r in rows)  # 30 Feb
    assert clean.cast_columns(flights, {"Year": "int"}, keep_order=False).columns[-1] == "Year"
    assert clean.cast_columns(flights, {"Year": "int"}).columns == flights.columns


def test_sentinel_null_fails(spark):
    df = spark.createDataFrame([("1",), ("NA",), (None,)], "a string")
    assert clean.drop_na_sentinel(df, ["a"]).count() == 1
    assert clean.exclude_value(df, ["a"], "NA").count() == 1
    assert clean.numeric_columns(spark.createDataFrame([(1, 1.0, "x")],
                                                       "a int, b double, c string")) == ["a", "b"]


def test_conditional_count_golden(spark):
    df = spark.createDataFrame([(1, "X", "C"), (1, "X", "A"), (1, "X", None)],
                               "Year int, Origin string, CancellationCode string")
    keys = ("Year", "Origin")
    new = windows.add_cancellation_counts(df, keys, codes={"C": "nC"}).collect()
    assert {r["nC"] for r in new} == {1}
    old = windows.add_cancellation_counts(df, keys, codes={"C": "nC"}, count_nonnull=True)
    got = {r["CancellationCode"]: r["nC"] for r in old.collect()}
    assert got == {"C": 1, "A": 1, None: 0}
    # the reference's window form counts non-null comparisons: equal to the window plan
    win = windows.add_cancellation_counts(df, keys, codes={"C": "nC"}, count_nonnull=True,
                                          method="window")
    assert sorted(map(tuple, old.collect()), key=str) == sorted(map(tuple, win.collect()), key=str)
    assert explore.value_count(df, "CancellationCode").first()[0] == 3
    assert df.agg(F.count_distinct("CancellationCode")).first()[0] == 2


def test_group_count_join_equals_window(flights):
    f = clean.clean_flights(flights)
    keys = windows.DAY_KEYS + ("Origin",)
    a = windows.add_group_count(f, keys, "Origin", "n", method="join")
    b = windows.add_group_count(f, keys, "Origin", "n", method="window")
    assert a.count() == f.count()
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_group_count_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    out = {r["v"]: r["n"] for r in windows.add_group_count(df, ["k"], "v", "n").collect()}
    assert out == {1: 2, 2: 2, 3: 1}


def _np_quantile(xs, p):
    return float(np.quantile(np.array(xs, dtype=float), p, method="linear"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles_match_numpy(spark, seed):
    rng = random.Random(seed)
    n = rng.randint(1, 400)
    rows = [(rng.choice("abc"), float(rng.choice([rng.randint(-50, 50), rng.random() * 100])))
            for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    out = {r["g"]: r for r in explore.exact_quantiles(df, "x", probs, by="g",
                                                       num_partitions=4).collect()}
    for g in {r[0] for r in rows}:
        xs = [x for gg, x in rows if gg == g]
        for p, name in zip(probs, explore._quantile_names(probs)):
            assert math.isclose(out[g][name], _np_quantile(xs, p), rel_tol=1e-9, abs_tol=1e-9)
    glob = explore.exact_quantiles(df, "x", [0.5], names=["m"]).first()
    assert math.isclose(glob["m"], _np_quantile([x for _, x in rows], 0.5), abs_tol=1e-9)


def test_exact_quantiles_hot_value(spark):
    # a third of all rows share one value: still one row after the partial count
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("x"))
    xs = [7.0 if i % 3 == 0 else float(i) for i in range(3000)]
    got = explore.exact_quantiles(df, "x", [0.1, 0.5, 0.99], names=["a", "b", "c"]).first()
    for name, p in zip("abc", (0.1, 0.5, 0.99)):
        assert math.isclose(got[name], _np_quantile(xs, p), abs_tol=1e-9)


def test_box_stats(spark):
    xs = [1, 2, 3, 4, 5, 6, 7, 8, 9, 100, -80]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    b = explore.box_stats(df, "x").first()
    q1, q3 = _np_quantile(xs, 0.25), _np_quantile(xs, 0.75)
    iqr = q3 - q1
    assert b["q1"] == q1 and b["q3"] == q3
    inside = [x for x in xs if q1 - 1.5 * iqr <= x <= q3 + 1.5 * iqr]
    assert b["whisker_low"] == min(inside) and b["whisker_high"] == max(inside)
    assert b["n_outliers"] == 2


def test_correlations_and_histogram(spark):
    df = spark.range(0, 100).select(F.col("id").cast("double").alias("x"),
                                    (F.col("id") * 2 + 1).cast("double").alias("y"))
    c = explore.correlations(df, [("x", "y")]).first()
    assert math.isclose(c["corr"], 1.0)
    h = explore.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r["n"] for r in h] == [10] * 10
    m = explore.correlation_matrix(df, ["x", "y"]).collect()
    assert len(m) == 4


def test_top_k_deterministic(spark):
    df = spark.createDataFrame([(k,) for k in "aabbccd"], "k string")
    assert [r["k"] for r in explore.top_k(df, "k", 2).collect()] == ["a", "b"]


def test_boxcox_finds_log_on_lognormal(spark):
    rng = np.random.default_rng(0)
    xs = np.exp(rng.normal(2.0, 0.5, 4000))
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    lam = transform.best_lambda(df, "x")
    assert abs(lam) <= 0.1
    out = transform.boxcox(df, "x", "y", lam=0.0).select(F.max(F.abs(F.col("y") - F.ln("x"))))
    assert out.first()[0] < 1e-12
    s = transform.shifted_log(spark.createDataFrame([(-5.0,), (3.0,)], "x double"), "x", "y")
    assert [round(r["y"], 9) for r in s.collect()] == [0.0, round(math.log(9.0), 9)]


def test_hash_golden_and_partition_independence(spark):
    df = spark.createDataFrame([(7,)], "k long")
    golden = int(hashlib.md5(b"42:7").hexdigest()[:15], 16)
    assert df.select(sampling.hash_unit(["k"], 42)).first()[0] == golden
    keys = spark.range(1, 15001).withColumnRenamed("id", "k")
    share = keys.select((sampling.hash_unit(["k"], 42) < sampling.hash_bound(0.7)).cast("int")
                        .alias("t")).agg(F.avg("t")).first()[0]
    assert abs(share - 0.7) < 0.01
    a = sampling.hash_split(keys.repartition(3), ["k"]).select("k", "split")
    b = sampling.hash_split(keys.repartition(11), ["k"]).select("k", "split")
    assert a.exceptAll(b).count() == 0


def test_disjoint_chunks(spark):
    keys = spark.range(0, 20000).withColumnRenamed("id", "k")
    c = sampling.disjoint_chunks(keys, ["k"], n=6, fraction=0.01)
    assert c.count() == c.select("k").distinct().count()
    sizes = {r["chunk"]: r["count"] for r in c.groupBy("chunk").count().collect()}
    assert set(sizes) == set(range(6)) and all(120 <= v <= 280 for v in sizes.values())
    train, test = sampling.train_test_chunks(c, 5)
    assert train.join(test, "k").count() == 0
    with pytest.raises(ValueError):
        sampling.disjoint_chunks(keys, ["k"], n=20, fraction=0.1)


def test_except_distinct_vs_all(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "a int")
    used = spark.createDataFrame([(3,)], "a int")
    assert sorted(r[0] for r in sampling.remaining_rows(df, used).collect()) == [1, 2]
    assert sorted(r[0] for r in sampling.remaining_rows(df, used, False).collect()) == [1, 1, 2]


def test_samples_bounded(spark):
    df = spark.range(0, 10000)
    n = sampling.bernoulli_sample(df, 0.1, 42).count()
    assert 850 < n < 1150
    a, b = sampling.random_split(df, (0.7, 0.3), 42)
    assert a.count() + b.count() == 10000


def test_header_driven_reader_and_convert(spark, scratch, flights_csv):
    full = src.read_flights(spark, flights_csv)
    assert full.columns == list(src.FLIGHT_COLUMNS)
    out = os.path.join(scratch, "stripped")
    back = src.convert(spark, flights_csv, out)
    assert back.columns == [c for c in src.FLIGHT_COLUMNS if c not in src.LEAKAGE_COLUMNS]
    assert back.count() == full.count()
    assert back.exceptAll(full.drop(*src.LEAKAGE_COLUMNS)).count() == 0
    # a file whose header lists the columns in another order reads by name
    path = os.path.join(scratch, "reordered.csv")
    with open(path, "w") as fh:
        fh.write("b,a\n2,1\n4,3\n")
    got = src.read_flights(spark, path).select("a", "b").collect()
    assert [tuple(r) for r in got] == [("1", "2"), ("3", "4")]


def test_value_count_empty(spark):
    df = spark.createDataFrame([], "a string")
    assert explore.value_count(df, "a").first()[0] == 0


def test_exact_quantiles_without_exchange_reuse(spark):
    """Partition numbering must not depend on Spark reusing the range exchange."""
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.random() * 1000) for _ in range(5000)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r["g"]: r["m"] for r in explore.exact_quantiles(
            df, "x", [0.5], by="g", names=["m"], num_partitions=12).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
    for g in "ab":
        assert math.isclose(got[g], _np_quantile([x for gg, x in rows if gg == g], 0.5),
                            abs_tol=1e-9)


def test_box_stats_approx_close_to_exact(spark):
    rng = random.Random(11)
    rows = [(rng.choice("ab"), rng.gauss(0, 10)) for _ in range(20000)]
    df = spark.createDataFrame(rows, "g string, x double")
    exact = {r["g"]: r for r in explore.box_stats(df, "x", by="g").collect()}
    approx = {r["g"]: r for r in explore.box_stats(df, "x", by="g", exact=False).collect()}
    for g in "ab":
        assert approx[g]["n"] == exact[g]["n"]
        for k in ("q1", "median", "q3"):
            assert abs(approx[g][k] - exact[g][k]) < 0.05, (g, k)


@pytest.mark.parametrize("seed", [3, 4])
def test_value_count_equals_distinct_count(spark, seed):
    rng = random.Random(seed)
    vals = [rng.choice(["a", "b", "c", None, "d"]) for _ in range(rng.randint(1, 300))]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert explore.value_count(df, "v").first()[0] == df.select("v").distinct().count()


def test_reader_checks_headers(spark, scratch):
    path = os.path.join(scratch, "other_header.csv")
    with open(path, "w") as fh:
        fh.write("x,y\n1,2\n")
    with pytest.raises(Exception):
        src.read_flights(spark, path, columns=("a", "b")).collect()


def test_small_chunks_are_exact_shares_and_empty_ones_an_error(spark):
    keys = spark.range(0, 2_000_000).withColumnRenamed("id", "k")
    n = sampling.disjoint_chunks(keys, ["k"], n=6, fraction=1.4e-5).count()
    assert 100 < n < 240  # 6 x 28 expected
    with pytest.raises(ValueError):
        sampling.disjoint_chunks(keys, ["k"], n=1, fraction=1e-19)


def test_boxcox_finds_a_far_lambda_and_rejects_what_has_none(spark):
    # y = (x^5 - 1) / 5 is normal: the likelihood peaks near 5
    import numpy as np

    rng = np.random.default_rng(1)
    x = (1 + 5 * rng.normal(50, 8, 4000)) ** (1 / 5)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert abs(transform.best_lambda(df, "x") - 5) < 1.5
    with pytest.raises(ValueError):
        transform.best_lambda(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x")
    mixed = spark.createDataFrame([(float(v),) for v in range(-2, 5)], "x double")
    with pytest.raises(ValueError):
        transform.boxcox(mixed, "x", "y")
    assert transform.boxcox(mixed, "x", "y", shift=None).where("y is null").count() == 0


@pytest.mark.parametrize("exact", [True, False])
def test_null_group_and_nan_rows_in_box_stats(spark, exact):
    nan = float("nan")
    df = spark.createDataFrame(
        [("a", float(i)) for i in range(1, 6)] + [("b", 1.0), ("b", nan), ("b", 3.0), ("b", None)]
        + [(None, float(i)) for i in range(3)], "g string, x double")
    got = {r["g"]: r for r in explore.box_stats(df, "x", by="g", exact=exact).collect()}
    assert set(got) == {"a", "b", None}
    assert (got["b"]["n"], got["b"]["max"], got["b"]["n_outliers"]) == (2, 3.0, 0)
    assert got[None]["n"] == 3 and got["a"]["median"] == 3.0


def test_except_all_splits_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPY_BLOCK", 100)
    df = spark.range(5000).selectExpr("if(id < 4000, null, id) AS k")
    used = spark.range(1234).selectExpr("cast(null AS bigint) AS k")
    out = sampling.remaining_rows(df, used, distinct=False)
    assert out.where("k is null").count() == 4000 - 1234 and out.count() == 5000 - 1234


def test_correlation_matrix_is_one_scan(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 1.0, 5.0), (3.0, 7.0, 2.0)],
                               "a double, b double, c double")
    out = explore.correlation_matrix(df, ["a", "b", "c"])
    assert out.count() == 9
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_unions_do_not_hide_a_missing_column(spark):
    from delaylab.sources.flights import union_by_name

    a, b = spark.range(1), spark.range(1).selectExpr("id", "id AS other")
    with pytest.raises(Exception):
        union_by_name([b, a]).collect()
    assert union_by_name([b, a], allow_missing=True).count() == 2
