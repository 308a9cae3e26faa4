"""A third of all rows on one key: results stay whole and equal to the plain window plan,
on the broadcast path and on the shuffle-join fallback."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaylab.operators import explore, windows
from delaylab.plans import inspect as plan


def _skewed(spark, n=30000):
    return spark.range(0, n).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("HUB")).otherwise(
            F.concat(F.lit("A"), (F.col("id") % 97).cast("string"))).alias("Origin"),
        (F.col("id") % 5).alias("day"))


def test_hot_key_broadcast_path(spark):
    df = _skewed(spark)
    out = windows.add_group_count(df, ["day", "Origin"], "Origin", "n")
    assert "BroadcastHashJoin" in plan.physical(out)
    ref = windows.add_group_count(df, ["day", "Origin"], "Origin", "n", method="window")
    assert out.count() == df.count()
    assert out.exceptAll(ref.select(*out.columns)).count() == 0
    hub = out.where("Origin = 'HUB'").agg(F.sum("n")).first()[0]
    assert hub == sum((10000 // 5) ** 2 for _ in range(5))


def test_hot_key_shuffle_fallback(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = _skewed(spark)
        out = windows.add_group_aggregates(df, ["day", "Origin"], {"n": F.count("Origin")},
                                           max_broadcast_bytes=0)
        out.write.format("noop").mode("overwrite").save()
        p = plan.physical(out)
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
        ref = windows.add_group_count(df, ["day", "Origin"], "Origin", "n", method="window")
        assert out.count() == df.count()
        assert out.exceptAll(ref.select(*out.columns)).count() == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_value_box_stats_by_group(spark):
    df = _skewed(spark).withColumn("x", F.when(F.col("Origin") == "HUB", F.lit(5.0))
                                   .otherwise(F.col("id").cast("double")))
    got = {r["day"]: r for r in explore.box_stats(df, "x", by="day").collect()}
    import numpy as np

    rows = df.select("day", "x").collect()
    for d in range(5):
        xs = np.array([r["x"] for r in rows if r["day"] == d])
        assert got[d]["n"] == len(xs)
        assert got[d]["median"] == float(np.quantile(xs, 0.5))
        assert got[d]["q3"] == float(np.quantile(xs, 0.75))
