"""Queries for set operations, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling
from ..session import scratch_path
from ..sources.flights import read_years, union_by_name
from ..sources.sinks import write_csv
from . import duck
from .common import t
from .registry import register

_U = duck.hash_unit(["o_orderkey"], 42)
_70 = sampling.hash_bound(0.7)
_05 = sampling.hash_bound(0.05)


@register("read_years", ("SRC3",), oracle="""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS Year, o_totalprice FROM orders""")
def q_read_years(spark, sf_dir):
    """Three files of orders by year, read as one table."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("Year"),
                                          "o_totalprice")
    paths = []
    for low, high in ((0, 1997), (1997, 1999), (1999, 9999)):
        paths.append(scratch_path(spark, f"orders-{low}"))
        write_csv(o.where((F.col("Year") >= low) & (F.col("Year") < high)), paths[-1])
    return read_years(spark, paths).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("Year").cast("int"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"))


@register("union_years", ("SET1",), oracle="""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS Year, o_totalprice FROM orders""")
def q_union_years(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("Year"),
                                          "o_totalprice")
    slices = [o.where(F.col("Year") < 1997),
              o.where((F.col("Year") >= 1997) & (F.col("Year") < 1999)),
              o.where(F.col("Year") >= 1999)]
    return union_by_name(slices)


@register("remaining_rows", ("SET2", "JOI1"), oracle=f"""
SELECT o_custkey, o_orderpriority FROM orders
EXCEPT
SELECT o_custkey, o_orderpriority FROM orders WHERE {_U} >= {_70}""")
def q_remaining_rows(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    used = sampling.hash_split(o, ["o_orderkey"], (0.7, 0.3), 42).where(F.col("split") == 1)
    return sampling.remaining_rows(o.select("o_custkey", "o_orderpriority"),
                                   used.select("o_custkey", "o_orderpriority"), distinct=True)


@register("remaining_rows_all", ("SET2",), oracle=f"""
SELECT o_custkey, o_orderpriority FROM orders
EXCEPT ALL
SELECT o_custkey, o_orderpriority FROM orders WHERE {_U} >= {_70}""")
def q_remaining_rows_all(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    used = sampling.hash_split(o, ["o_orderkey"], (0.7, 0.3), 42).where(F.col("split") == 1)
    return sampling.remaining_rows(o.select("o_custkey", "o_orderpriority"),
                                   used.select("o_custkey", "o_orderpriority"), distinct=False)


@register("hash_split", "SAM3", oracle=f"""
SELECT o_orderkey, CASE WHEN {_U} < {_70} THEN 0 ELSE 1 END AS split FROM orders""")
def q_hash_split(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey")
    return sampling.hash_split(o, ["o_orderkey"], (0.7, 0.3), 42)


@register("disjoint_chunks", ("SAM4", "SAM5"), oracle=f"""
SELECT o_orderkey, CAST({_U} // {_05} AS INTEGER) AS chunk,
       CASE WHEN {_U} // {_05} < 5 THEN 'train' ELSE 'test' END AS role
FROM orders WHERE {_U} < {6 * _05}""")
def q_disjoint_chunks(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey")
    c = sampling.disjoint_chunks(o, ["o_orderkey"], n=6, fraction=0.05, seed=42)
    train, test = sampling.train_test_chunks(c, 5)
    return (train.withColumn("role", F.lit("train"))
            .unionByName(test.withColumn("role", F.lit("test"))))


_10 = sampling.hash_bound(0.1)


@register("bernoulli_sample", "SAM1", oracle=f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {_U} < {_10}""")
def q_bernoulli_sample(spark, sf_dir):
    """A tenth of the orders, drawn by key: the twin draws the same rows."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.bernoulli_sample(o, 0.1, seed=42, keys=["o_orderkey"])


@register("bernoulli_sample_layout", "SAM1", oracle="""
SELECT 0 AS not_in_table, true AS near_share, true AS without_replacement""")
def q_bernoulli_sample_layout(spark, sf_dir):
    """The sample without keys depends on the scan's layout; what must hold of any: every row is a
    row of the table, none twice, and their number is within six standard deviations."""
    o = t(spark, sf_dir, "orders")
    s = sampling.bernoulli_sample(o, 0.1, seed=42)
    back = s.join(o.select(F.col("o_orderkey").alias("k")), F.col("o_orderkey") == F.col("k"),
                  "left")
    n = o.count()
    return back.agg(
        F.count_if(F.col("k").isNull()).cast("int").alias("not_in_table"),
        (F.abs(F.count(F.lit(1)) - 0.1 * n) <= 6 * (0.09 * n) ** 0.5).alias("near_share"),
        (F.count(F.lit(1)) == F.count_distinct("o_orderkey")).alias("without_replacement"))


@register("random_split", "SAM2", oracle=f"""
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN {_U} < {_70} THEN 'train' ELSE 'test' END
         AS part FROM orders""")
def q_random_split(spark, sf_dir):
    """Both parts of a split by key, each row with its part."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    train, test = sampling.random_split(o, (0.7, 0.3), seed=42, keys=["o_orderkey"])
    return (train.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test"))))


@register("random_split_layout", "SAM2", oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       true AS near_share FROM orders""")
def q_random_split_layout(spark, sf_dir):
    """Both parts of Spark's split together are the table, each row once, and the first has its
    share within six standard deviations."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                          "o_totalprice", "o_orderpriority")
    train, test = sampling.random_split(o, (0.7, 0.3), seed=42)
    n, part = o.count(), train.count()
    return train.unionByName(test).withColumn(
        "near_share", F.lit(abs(part - 0.7 * n) <= 6 * (0.21 * n) ** 0.5))
