"""Exploration aggregates: frequencies, top-k, daily means, summary statistics, exact
quantiles and box-plot statistics, correlations, histograms.

Every operator returns a DataFrame whose size is bounded by the number of groups (or is a
single row); none brings a column to the driver. Aggregates are algebraic or partially
aggregatable, so hot keys collapse map-side before the shuffle.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._util import as_list
from ._plan import attach_small, materialize, null_safe_join


def value_count(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values of ``col``, NULL counted as one value (one row: ``n_values``).

    Same result as ``select(col).distinct().count()``; written as one aggregate so Spark
    plans a partial distinct aggregation instead of materializing the distinct set.
    """
    c = F.col(col)
    return df.agg((F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0)))
                  .alias("n_values"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def frequency(df: DataFrame, *keys, name: str = "n") -> DataFrame:
    """Rows per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_daily_count(df: DataFrame, day_keys, key: str, name: str = "mean_daily_count"
                     ) -> DataFrame:
    """Mean over days of the rows per (day, key), per key: two partial aggregations."""
    per_day = frequency(df, *day_keys, key, name="n")
    return per_day.groupBy(key).agg(F.avg("n").alias(name), F.count(F.lit(1)).alias("n_days"))


def exact_mean(measure: str, decimals: int | None = None):
    """Mean aggregate. With ``decimals`` (for values with that many decimal places, such as
    prices or minutes) the sum is exact in DECIMAL and converted to DOUBLE once, so the result
    is bit-identical whatever the partitioning or summation order."""
    if decimals is None:
        return F.avg(measure)
    dec = F.col(measure).cast(f"decimal(18,{decimals})")
    return F.sum(dec).cast("double") / F.count(dec)


def daily_mean(df: DataFrame, date: str, measure: str, name: str | None = None,
               decimals: int | None = None) -> DataFrame:
    """Mean of ``measure`` per ``date``, in date order (``decimals``: see ``exact_mean``)."""
    return (df.groupBy(date).agg(exact_mean(measure, decimals).alias(name or f"avg_{measure}"))
            .orderBy(date))


def top_k(df: DataFrame, key: str, k: int = 20, name: str = "n") -> DataFrame:
    """The ``k`` most frequent keys; ties broken by key so the answer is deterministic."""
    return frequency(df, key, name=name).orderBy(F.desc(name), F.asc(key)).limit(k)


def describe_long(df: DataFrame, cols) -> DataFrame:
    """count, mean, stddev (sample), min, max of each column, one row per column
    (``column``, ``n``, ``mean``, ``stddev``, ``min``, ``max``), typed as numbers.
    One aggregate for all columns, then a ``stack`` of the single result row."""
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"sd{i}"), F.min(x).alias(f"min{i}"),
                 F.max(x).alias(f"max{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"),
                              F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("stddev"),
                              F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
                     for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def _quantile_names(probs) -> list[str]:
    return [f"q{int(round(p * 1000)):04d}" for p in probs]


def _present(v):
    """Neither NULL nor NaN: the one rule for missing values of quantiles and box statistics."""
    return v.isNotNull() & ~F.isnan(v.cast("double"))


def exact_quantiles(df: DataFrame, col: str, probs, by=None, names=None,
                    num_partitions: int | None = None, with_moments: bool = False) -> DataFrame:
    """Exact quantiles with linear interpolation (``percentile`` / ``quantile_cont``) per group.

    Distributed plan, no group or column ever held by one task:

    1. count rows per distinct (group, value), partially aggregated, so a hot value is one row;
    2. range-partition that table by (group, value), materialize it, number the partitions;
    3. per-partition totals (at most partitions + groups rows) give each partition's offset;
    4. running sums inside each partition give every distinct value its rank interval;
    5. one aggregate picks, per group, the values at ranks ``floor`` / ``ceil`` of ``(n-1)p``.

    Returns (``by``..., ``n``, one column per probability, named ``names`` or ``q0250``...).
    """
    by = as_list(by)
    probs = list(probs)
    names = list(names) if names else _quantile_names(probs)
    spark = df.sparkSession
    # the distinct-value table can approach the row count for continuous columns: give it at
    # least two range partitions per core of the cluster
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        cores = 0
    parts = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                  2 * cores)
    v = F.col(col)
    counts = df.where(_present(v)).groupBy(*by, col).agg(
        F.count(F.lit(1)).alias("_c"))
    # Materialized once: partition ids must be the same for the totals and the running sums,
    # and two evaluations of a range exchange may sample different bounds.
    ranged = materialize(counts.repartitionByRange(parts, *by, col)).withColumn(
        "_pid", F.spark_partition_id())
    totals = ranged.groupBy("_pid", *by).agg(F.sum("_c").alias("_t"))
    w_grp = Window.partitionBy(*by)
    offsets = totals.select(
        "_pid", *by,
        F.coalesce(F.sum("_t").over(w_grp.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_t").over(w_grp).alias("_n"))
    w_in = Window.partitionBy("_pid", *by).orderBy(col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = ranged.withColumn("_run", F.sum("_c").over(w_in))
    if not by:
        offsets = F.broadcast(offsets)  # at most `parts` rows
    ranked = null_safe_join(ranked, offsets, ["_pid", *by], "inner")
    after = F.col("_off") + F.col("_run")
    before = after - F.col("_c")
    aggs = [F.max("_n").alias("n")]
    for p, name in zip(probs, names):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.min(F.when((before <= lo) & (lo < after), v)).alias(f"{name}__lo"),
                 F.min(F.when((before <= hi) & (hi < after), v)).alias(f"{name}__hi"),
                 F.max(pos).alias(f"{name}__pos")]
    if with_moments:
        aggs += [(F.sum(v * F.col("_c")) / F.sum("_c")).alias("mean"), F.min(v).alias("min"),
                 F.max(v).alias("max")]
    picked = ranked.groupBy(*by).agg(*aggs)
    out = [*by, "n", *(["mean", "min", "max"] if with_moments else [])]
    for name in names:
        lo_v, hi_v, pos = F.col(f"{name}__lo"), F.col(f"{name}__hi"), F.col(f"{name}__pos")
        frac = pos - F.floor(pos)
        out.append(F.when(frac == 0, lo_v.cast("double"))
                   .otherwise(lo_v + (hi_v - lo_v) * frac).alias(name))
    return picked.select(*out)


def location_stats(df: DataFrame, col: str) -> DataFrame:
    """Mean, exact median and minimum of ``col`` (one row: ``n``, ``mean``, ``median``, ``min``)."""
    q = exact_quantiles(df, col, [0.5], names=["median"], with_moments=True)
    return q.select("n", "mean", "median", "min")


def approx_quantiles(df: DataFrame, col: str, probs, by=None, names=None,
                     accuracy: int = 10000) -> DataFrame:
    """Approximate quantiles from mergeable sketches (``percentile_approx``): one pass with
    partial aggregation; rank error at most ``1/accuracy`` of the group size."""
    by = as_list(by)
    probs = list(probs)
    names = list(names) if names else _quantile_names(probs)
    x = F.col(col).cast("double")
    q = F.percentile_approx(x, probs, accuracy)
    out = df.where(_present(F.col(col))).groupBy(*by).agg(F.count(x).alias("n"), q.alias("_q"))
    return out.select(*by, "n", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def box_stats(df: DataFrame, col: str, by=None, whisker: float = 1.5, exact: bool = True
              ) -> DataFrame:
    """Box-plot statistics per group: quartiles, IQR fences, whiskers (extreme values inside the
    fences), outlier count, min and max.

    The quartiles come from ``exact_quantiles`` (or sketches with ``exact=False``); the
    per-group table (one row per group) is joined back by a measured broadcast for the second
    pass. NULL and NaN values are left out of every statistic; NULL is a group like any other.
    """
    by = as_list(by)
    df = df.where(_present(F.col(col)))
    quantiles = exact_quantiles if exact else approx_quantiles
    q = quantiles(df, col, [0.25, 0.5, 0.75], by, names=["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    q = q.select(*by, "n", "q1", "median", "q3", iqr.alias("iqr"),
                 (F.col("q1") - whisker * iqr).alias("lower_fence"),
                 (F.col("q3") + whisker * iqr).alias("upper_fence"))
    v = F.col(col)
    if by:
        joined = attach_small(df.select(*by, col), q, by, "inner")
    else:
        row = q.first()  # one row of six numbers: the fences become literals
        if row is None:
            return q
        joined = df.select(col).withColumns(
            {k: F.lit(row[k]).cast(q.schema[k].dataType) for k in q.columns})
    stats = joined.groupBy(*by).agg(
        F.first("n").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"), F.first("iqr").alias("iqr"),
        F.first("lower_fence").alias("lower_fence"), F.first("upper_fence").alias("upper_fence"),
        F.min(F.when(v >= F.col("lower_fence"), v)).alias("whisker_low"),
        F.max(F.when(v <= F.col("upper_fence"), v)).alias("whisker_high"),
        F.count_if((v < F.col("lower_fence")) | (v > F.col("upper_fence"))).alias("n_outliers"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    return stats


def correlations(df: DataFrame, pairs) -> DataFrame:
    """Pearson correlation of each (x, y) pair, all in one aggregate: (``x``, ``y``, ``corr``)."""
    pairs = list(pairs)
    wide = df.agg(*[F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"c{i}")
                    for i, (x, y) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"),
                              F.col(f"c{i}").alias("corr")) for i, (x, y) in enumerate(pairs)])
    return wide.select(F.inline(rows))


def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """All pairwise correlations of ``cols`` in long form, both orders and the diagonal, from one
    aggregate."""
    pairs = list(combinations_with_replacement(list(cols), 2))
    wide = df.agg(*[F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"c{i}")
                    for i, (x, y) in enumerate(pairs)])
    entries = [(x, y, i) for i, (x, y) in enumerate(pairs)]
    entries += [(y, x, i) for x, y, i in entries if x != y]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"c{i}").alias("corr"))
        for x, y, i in entries])))


def correlation_gram(df: DataFrame, cols) -> DataFrame:
    """Correlations of many columns over the rows that have all of them, in the form of
    ``correlation_matrix``: one mergeable matrix aggregate over assembled vectors in place of a
    ``corr`` per pair. Columns are first moved by their means, so that large values do not cancel;
    a constant column has NaN beside others and 1 on the diagonal. Only the matrix (the square of
    the number of columns) reaches the driver."""
    cols = list(cols)
    x = [F.col(c).cast("double") for c in cols]
    present = F.lit(True)
    for c in x:
        present = present & c.isNotNull()
    full = df.where(present).select(*[c.alias(f"_{i}") for i, c in enumerate(x)])
    means = full.agg(*[F.avg(f"_{i}") for i in range(len(cols))]).first()
    if not cols or means[0] is None:
        return df.sparkSession.createDataFrame([], "x string, y string, corr double")
    moved = full.select(*[(F.col(f"_{i}") - F.lit(m)).alias(f"_{i}")
                          for i, m in enumerate(means)])
    vectors = VectorAssembler(inputCols=moved.columns, outputCol="v").transform(moved)
    matrix = Correlation.corr(vectors, "v", "pearson").first()[0].toArray()
    rows = [(a, b, float(matrix[i][j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "x string, y string, corr double")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram over [min, max]: (``bin``, ``lo``, ``hi``, ``n``); the maximum
    falls into the last bin. The range is a one-row aggregate read back as two literals, then
    one grouped count (partial aggregation, at most ``bins`` groups)."""
    x = F.col(col).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / float(bins)
    if width == 0:
        b = F.lit(0)
    else:
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counted = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("bin", (F.lit(lo) + F.lit(width) * F.col("bin")).alias("lo"),
                          (F.lit(lo) + F.lit(width) * (F.col("bin") + 1)).alias("hi"), "n")


def group_mean_column(df: DataFrame, keys, measure: str, out: str) -> DataFrame:
    """Attach the per-group mean of ``measure`` to every row (measured broadcast of the groups)."""
    means = df.groupBy(*keys).agg(F.avg(measure).alias(out))
    return attach_small(df, means, keys, "left")
