"""Queries for windows, exploration aggregates and delay transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, explore, sketches, transform, windows
from ..operators.transform import default_lambdas
from ..session import scratch_path
from .common import r6, t
from .registry import register

# events.value shifted so that it has negatives, like an arrival delay in minutes.
DELAY_OFFSET = 250.0


def events_delay(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    return e.select("event_id", "ts", "user_id", "event_type",
                    (F.col("value") - F.lit(DELAY_OFFSET)).alias("delay"))


_EV_DELAY = (f"(SELECT event_id, ts, user_id, event_type, value - {DELAY_OFFSET} AS delay "
             "FROM events)")


@register("value_count", ("AGG1", "SET3"), oracle="""
SELECT CAST(count(DISTINCT x) + max(CASE WHEN x IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_values
FROM (SELECT nullif(event_type, 'error') AS x FROM events) e""")
def q_value_count(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))
    return explore.value_count(e, "event_type")


@register("row_count", "AGG2", oracle="SELECT count(*) AS n_rows FROM events")
def q_row_count(spark, sf_dir):
    return explore.row_count(t(spark, sf_dir, "events"))


@register("frequency", "AGG3", oracle="""
SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity""")
def q_frequency(spark, sf_dir):
    return explore.frequency(t(spark, sf_dir, "lineitem"), "l_quantity")


@register("frequency_excluding", ("AGG4", "FIL3"), oracle="""
SELECT l_quantity, count(*) AS n FROM lineitem
WHERE l_suppkey <> 7 AND l_partkey <> 7 GROUP BY l_quantity""")
def q_frequency_excluding(spark, sf_dir):
    li = clean.exclude_value(t(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey"], 7)
    return explore.frequency(li, "l_quantity")


@register("outlier_frequency", ("FIL2", "AGG3"), oracle="""
SELECT CAST(isodow(l_shipdate) AS INTEGER) AS DayOfWeek,
       CAST(month(l_shipdate) AS INTEGER) AS Month, count(*) AS n
FROM lineitem WHERE l_extendedprice > 90000 GROUP BY ALL""")
def q_outlier_frequency(spark, sf_dir):
    li = clean.outliers(t(spark, sf_dir, "lineitem"), "l_extendedprice", 90000)
    li = li.select((F.weekday("l_shipdate") + 1).alias("DayOfWeek"),
                   F.month("l_shipdate").alias("Month"))
    return explore.frequency(li, "DayOfWeek", "Month")


@register("daily_counts", "AGG5", oracle="""
SELECT CAST(year(ts) AS INTEGER) AS Year, CAST(month(ts) AS INTEGER) AS Month,
       CAST(day(ts) AS INTEGER) AS DayofMonth, user_id, count(*) AS n
FROM events GROUP BY ALL""")
def q_daily_counts(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(
        F.year("ts").alias("Year"), F.month("ts").alias("Month"),
        F.dayofmonth("ts").alias("DayofMonth"), "user_id")
    return explore.frequency(e, "Year", "Month", "DayofMonth", "user_id")


@register("mean_daily_count", "AGG6", oracle="""
SELECT user_id, round(avg(n), 6) AS mean_daily_count, count(*) AS n_days
FROM (SELECT year(ts) y, month(ts) m, day(ts) d, user_id, count(*) AS n
      FROM events GROUP BY ALL) g
GROUP BY user_id""")
def q_mean_daily_count(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(
        F.year("ts").alias("Year"), F.month("ts").alias("Month"),
        F.dayofmonth("ts").alias("DayofMonth"), "user_id")
    out = explore.mean_daily_count(e, ["Year", "Month", "DayofMonth"], "user_id")
    return out.select("user_id", F.round("mean_daily_count", 6).alias("mean_daily_count"),
                      "n_days")


@register("daily_mean", ("AGG7", "SRT2"), oracle="""
SELECT CAST(o_orderdate AS DATE) AS Date,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(o_totalprice)
         AS avg_o_totalprice
FROM orders GROUP BY 1 ORDER BY 1""")
def q_daily_mean(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("Date"),
                                          "o_totalprice")
    return explore.daily_mean(o, "Date", "o_totalprice", decimals=2)


@register("location_stats", "AGG8", oracle="""
SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS median, min(l_extendedprice) AS min
FROM lineitem""")
def q_location_stats(spark, sf_dir):
    s = explore.location_stats(t(spark, sf_dir, "lineitem"), "l_extendedprice")
    return s.select("n", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"),
                    "min")


_DESC_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@register("describe_long", "AGG9", oracle=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
       CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in _DESC_COLS))
def q_describe_long(spark, sf_dir):
    d = explore.describe_long(t(spark, sf_dir, "lineitem"), _DESC_COLS)
    return d.select("column", "n", F.round("mean", 6).alias("mean"),
                    F.round("stddev", 6).alias("stddev"), "min", "max")


def _box_sql(x: str, src: str, by: str | None) -> str:
    sel = f"src.{by} AS {by}, " if by else ""
    qg = f"{by}, " if by else ""
    grp_q = f"GROUP BY {by}" if by else ""
    on = f"src.{by} = f.{by}" if by else "TRUE"
    grp = f"src.{by}, " if by else ""
    return f"""
WITH src AS ({src}),
q AS (SELECT {qg}count({x}) AS n, quantile_cont({x}, 0.25) AS q1,
             quantile_cont({x}, 0.5) AS median, quantile_cont({x}, 0.75) AS q3
      FROM src {grp_q}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence,
             q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT {sel}f.n AS n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, round(lower_fence, 6) AS lower_fence,
       round(upper_fence, 6) AS upper_fence,
       round(min(CASE WHEN {x} >= lower_fence THEN {x} END), 6) AS whisker_low,
       round(max(CASE WHEN {x} <= upper_fence THEN {x} END), 6) AS whisker_high,
       count(*) FILTER (WHERE {x} < lower_fence OR {x} > upper_fence) AS n_outliers,
       round(min({x}), 6) AS min, round(max({x}), 6) AS max
FROM src JOIN f ON {on}
GROUP BY {grp}f.n, q1, median, q3, iqr, lower_fence, upper_fence"""


def _round_box(df, by=()):
    cols = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_low",
            "whisker_high", "min", "max"]
    return df.select(*by, "n", *[F.round(c, 6).alias(c) for c in cols], "n_outliers")


@register("box_stats", "AGG10", oracle=_box_sql("value", "SELECT value FROM events", None))
def q_box_stats(spark, sf_dir):
    return _round_box(explore.box_stats(t(spark, sf_dir, "events"), "value"))


_SHIFTED = f"""SELECT event_id, CAST(isodow(ts) AS INTEGER) AS DayOfWeek,
  ln(delay + 1 + abs((SELECT min(delay) FROM {_EV_DELAY} m))) AS delay_trans
FROM {_EV_DELAY} e"""


@register("box_stats_by", ("AGG11", "SCA8"), oracle=_box_sql("delay_trans", _SHIFTED, "DayOfWeek"))
def q_box_stats_by(spark, sf_dir):
    e = events_delay(spark, sf_dir).withColumn("DayOfWeek", F.weekday("ts") + 1)
    e = transform.shifted_log(e, "delay", "delay_trans")
    return _round_box(explore.box_stats(e, "delay_trans", by="DayOfWeek"), ["DayOfWeek"])


_PAIRS = (("l_quantity", "l_extendedprice"), ("l_discount", "l_extendedprice"),
          ("l_tax", "l_extendedprice"), ("l_quantity", "l_discount"))


@register("correlations", "AGG12", oracle=" UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) + 0.0 AS corr FROM lineitem"
    for x, y in _PAIRS))
def q_correlations(spark, sf_dir):
    c = explore.correlations(t(spark, sf_dir, "lineitem"), _PAIRS)
    return c.select("x", "y", r6("corr").alias("corr"))


_MATRIX_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("correlation_matrix", "AGG13", oracle=" UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) + 0.0 AS corr FROM lineitem"
    for x in _MATRIX_COLS for y in _MATRIX_COLS))
def q_correlation_matrix(spark, sf_dir):
    c = explore.correlation_matrix(t(spark, sf_dir, "lineitem"), _MATRIX_COLS)
    return c.select("x", "y", r6("corr").alias("corr"))


_WIDE = {f"c{k}": f"l_quantity * {(k * 7) % 11 + 1} + l_discount * {(k * 13) % 17} "
                  f"+ CAST((l_partkey * {k + 3}) % {k + 20} AS DOUBLE)" for k in range(40)}


@register("correlation_gram", ("AGG12", "AGG13"), oracle=f"""
WITH w AS (SELECT {", ".join(f"{e} AS {c}" for c, e in _WIDE.items())} FROM lineitem),
m AS (SELECT {", ".join(f"corr({a}, {b}) AS {a}_{b}" for a in _WIDE for b in _WIDE if a <= b)}
      FROM w),
u AS (UNPIVOT m ON COLUMNS(*) INTO NAME pair VALUE v),
r AS (SELECT split_part(pair, '_', 1) AS a, split_part(pair, '_', 2) AS b, round(v, 6) + 0.0 AS v
      FROM u)
SELECT a AS x, b AS y, v AS corr FROM r UNION ALL SELECT b, a, v FROM r WHERE a <> b""")
def q_correlation_gram(spark, sf_dir):
    """All correlations of forty columns from one matrix aggregate."""
    wide = t(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(c) for c, e in _WIDE.items()])
    return explore.correlation_gram(wide, list(_WIDE)).select(
        "x", "y", (F.round("corr", 6) + F.lit(0.0)).alias("corr"))


_SKETCHED = ("o_custkey", "o_orderkey", "o_orderpriority")


@register("distinct_sketches", ("AGG1", "FEA4"), oracle="""
SELECT c.x AS "column", count(*) AS rows, true AS within_bound
FROM orders, (VALUES ('o_custkey'), ('o_orderkey'), ('o_orderpriority')) c(x) GROUP BY c.x""")
def q_distinct_sketches(spark, sf_dir):
    """Distinct counts over all years from the stored sketches of each year, the last year added
    later; held to five standard errors of the exact counts."""
    o = t(spark, sf_dir, "orders").withColumn("Year", F.year("o_orderdate").cast("string"))
    path = scratch_path(spark, "sketches")
    last = o.agg(F.max("Year")).first()[0] or ""
    sketches.store_sketches(o.where(F.col("Year") < last), path, _SKETCHED)
    sketches.store_sketches(o.where(F.col("Year") >= last), path, _SKETCHED)
    exact = o.agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in _SKETCHED])))
    found = sketches.stored_distinct(spark, path).join(F.broadcast(exact), "column")
    return found.select("column", "rows", (F.abs(F.col("n_distinct") - F.col("exact")) <= F.lit(
        5 * sketches.standard_error()) * F.col("exact") + 0.5).alias("within_bound"))


@register("histogram", "AGG13", oracle="""
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 10.0)) AS INTEGER), 9) AS bin,
             lo, hi FROM lineitem, r WHERE l_extendedprice IS NOT NULL)
SELECT bin, round(min(lo) + ((min(hi) - min(lo)) / 10.0) * bin, 6) AS lo,
       round(min(lo) + ((min(hi) - min(lo)) / 10.0) * (bin + 1), 6) AS hi, count(*) AS n
FROM b GROUP BY bin""")
def q_histogram(spark, sf_dir):
    h = explore.histogram(t(spark, sf_dir, "lineitem"), "l_extendedprice", 10)
    return h.select("bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n")


@register("top_k", "SRT1", oracle="""
SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20""")
def q_top_k(spark, sf_dir):
    return explore.top_k(t(spark, sf_dir, "events"), "user_id", 20)


@register("top_k_outliers", ("SRT1", "FIL2"), oracle="""
SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_extendedprice > 90000
GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 20""")
def q_top_k_outliers(spark, sf_dir):
    li = clean.outliers(t(spark, sf_dir, "lineitem"), "l_extendedprice", 90000)
    return explore.top_k(li, "l_suppkey", 20)


@register("preview", ("PRJ4", "SRT3", "SNK5", "SNK6"), oracle="""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10""")
def q_preview(spark, sf_dir):
    from ..sources.sinks import preview

    return preview(t(spark, sf_dir, "orders"), ["o_orderkey", "o_orderdate", "o_totalprice"],
                   10, order_by="o_orderkey")


def _ship_flights(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    d = F.to_date("l_shipdate")
    return li.select(
        "l_orderkey", "l_linenumber", F.year(d).alias("Year"), F.month(d).alias("Month"),
        F.dayofmonth(d).alias("DayofMonth"), F.col("l_suppkey").alias("Origin"),
        (F.col("l_partkey") % 25).alias("Dest"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("CancellationCode"))


_SHIP_SQL = """(SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS Year,
  CAST(month(l_shipdate) AS INTEGER) AS Month, CAST(day(l_shipdate) AS INTEGER) AS DayofMonth,
  l_suppkey AS Origin,
  l_partkey % 25 AS Dest, nullif(l_returnflag, 'N') AS CancellationCode FROM lineitem)"""


@register("departures_window", "WIN1", oracle=f"""
SELECT l_orderkey, l_linenumber, Year, Month, DayofMonth, Origin,
       count(Origin) OVER (PARTITION BY Year, Month, DayofMonth, Origin) AS NrOfDepartures
FROM {_SHIP_SQL} s""")
def q_departures_window(spark, sf_dir):
    f = _ship_flights(spark, sf_dir).drop("Dest", "CancellationCode")
    return windows.add_group_count(f, windows.DAY_KEYS + ("Origin",), "Origin", "NrOfDepartures")


@register("arrivals_window", "WIN2", oracle=f"""
SELECT l_orderkey, l_linenumber, Year, Month, DayofMonth, Dest,
       count(Dest) OVER (PARTITION BY Year, Month, DayofMonth, Dest) AS NrOfArrivals
FROM {_SHIP_SQL} s""")
def q_arrivals_window(spark, sf_dir):
    f = _ship_flights(spark, sf_dir).drop("Origin", "CancellationCode")
    return windows.add_group_count(f, windows.DAY_KEYS + ("Dest",), "Dest", "NrOfArrivals")


@register("departures_window_plain", "WIN1", oracle=f"""
SELECT l_orderkey, l_linenumber, Year, Month, DayofMonth, Origin,
       count(Origin) OVER (PARTITION BY Year, Month, DayofMonth, Origin) AS NrOfDepartures
FROM {_SHIP_SQL} s""")
def q_departures_window_plain(spark, sf_dir):
    """The same counts by the path for per-key tables too large to broadcast."""
    f = _ship_flights(spark, sf_dir).drop("Dest", "CancellationCode")
    return windows.add_group_count(f, windows.DAY_KEYS + ("Origin",), "Origin", "NrOfDepartures",
                                   max_broadcast_bytes=0)


_CODES = {"A": "n_code_A", "R": "n_code_R", "C": "n_code_C"}


@register("reason_counts", ("WIN3",), oracle=f"""
SELECT l_orderkey, l_linenumber, Year, Month, DayofMonth, Origin, CancellationCode,
       {", ".join(f"count(*) FILTER (WHERE CancellationCode = '{c}') OVER "
                  f"(PARTITION BY Year, Month, DayofMonth, Origin) AS {n}"
                  for c, n in _CODES.items())}
FROM {_SHIP_SQL} s""")
def q_reason_counts(spark, sf_dir):
    f = _ship_flights(spark, sf_dir).drop("Dest")
    return windows.add_cancellation_counts(f, windows.DAY_KEYS + ("Origin",), codes=_CODES)


@register("reason_counts_nonnull", ("WIN3", "H9"), oracle=f"""
SELECT l_orderkey, l_linenumber, Year, Month, DayofMonth, Origin, CancellationCode,
       {", ".join(f"count(CancellationCode = '{c}') OVER "
                  f"(PARTITION BY Year, Month, DayofMonth, Origin, CancellationCode) AS {n}"
                  for c, n in _CODES.items())}
FROM {_SHIP_SQL} s""")
def q_reason_counts_nonnull(spark, sf_dir):
    f = _ship_flights(spark, sf_dir).drop("Dest")
    return windows.add_cancellation_counts(f, windows.DAY_KEYS + ("Origin",), codes=_CODES,
                                           count_nonnull=True)


@register("log_transform", "SCA7", oracle=f"""
SELECT event_id, CASE WHEN delay > 0 THEN round(ln(delay), 6) END AS delay_log
FROM {_EV_DELAY} e""")
def q_log_transform(spark, sf_dir):
    from ..functions.transforms import log_transform

    e = events_delay(spark, sf_dir)
    return e.select("event_id", F.round(log_transform("delay"), 6).alias("delay_log"))


@register("shifted_log", "SCA8", oracle=f"""
SELECT event_id, round(ln(delay + 1 + abs((SELECT min(delay) FROM {_EV_DELAY} m))), 6)
  AS delay_trans
FROM {_EV_DELAY} e""")
def q_shifted_log(spark, sf_dir):
    e = transform.shifted_log(events_delay(spark, sf_dir), "delay", "delay_trans")
    return e.select("event_id", F.round("delay_trans", 6).alias("delay_trans"))


def _lambda_values() -> str:
    return ", ".join(f"({lam!r})" for lam in default_lambdas())


def _bc_sql(x: str, lam: str) -> str:
    return f"CASE WHEN abs({lam}) < 1e-12 THEN ln({x}) ELSE (pow({x}, {lam}) - 1) / {lam} END"


_PROFILE_SQL = f"""
WITH s AS (SELECT 1 + abs(min(delay)) AS shift FROM {_EV_DELAY} m),
x AS (SELECT delay + shift AS x FROM {_EV_DELAY} e, s WHERE delay + shift > 0),
lams(lam) AS (VALUES {_lambda_values()}),
agg AS (SELECT lam, count(*) AS n, sum(ln(x)) AS sl, var_pop({_bc_sql('x', 'lam')}) AS v
        FROM x, lams GROUP BY lam)
SELECT CAST(lam AS DOUBLE) AS "lambda", (lam - 1) * sl - n / 2.0 * ln(v) AS llf FROM agg"""


@register("boxcox_profile", "SCA9", oracle=f"""
SELECT "lambda", round(llf, 3) AS llf FROM ({_PROFILE_SQL}) p""")
def q_boxcox_profile(spark, sf_dir):
    e = events_delay(spark, sf_dir)
    shift = transform.shift_for(e, "delay")
    p = transform.boxcox_profile(e, "delay", default_lambdas(), shift)
    return p.select("lambda", F.round("llf", 3).alias("llf"))


@register("boxcox", "SCA9", oracle=f"""
WITH p AS ({_PROFILE_SQL}),
best AS (SELECT "lambda" AS lam FROM p ORDER BY llf DESC, "lambda" ASC LIMIT 1),
s AS (SELECT 1 + abs(min(delay)) AS shift FROM {_EV_DELAY} m)
SELECT event_id, round({_bc_sql("(delay + shift)", "lam")}, 6) AS delay_boxcox
FROM {_EV_DELAY} e, s, best""")
def q_boxcox(spark, sf_dir):
    e = events_delay(spark, sf_dir)
    out = transform.boxcox(e, "delay", "delay_boxcox", shift=None, refine=False)
    return out.select("event_id", F.round("delay_boxcox", 6).alias("delay_boxcox"))
