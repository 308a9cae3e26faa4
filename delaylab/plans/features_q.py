"""Queries for cleaning, encodings, holidays and the flagship daily feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import encode, holidays
from ..functions.encode import (DAY_OF_MONTH_PERIOD, DAY_OF_WEEK_PERIOD, MONTH_PERIOD,
                                cyclic_sin, flight_date, iso_weekday)
from ..operators import clean
from . import duck
from .common import ORDERS_AS_STRINGS_SQL, orders_as_flights, orders_as_strings, r6, t
from .registry import register

_HD = duck.holiday_distance("Date")


def daily_features(flights, date_col="Date", airport="o_orderpriority", delay="o_totalprice"):
    """Per day: flights, mean delay, mean departures-per-airport-that-day seen by a flight,
    month encoding and holiday distance.

    The daily load a flight sees is the window count over (day, airport); its mean over the
    day's flights is sum(n^2)/sum(n) over the (day, airport) groups, so the whole table is two
    partial aggregations: no window sort, no join, and a hot airport collapses map-side.
    """
    # the delay sum is exact (DECIMAL), so the mean does not depend on summation order
    per_airport = flights.groupBy(date_col, airport).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(delay).cast("decimal(18,2)")).alias("_s"))
    daily = per_airport.groupBy(date_col).agg(
        F.sum("_n").alias("n_flights"),
        (F.sum("_s").cast("double") / F.sum("_n")).alias("avg_delay"),
        (F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")).alias("avg_daily_load"))
    return daily.select(
        date_col, "n_flights", "avg_delay",
        r6("avg_daily_load").alias("avg_daily_load"),
        r6(cyclic_sin(F.month(date_col), MONTH_PERIOD)).alias("month_sin"),
        holidays.holiday_distance(F.col(date_col)).alias("holiday_distance")).orderBy(date_col)


@register("flagship_daily_features", ("SCA1", "SCA2", "SCA6", "WIN1", "AGG7", "SRT2"), oracle=f"""
WITH per AS (
  SELECT make_date(CAST(year(o_orderdate) AS BIGINT), CAST(month(o_orderdate) AS BIGINT),
                   CAST(day(o_orderdate) AS BIGINT)) AS Date,
         o_orderpriority, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS s
  FROM orders GROUP BY ALL)
SELECT Date, CAST(sum(n) AS BIGINT) AS n_flights, CAST(sum(s) AS DOUBLE) / sum(n) AS avg_delay,
       {duck.r6("CAST(sum(n * n) AS DOUBLE) / sum(n)")} AS avg_daily_load,
       {duck.r6(duck.cyc("month(Date)", MONTH_PERIOD))} AS month_sin,
       {_HD} AS holiday_distance
FROM per GROUP BY Date ORDER BY Date""")
def flagship_daily_features(spark, sf_dir):
    f = orders_as_flights(spark, sf_dir).withColumn(
        "Date", flight_date("Year", "Month", "DayofMonth"))
    return daily_features(f)


@register("drop_leakage", "PRJ1", oracle="""
SELECT * EXCLUDE (l_tax, l_discount, l_linestatus) FROM lineitem""")
def q_drop_leakage(spark, sf_dir):
    return clean.drop_leakage(t(spark, sf_dir, "lineitem"),
                              ("l_tax", "l_discount", "l_linestatus", "not_a_column"))


@register("drop_na_sentinel", ("FIL1", "FIL4"), oracle=f"""
SELECT * FROM ({ORDERS_AS_STRINGS_SQL}) s
WHERE o_totalprice IS NOT NULL AND o_totalprice <> 'NA'
  AND o_orderpriority IS NOT NULL AND o_orderpriority <> 'NA'
  AND o_orderstatus IS NOT NULL AND o_orderstatus <> 'NA'""")
def q_drop_na_sentinel(spark, sf_dir):
    return clean.drop_na_sentinel(orders_as_strings(spark, sf_dir),
                                  ("o_totalprice", "o_orderpriority", "o_orderstatus"))


@register("clean_table", ("PRJ2", "PRJ3", "PRJ6", "FIL1", "SCA1", "SCA10"), oracle=f"""
SELECT o_orderkey, o_custkey, o_orderstatus, TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice,
       o_orderpriority, Year, Month, DayofMonth,
       TRY_CAST(Year || '-' || lpad(Month, 2, '0') || '-' || lpad(DayofMonth, 2, '0') AS DATE)
         AS Date,
       TRY_CAST(o_orderkey AS INTEGER) AS o_orderkey_Int
FROM ({ORDERS_AS_STRINGS_SQL}) s
WHERE o_orderpriority IS NOT NULL AND o_orderpriority <> 'NA'""")
def q_clean_table(spark, sf_dir):
    s = orders_as_strings(spark, sf_dir)
    out = clean.clean_flights(s, required=("o_orderpriority",), int_cols=())
    out = clean.cast_columns(out, {"o_totalprice": "double"}, keep_order=True)
    return clean.add_int_columns(out, ["o_orderkey"])


@register("cast_move_to_end", "PRJ3", oracle=f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, Year, Month, DayofMonth,
       TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice
FROM ({ORDERS_AS_STRINGS_SQL}) s""")
def q_cast_move_to_end(spark, sf_dir):
    return clean.cast_columns(orders_as_strings(spark, sf_dir), {"o_totalprice": "double"},
                              keep_order=False)


@register("numeric_columns", "PRJ5", oracle="""
SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def q_numeric_columns(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    return li.select(*clean.numeric_columns(li))


@register("outliers", "FIL2", oracle="""
SELECT * FROM lineitem WHERE l_extendedprice > 90000""")
def q_outliers(spark, sf_dir):
    return clean.outliers(t(spark, sf_dir, "lineitem"), "l_extendedprice", 90000)


@register("exclude_value", "FIL3", oracle="""
SELECT * FROM lineitem WHERE l_suppkey <> 7 AND l_partkey <> 7""")
def q_exclude_value(spark, sf_dir):
    return clean.exclude_value(t(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey"], 7)


@register("flight_date", ("SCA1", "SCA10"), oracle=f"""
SELECT o_orderkey, Year, Month, DayofMonth,
       TRY_CAST(Year || '-' || lpad(Month, 2, '0') || '-' || lpad(DayofMonth, 2, '0') AS DATE)
         AS Date
FROM ({ORDERS_AS_STRINGS_SQL}) s""")
def q_flight_date(spark, sf_dir):
    s = orders_as_strings(spark, sf_dir)
    return s.select("o_orderkey", "Year", "Month", "DayofMonth",
                    flight_date("Year", "Month", "DayofMonth").alias("Date"))


@register("cyclic_encoding", "SCA2", oracle=f"""
SELECT o_orderkey,
       {duck.r6(duck.cyc("month(o_orderdate)", MONTH_PERIOD))} AS month_sin,
       {duck.r6(duck.cyc("day(o_orderdate)", DAY_OF_MONTH_PERIOD))} AS day_of_month_sin,
       {duck.r6(duck.cyc("isodow(o_orderdate)", DAY_OF_WEEK_PERIOD))} AS day_of_week_sin,
       {duck.r6(f"cos({2 * 3.141592653589793 / MONTH_PERIOD!r} * month(o_orderdate))")}
         AS month_cos
FROM orders""")
def q_cyclic_encoding(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey",
        r6(cyclic_sin(F.month(d), MONTH_PERIOD)).alias("month_sin"),
        r6(cyclic_sin(F.dayofmonth(d), DAY_OF_MONTH_PERIOD)).alias("day_of_month_sin"),
        r6(cyclic_sin(iso_weekday(d), DAY_OF_WEEK_PERIOD)).alias("day_of_week_sin"),
        r6(encode.cyclic_cos(F.month(d), MONTH_PERIOD)).alias("month_cos"))


_HHMM_SQL = "CAST(hour(ts) * 100 + minute(ts) AS VARCHAR)"


def _duck_hhmm(s: str) -> tuple[str, str]:
    tt = f"TRY_CAST({s} AS INTEGER)"
    valid = f"({tt} >= 0 AND {tt} // 100 <= 24 AND {tt} % 100 <= 59)"
    h = f"CASE WHEN {valid} THEN {tt} // 100 END"
    m = f"CASE WHEN {valid} THEN {tt} % 100 END"
    return h, m


@register("hhmm_split", "SCA3", oracle=f"""
SELECT event_id, hhmm,
       {duck.r6(duck.cyc(_duck_hhmm('hhmm')[0], 24.0))} AS hhmm_Hours,
       {duck.r6(duck.cyc(_duck_hhmm('hhmm')[1], 60.0))} AS hhmm_Minutes
FROM (SELECT event_id,
             CASE WHEN event_id % 97 = 0 THEN 'NA' WHEN event_id % 89 = 0 THEN '2400'
                  WHEN event_id % 83 = 0 THEN '12345' ELSE {_HHMM_SQL} END AS hhmm
      FROM events) e""")
def q_hhmm_split(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    k = F.col("event_id")
    hhmm = (F.when(k % 97 == 0, F.lit("NA")).when(k % 89 == 0, F.lit("2400"))
            .when(k % 83 == 0, F.lit("12345"))
            .otherwise((F.hour("ts") * 100 + F.minute("ts")).cast("string")))
    e = e.select("event_id", hhmm.alias("hhmm"))
    return e.select("event_id", "hhmm", r6(encode.hhmm_hours("hhmm")).alias("hhmm_Hours"),
                    r6(encode.hhmm_minutes("hhmm")).alias("hhmm_Minutes"))


_CAL_SQL = " UNION ALL ".join(
    f"SELECT year, '{name}' AS holiday, CAST({fn('year')} AS DATE) AS holiday_date FROM years"
    for name, fn in duck.HOLIDAY_SQL.items())


@register("holiday_calendar", ("SCA4", "SCA5a", "SCA5b", "SCA5c", "SCA5"), oracle=f"""
WITH years AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
  UNION SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) FROM lineitem)
{_CAL_SQL}""")
def q_holiday_calendar(spark, sf_dir):
    years = (t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
             .union(t(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"))))
    return holidays.holidays_for_years(years, "year")


@register("holiday_distance", ("SCA6", "JOI2"), oracle=f"""
SELECT Date, {_HD} AS holiday_distance
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS Date FROM orders) d""")
def q_holiday_distance(spark, sf_dir):
    d = t(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("Date")).distinct()
    return d.select("Date", holidays.holiday_distance("Date").alias("holiday_distance"))


@register("holiday_distance_span", ("SCA6", "JOI2"), oracle=f"""
SELECT Date, {duck.holiday_distance("Date", span_years=True)} AS holiday_distance
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS Date FROM lineitem) d""")
def q_holiday_distance_span(spark, sf_dir):
    d = t(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("Date")).distinct()
    return d.select("Date", holidays.holiday_distance("Date", span_years=True)
                    .alias("holiday_distance"))


@register("asof_nearest_event", "JOI2", oracle="""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS e FROM orders WHERE o_orderkey % 3 = 0)
SELECT l_orderkey, l_linenumber, CAST(least(
         CAST(l_shipdate AS DATE) - coalesce(b.e, DATE '0001-01-01'),
         coalesce(f.e, DATE '9999-12-31') - CAST(l_shipdate AS DATE)) AS INTEGER) AS days
FROM lineitem l ASOF LEFT JOIN d b ON CAST(l.l_shipdate AS DATE) >= b.e
     ASOF LEFT JOIN d f ON CAST(l.l_shipdate AS DATE) <= f.e""")
def q_asof_nearest_event(spark, sf_dir):
    """Days to the nearest event of a calendar of hundreds of dates a year."""
    from ..operators.asof import nearest_event_distance

    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                             F.to_date("l_shipdate").alias("d"))
    events = t(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select("o_orderdate")
    return nearest_event_distance(li, "d", events, "o_orderdate", "days").drop("d")


@register("asof_by_user", "JOI2", oracle="""
WITH e AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase'
           GROUP BY user_id, ts)
SELECT v.event_id, e.ts AS ts_event, e.value
FROM events v ASOF LEFT JOIN e ON v.user_id = e.user_id AND v.ts >= e.ts""")
def q_asof_by_user(spark, sf_dir):
    """To every event the user's last purchase up to it."""
    from ..operators.asof import asof_join

    v = t(spark, sf_dir, "events")
    e = v.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(
        F.max("value").alias("value"))
    met = asof_join(v.select("event_id", "user_id", "ts"), e, "ts", "ts", by="user_id")
    return met.select("event_id", "ts_event", "value")


@register("nearest_holiday_join", ("SCA6", "JOI2"), oracle=f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS Date,
       {duck.holiday_distance("CAST(o_orderdate AS DATE)")} AS holiday_distance
FROM orders""")
def q_nearest_holiday_join(spark, sf_dir):
    from ..operators.calendar import nearest_holiday_distance

    o = t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("Date"))
    return nearest_holiday_distance(o, "Date", "holiday_distance")
