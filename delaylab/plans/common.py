"""Shared mappings from the driver tables to flight-shaped tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .._util import as_col
from ..sources.flights import table


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def r6(c, digits: int = 6) -> Column:
    """Round and normalize -0.0 to 0.0 (the oracle does the same)."""
    return F.round(as_col(c), digits) + F.lit(0.0)


def orders_as_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a flight table: Year/Month/DayofMonth strings from the order date, the order
    priority as the airport, the total price as the delay measure."""
    o = t(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.year(d).cast("string").alias("Year"), F.month(d).cast("string").alias("Month"),
        F.dayofmonth(d).cast("string").alias("DayofMonth"))


def orders_as_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as an all-string flight-like table with planted sentinels: ``"NA"`` where
    ``o_orderkey % 17 = 0`` (price) or ``% 13 = 0`` (priority), NULL where ``% 19 = 0``
    (status), an invalid day (30 Feb) where ``% 23 = 0``."""
    o = t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    day = F.when(k % 23 == 0, F.lit("30")).otherwise(F.dayofmonth(d).cast("string"))
    month = F.when(k % 23 == 0, F.lit("2")).otherwise(F.month(d).cast("string"))
    return o.select(
        k.cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"),
        F.when(k % 17 == 0, F.lit("NA")).otherwise(F.col("o_totalprice").cast("string"))
        .alias("o_totalprice"),
        F.when(k % 13 == 0, F.lit("NA")).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"),
        F.year(d).cast("string").alias("Year"), month.alias("Month"), day.alias("DayofMonth"))


ORDERS_AS_STRINGS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 17 = 0 THEN 'NA' ELSE CAST(o_totalprice AS VARCHAR) END
         AS o_totalprice,
       CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS VARCHAR) AS Year,
       CASE WHEN o_orderkey % 23 = 0 THEN '2' ELSE CAST(month(o_orderdate) AS VARCHAR) END
         AS Month,
       CASE WHEN o_orderkey % 23 = 0 THEN '30' ELSE CAST(day(o_orderdate) AS VARCHAR) END
         AS DayofMonth
FROM orders"""


def flights_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a raw on-time table: every column a string, named like the flight files.

    Dates from the ship date; carrier from return flag + line status; flight number, tail,
    origin and destination from part / order / supplier keys; clock times from key arithmetic;
    delays from quantity and price; one order in 41 cancelled (times and delay ``NA``, a code
    A-D). All derived row by row, so the table grows with lineitem.
    """
    li = t(spark, sf_dir, "lineitem")
    d = F.to_date("l_shipdate")
    ok, pk, sk, ln = (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
                      F.col("l_linenumber"))
    cancelled = ok % 41 == 0

    def s(c):
        return c.cast("string")

    def na_if_cancelled(c):
        return F.when(cancelled, F.lit("NA")).otherwise(s(c))

    crs_dep = ((ok * 7 + ln * 3) % 18 + 6) * 100 + (pk % 12) * 5
    crs_arr = ((ok * 7 + ln * 3 + 2) % 18 + 6) * 100 + (sk % 12) * 5
    dep_delay = (F.col("l_quantity") - 20).cast("int")
    taxi_out = (F.col("l_discount") * 200 + 5).cast("int")
    arr_delay = (dep_delay + taxi_out - 15 + (F.col("l_extendedprice") / 10000).cast("int"))
    code = F.element_at(F.array(*[F.lit(c) for c in "ABCD"]), (ln % 4 + 1).cast("int"))
    return li.select(
        s(F.year(d)).alias("Year"), s(F.month(d)).alias("Month"),
        s(F.dayofmonth(d)).alias("DayofMonth"), s(F.weekday(d) + 1).alias("DayOfWeek"),
        na_if_cancelled(crs_dep + (F.col("l_quantity") % 5).cast("int")).alias("DepTime"),
        s(crs_dep).alias("CRSDepTime"), na_if_cancelled(crs_arr).alias("ArrTime"),
        s(crs_arr).alias("CRSArrTime"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("UniqueCarrier"),
        s(pk % 500).alias("FlightNum"), F.concat(F.lit("N"), s(ok % 300)).alias("TailNum"),
        na_if_cancelled(F.lit(120)).alias("ActualElapsedTime"),
        s((F.col("l_tax") * 1000 + 60).cast("int")).alias("CRSElapsedTime"),
        na_if_cancelled(F.lit(100)).alias("AirTime"), na_if_cancelled(arr_delay).alias("ArrDelay"),
        na_if_cancelled(dep_delay).alias("DepDelay"),
        F.concat(F.lit("S"), s(sk % 50)).alias("Origin"),
        F.concat(F.lit("P"), s(pk % 25)).alias("Dest"), s(pk % 2000 + 100).alias("Distance"),
        na_if_cancelled(F.lit(7)).alias("TaxiIn"), s(taxi_out).alias("TaxiOut"),
        F.when(cancelled, F.lit("1")).otherwise(F.lit("0")).alias("Cancelled"),
        F.when(cancelled, code).otherwise(F.lit(None).cast("string")).alias("CancellationCode"),
        F.lit("0").alias("Diverted"), F.lit("NA").alias("CarrierDelay"),
        F.lit("NA").alias("WeatherDelay"), F.lit("NA").alias("NASDelay"),
        F.lit("NA").alias("SecurityDelay"), F.lit("NA").alias("LateAircraftDelay"))


def _na_if_cancelled_sql(expr: str) -> str:
    return f"CASE WHEN l_orderkey % 41 = 0 THEN 'NA' ELSE CAST({expr} AS VARCHAR) END"


_CRS_DEP = "(((l_orderkey * 7 + l_linenumber * 3) % 18 + 6) * 100 + (l_partkey % 12) * 5)"
_CRS_ARR = "(((l_orderkey * 7 + l_linenumber * 3 + 2) % 18 + 6) * 100 + (l_suppkey % 12) * 5)"
_DEP_DELAY = "CAST(trunc(l_quantity - 20) AS INTEGER)"
_TAXI_OUT = "CAST(trunc(l_discount * 200 + 5) AS INTEGER)"
_ARR_DELAY = (f"{_DEP_DELAY} + {_TAXI_OUT} - 15 "
              "+ CAST(trunc(l_extendedprice / 10000) AS INTEGER)")

# lineitem as a raw flight table in DuckDB SQL, without the leakage columns (same rules as
# flights_from_lineitem; casts to int truncate there, so trunc() here).
FLIGHTS_FROM_LINEITEM_STRIPPED_SQL = f"""
SELECT CAST(year(l_shipdate) AS VARCHAR) AS Year, CAST(month(l_shipdate) AS VARCHAR) AS Month,
       CAST(day(l_shipdate) AS VARCHAR) AS DayofMonth,
       CAST(isodow(l_shipdate) AS VARCHAR) AS DayOfWeek,
       {_na_if_cancelled_sql(f"{_CRS_DEP} + CAST(trunc(l_quantity % 5) AS INTEGER)")} AS DepTime,
       CAST({_CRS_DEP} AS VARCHAR) AS CRSDepTime, CAST({_CRS_ARR} AS VARCHAR) AS CRSArrTime,
       l_returnflag || l_linestatus AS UniqueCarrier,
       CAST(l_partkey % 500 AS VARCHAR) AS FlightNum,
       'N' || CAST(l_orderkey % 300 AS VARCHAR) AS TailNum,
       CAST(CAST(trunc(l_tax * 1000 + 60) AS INTEGER) AS VARCHAR) AS CRSElapsedTime,
       {_na_if_cancelled_sql(_ARR_DELAY)} AS ArrDelay,
       {_na_if_cancelled_sql(_DEP_DELAY)} AS DepDelay,
       'S' || CAST(l_suppkey % 50 AS VARCHAR) AS Origin,
       'P' || CAST(l_partkey % 25 AS VARCHAR) AS Dest,
       CAST(l_partkey % 2000 + 100 AS VARCHAR) AS Distance, CAST({_TAXI_OUT} AS VARCHAR) AS TaxiOut,
       CASE WHEN l_orderkey % 41 = 0 THEN '1' ELSE '0' END AS Cancelled,
       CASE WHEN l_orderkey % 41 = 0 THEN ['A', 'B', 'C', 'D'][l_linenumber % 4 + 1] END
         AS CancellationCode
FROM lineitem"""
