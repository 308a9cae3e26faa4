"""Queries for sources and sinks: CSV round trips, DROPMALFORMED, results and model storage.

Intermediate files go under the session's shared checkpoint folder (``spark.checkpoint.dir``),
never a machine-local temporary folder.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..functions.encode import MONTH_PERIOD
from ..ml import evaluate, features, models
from ..operators import clean, explore
from ..session import scratch_path
from ..sources import flights, layout, rejects, sinks
from . import duck
from .common import FLIGHTS_FROM_LINEITEM_STRIPPED_SQL, r6, t
from .ml_q import _GROUP_MEAN_SQL, LABEL, _lineitem_ml, _rounded_metrics, hhmm_sql
from .registry import register

_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _typed_orders(df):
    return df.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
                     F.col("o_custkey").try_cast("bigint").alias("o_custkey"), "o_orderstatus",
                     F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
                     "o_orderpriority")


@register("csv_round_trip", ("SNK1", "SRC2"), oracle=f"""
SELECT {", ".join(_ORDER_COLS)} FROM orders""")
def q_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    sinks.write_csv(t(spark, sf_dir, "orders").select(*_ORDER_COLS), path)
    back = flights.read_flights(spark, path, mode="PERMISSIVE", columns=_ORDER_COLS)
    return _typed_orders(back)


def _planted_lines(spark, sf_dir) -> str:
    """A folder of CSV with orders whose line lacks a field (key % 11 = 0) or has one more."""
    o = t(spark, sf_dir, "orders").select(*_ORDER_COLS)
    k = F.col("o_orderkey")
    fields = [F.col(c).cast("string") for c in _ORDER_COLS]
    line = (F.when(k % 11 == 0, F.concat_ws(",", *fields[:-1]))
            .when(k % 13 == 0, F.concat_ws(",", *fields, F.lit("extra")))
            .otherwise(F.concat_ws(",", *fields)))
    # one column of whole lines, named by the header line and written with a separator that no
    # line has: every file starts with the header, as the reader asks of every file
    path = scratch_path(spark, "orders-malformed")
    (o.select(line.alias(",".join(_ORDER_COLS))).write.mode("overwrite")
     .option("header", True).option("sep", "\u0001").csv(path))
    return path


@register("csv_dropmalformed", ("SRC1",), oracle=f"""
SELECT {", ".join(_ORDER_COLS)}, count(*) OVER () AS n_rows
FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0""")
def q_csv_dropmalformed(spark, sf_dir):
    """Lines with a field missing (key % 11 = 0) or an extra field (key % 13 = 0) are written
    as text, then read by the library's reader: those rows are dropped however the table is
    projected (``n_rows`` counts them over one column)."""
    path = _planted_lines(spark, sf_dir)
    back = flights.read_flights(spark, path, columns=_ORDER_COLS)
    return _typed_orders(back).withColumn("n_rows", F.lit(back.select("o_custkey").count())
                                          .cast("long"))


@register("csv_rejects", ("SRC1",), oracle="""
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'too few fields' ELSE 'too many fields' END
         AS reason, CASE WHEN o_orderkey % 11 = 0 THEN 4 ELSE 6 END AS n_fields, true AS has_file,
       (SELECT count(*) FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0) AS n_good,
       count(*) OVER () AS n_rejected
FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0""")
def q_csv_rejects(spark, sf_dir):
    """The rejected lines with their reason, beside the counts of both kinds."""
    found = rejects.ingest(spark, _planted_lines(spark, sf_dir), _ORDER_COLS)
    return found.rejected.select(
        F.split("line", ",")[0].try_cast("bigint").alias("o_orderkey"), "reason", "n_fields",
        F.col("file").endswith(".csv").alias("has_file"),
        F.lit(found.n_good).cast("long").alias("n_good"),
        F.lit(found.n_rejected).cast("long").alias("n_rejected"))


@register("csv_rejects_good", ("SRC1",), oracle=f"""
SELECT {", ".join(_ORDER_COLS)} FROM orders
WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0""")
def q_csv_rejects_good(spark, sf_dir):
    """The good rows beside the rejected lines."""
    return _typed_orders(rejects.ingest(spark, _planted_lines(spark, sf_dir), _ORDER_COLS).good)


@register("years_layout", ("SNK1", "SRC3"), oracle="""
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS Year,
       CASE WHEN year(o_orderdate) = 1996 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
FROM orders WHERE year(o_orderdate) IN (1995, 1996)""")
def q_years_layout(spark, sf_dir):
    """Orders in folders by year; one year is written anew (negated) beside the others, then two
    years are read."""
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").cast("string").alias("Year"))
    path = scratch_path(spark, "orders-by-year")
    layout.write_partitioned(o, path)
    layout.write_partitioned(o.where("Year = '1996'").withColumn("o_totalprice", -o.o_totalprice),
                             path)
    back = layout.read_partitioned(spark, path, only={"Year": ["1995", "1996"]})
    return back.select("o_orderkey", "Year", "o_totalprice")


@register("results_round_trip", ("SNK3", "SNK4"), oracle=_GROUP_MEAN_SQL)
def q_results_round_trip(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select("l_returnflag", LABEL)
    scored = explore.group_mean_column(li, ["l_returnflag"], LABEL, "prediction")
    path = scratch_path(spark, "results")
    sinks.write_results(evaluate.regression_metrics(scored, "prediction", LABEL), path)
    view = "results_round_trip"
    sinks.register_view(spark.read.parquet(path), view)
    out = _rounded_metrics(spark.sql(f"SELECT * FROM {view}"))
    spark.catalog.dropTempView(view)
    return out


@register("model_round_trip", ("SNK2", "EST5"), oracle="""
SELECT l_orderkey, l_linenumber, true AS same FROM lineitem""")
def q_model_round_trip(spark, sf_dir):
    li = _lineitem_ml(spark, sf_dir).withColumn(
        "hhmm", (F.col("l_linenumber") * 100 + F.col("l_suppkey") % 60).cast("string"))
    stages = [features.TimeSplitter(inputCol="hhmm"),
              features.string_indexer(["l_returnflag", "l_linestatus"], "keep"),
              features.assemble(["l_quantity", "l_discount", "hhmm_Hours",
                                 "l_returnflag_Index", "l_linestatus_Index"]),
              models.tree(label=LABEL, max_depth=4)]
    model = models.fit(Pipeline(stages=stages), li)
    path = scratch_path(spark, "model")
    sinks.save_model(model, path)
    loaded = sinks.load_model(path)
    both = models.predict(loaded, models.predict(model, li).select(
        *li.columns, F.col("prediction").alias("saved")))
    return both.select("l_orderkey", "l_linenumber",
                       (F.col("prediction") == F.col("saved")).alias("same"))


@register("csv_convert_stripped", ("SRC1", "PRJ1", "SNK1"),
          oracle=FLIGHTS_FROM_LINEITEM_STRIPPED_SQL)
def q_csv_convert_stripped(spark, sf_dir):
    """The CSV conversion job: raw flight CSV -> CSV without the leakage columns, read back by
    its own header."""
    from .common import flights_from_lineitem

    raw = scratch_path(spark, "flights-csv")
    sinks.write_csv(flights_from_lineitem(spark, sf_dir), raw)
    return flights.convert(spark, raw, scratch_path(spark, "flights-stripped"))


_STREAM_SQL = f"""
SELECT Year, Month, DayofMonth, DayOfWeek, Origin, Dest, FlightNum, TailNum,
       {", ".join(f"TRY_CAST({c} AS INTEGER) AS {c}_Int" for c in (
           "CRSElapsedTime", "DepDelay", "Distance", "TaxiOut", "ArrDelay"))},
       {duck.r6(duck.cyc("TRY_CAST(Month AS INTEGER)", MONTH_PERIOD))} AS Month_sin,
       {", ".join(f"{duck.r6(duck.cyc(hhmm_sql(c)[i], p))} AS {c}_{n}" for c in (
           "DepTime", "CRSDepTime", "CRSArrTime") for i, (n, p) in enumerate(
           (("Hours", 24.0), ("Minutes", 60.0))))},
       {duck.holiday_distance("Date")} AS DistanceToHoliday
FROM (SELECT *, make_date(CAST(Year AS BIGINT), CAST(Month AS BIGINT), CAST(DayofMonth AS BIGINT))
             AS Date FROM ({FLIGHTS_FROM_LINEITEM_STRIPPED_SQL}) f
      WHERE {" AND ".join(f"{c} <> 'NA'" for c in clean.REQUIRED_COLUMNS)}) g"""


@register("stream_row_features", ("SRC1", "PRJ1", "FIL1", "SCA1", "SCA2", "SCA3", "SCA6"),
          oracle=_STREAM_SQL)
def q_stream_row_features(spark, sf_dir):
    """The row-wise feature steps run as a Structured Streaming query: flight CSV files (from
    lineitem) are picked up from a folder, processed in micro-batches and appended to a parquet
    sink with a checkpoint; the sink is read back."""
    from ..streaming import start_feature_stream
    from .common import flights_from_lineitem

    src = scratch_path(spark, "stream-src")
    sinks.write_csv(flights_from_lineitem(spark, sf_dir), src)
    sink = scratch_path(spark, "stream-sink")
    q = start_feature_stream(spark, src, sink, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    out = spark.read.parquet(sink)
    sines = ["Month_sin"] + [f"{c}_{n}" for c in ("DepTime", "CRSDepTime", "CRSArrTime")
                             for n in ("Hours", "Minutes")]
    return out.select("Year", "Month", "DayofMonth", "DayOfWeek", "Origin", "Dest", "FlightNum",
                      "TailNum", "CRSElapsedTime_Int", "DepDelay_Int", "Distance_Int",
                      "TaxiOut_Int", "ArrDelay_Int", *[r6(c).alias(c) for c in sines],
                      "DistanceToHoliday")
