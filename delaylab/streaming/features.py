"""The row-wise feature steps on a stream of flight CSV files.

Cleaning, integer casts, cyclic and hhmm encodings and the holiday distance are all row-wise
expressions, so the same functions apply to a streaming DataFrame unchanged. The per-day
counts (WIN1-3) are not offered here: they are unordered non-time windows, which Structured
Streaming rejects. The sink is parquet; the caller names the checkpoint folder, and a query restarted
with the same folder resumes exactly once from its last batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encode import (DAY_OF_MONTH_PERIOD, DAY_OF_WEEK_PERIOD, MONTH_PERIOD,
                                cyclic_sin, flight_date, hhmm_hours, hhmm_minutes)
from ..functions.holidays import holiday_distance
from ..operators import clean
from ..sources.flights import FLIGHT_COLUMNS, string_schema

TIME_COLUMNS = ("DepTime", "CRSDepTime", "CRSArrTime")


def read_flight_stream(spark: SparkSession, folder: str, columns=FLIGHT_COLUMNS,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """New headered CSV files in ``folder`` as a stream of all-string rows (malformed rows
    dropped and headers checked against ``columns``, as in the batch reader)."""
    r = (spark.readStream.schema(string_schema(columns)).option("header", True)
         .option("enforceSchema", False)
         .option("mode", "DROPMALFORMED").option("columnPruning", False))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(folder)


def row_features(df: DataFrame) -> DataFrame:
    """Row-wise part of the flight preparation (works on batch and streaming frames)."""
    out = clean.drop_na_sentinel(clean.drop_leakage(df))
    out = clean.add_int_columns(out, ["Year", "CRSElapsedTime", "DepDelay", "Distance",
                                      "TaxiOut", "ArrDelay"])
    cols = {
        "Month_sin": cyclic_sin(F.col("Month").try_cast("int"), MONTH_PERIOD),
        "DayofMonth_sin": cyclic_sin(F.col("DayofMonth").try_cast("int"), DAY_OF_MONTH_PERIOD),
        "DayOfWeek_sin": cyclic_sin(F.col("DayOfWeek").try_cast("int"), DAY_OF_WEEK_PERIOD),
        "Date": flight_date("Year", "Month", "DayofMonth"),
    }
    for c in TIME_COLUMNS:
        cols[f"{c}_Hours"] = hhmm_hours(c)
        cols[f"{c}_Minutes"] = hhmm_minutes(c)
    out = out.withColumns(cols)
    return out.withColumn("DistanceToHoliday", holiday_distance("Date"))


def start_feature_stream(spark: SparkSession, source: str, sink: str, checkpoint: str,
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         columns=FLIGHT_COLUMNS):
    """Start the stream source -> row features -> parquet sink; returns the StreamingQuery.

    ``checkpoint`` is the caller's own stable folder for this source and sink: a restart with the
    same folder goes on after the last committed file, each file's rows written exactly once."""
    stream = row_features(read_flight_stream(spark, source, columns, max_files_per_trigger))
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start(sink)
