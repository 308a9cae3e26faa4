"""Sources: headered flight CSV read as strings, one year or several, and the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The on-time data set's 29 columns in file order, the ten columns known only
# after landing (leakage), and the missing-value sentinel.
FLIGHT_COLUMNS = (
    "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime",
    "CRSArrTime", "UniqueCarrier", "FlightNum", "TailNum", "ActualElapsedTime",
    "CRSElapsedTime", "AirTime", "ArrDelay", "DepDelay", "Origin", "Dest", "Distance", "TaxiIn",
    "TaxiOut", "Cancelled", "CancellationCode", "Diverted", "CarrierDelay", "WeatherDelay",
    "NASDelay", "SecurityDelay", "LateAircraftDelay",
)
LEAKAGE_COLUMNS = (
    "ArrTime", "ActualElapsedTime", "AirTime", "TaxiIn", "Diverted", "CarrierDelay",
    "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
)
NA = "NA"


def string_schema(columns) -> T.StructType:
    """All-string schema: the reader never infers, so a scan is one pass and never guesses."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def header_columns(spark: SparkSession, path) -> list[str]:
    """Column names from the header line (Spark reads only the first line: no inference)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_flights(spark: SparkSession, path, mode: str = "DROPMALFORMED", columns=None,
                 prune: bool = False) -> DataFrame:
    """Headered CSV as strings.

    ``columns`` defaults to the file's own header, so the full 29-column files and the files
    without leakage columns both read correctly; every file's header is checked against it.
    ``mode`` is ``DROPMALFORMED`` (rows with a wrong field count are dropped) or ``PERMISSIVE``.
    In ``DROPMALFORMED`` mode the set of dropped rows would depend on which columns a query reads;
    the parser therefore sees every column (``columnPruning=false``) so the row set is the same
    however the table is used. ``prune=True`` trades that for speed.
    """
    columns = list(columns) if columns is not None else header_columns(spark, path)
    reader = (spark.read.schema(string_schema(columns)).option("header", True)
              .option("mode", mode.upper()).option("enforceSchema", False))
    if mode.upper() == "DROPMALFORMED" and not prune:
        reader = reader.option("columnPruning", False)
    return reader.csv(path)


def read_years(spark: SparkSession, paths, mode: str = "PERMISSIVE", columns=None) -> DataFrame:
    """Several yearly files as one table: one scan over all paths (a UNION ALL by name)."""
    paths = list(paths)
    columns = list(columns) if columns is not None else header_columns(spark, paths[0])
    return read_flights(spark, paths, mode=mode, columns=columns)


def convert(spark: SparkSession, src, dst: str, drop=LEAKAGE_COLUMNS,
            num_files: int | None = None) -> DataFrame:
    """CSV -> CSV without the leakage columns (malformed rows dropped); returns the written
    table read back."""
    from .sinks import write_csv

    df = read_flights(spark, src).drop(*drop)
    write_csv(df, dst, num_files)
    return read_flights(spark, dst)


def union_by_name(frames, allow_missing: bool = False) -> DataFrame:
    """UNION ALL of frames matched by column name; frames with other columns are an error, with
    ``allow_missing`` their missing columns become NULL."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
