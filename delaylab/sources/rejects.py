"""CSV with an account of every line: good rows, and rejected lines with reason and file.

The files are parsed once. Each line is written to one of two folders of a staging table, and the
same pass counts both, so rows plus rejected lines are the lines of the files (headers and blank
lines aside); nothing disappears between them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .flights import header_columns, string_schema

LINE = "_line"
#: Why a line is rejected, by its number of fields against the header's.
REASONS = ("too few fields", "too many fields", "malformed")


class Ingested(NamedTuple):
    """``good`` has the header's columns, ``rejected`` (line, reason, n_fields, file)."""

    good: DataFrame
    rejected: DataFrame
    n_good: int
    n_rejected: int


def field_count(line: Column, sep: str = ",") -> Column:
    """Fields of a line of CSV; separators inside double quotes do not count."""
    bare = F.regexp_replace(line, '"([^"]|"")*"', "")
    return F.size(F.split(bare, "\\Q" + sep + "\\E", -1))


def read_lines(spark: SparkSession, path, columns=None) -> DataFrame:
    """The header's columns as strings, ``_line`` (the whole line where its fields do not match
    the header, else NULL) and ``_file``."""
    columns = list(columns) if columns is not None else header_columns(spark, path)
    if LINE in columns or "_file" in columns:
        raise ValueError(f"{LINE} and _file are names of this reader")
    schema = string_schema(columns).add(LINE, T.StringType())
    parsed = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", LINE).option("columnPruning", False)
              .option("enforceSchema", False).csv(path))
    return parsed.select(*[F.col(f"`{c}`") for c in columns], LINE,
                         F.col("_metadata.file_path").alias("_file"))


def ingest(spark: SparkSession, path, columns=None, into: str | None = None) -> Ingested:
    """Read headered CSV with an account of its lines. ``into`` is the staging folder (by default
    below the shared checkpoint folder); every file's header is checked against the columns."""
    columns = list(columns) if columns is not None else header_columns(spark, path)
    seen = Observation()
    n_fields = F.when(F.col(LINE).isNotNull(), field_count(F.col(LINE)))
    few, many, other = (F.lit(r) for r in REASONS)
    reason = (F.when(F.col(LINE).isNull(), F.lit(None).cast("string"))
              .when(F.col("_fields") < len(columns), few)
              .when(F.col("_fields") > len(columns), many).otherwise(other))
    lines = read_lines(spark, path, columns).withColumn("_fields", n_fields)
    told = lines.withColumn("_reason", reason).withColumn(
        "_status", F.when(F.col(LINE).isNull(), F.lit("good")).otherwise(F.lit("rejected")))
    staging = into or scratch_path(spark, "ingest")
    (told.observe(seen, F.count_if(F.col(LINE).isNull()).alias("good"),
                  F.count_if(F.col(LINE).isNotNull()).alias("rejected"))
     .write.partitionBy("_status").parquet(staging))
    schema = T.StructType([*string_schema(columns).fields, T.StructField(LINE, T.StringType()),
                           T.StructField("_file", T.StringType()),
                           T.StructField("_fields", T.IntegerType()),
                           T.StructField("_reason", T.StringType()),
                           T.StructField("_status", T.StringType())])
    back = spark.read.schema(schema).parquet(staging)
    counts = seen.get
    return Ingested(
        back.where("_status = 'good'").select(*[F.col(f"`{c}`") for c in columns]),
        back.where("_status = 'rejected'").select(
            F.col(LINE).alias("line"), F.col("_reason").alias("reason"),
            F.col("_fields").alias("n_fields"), F.col("_file").alias("file")),
        int(counts["good"]), int(counts["rejected"]))


def rejected_summary(found: Ingested) -> DataFrame:
    """(file, reason, n) of the rejected lines."""
    return found.rejected.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))
