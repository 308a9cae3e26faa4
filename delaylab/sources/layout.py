"""Tables in folders by year (or any low-cardinality columns), written and read by folder.

A query that names its years lists and reads those folders only, and one year can be written anew
without touching the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._util import as_list
from .flights import LEAKAGE_COLUMNS
from .rejects import Ingested, ingest


def write_partitioned(df: DataFrame, path: str, by="Year", replace: str = "partitions",
                      max_rows_per_file: int | None = None) -> None:
    """Parquet in folders by ``by``.

    ``replace``: ``partitions`` (the folders that ``df`` has rows for are replaced, all others
    stay), ``all`` or ``none`` (rows are added). Rows are rebalanced by the folder columns first,
    so a folder gets few files and a folder with much of the data is written by several tasks; the
    rebalancing is adaptive and has no fixed number of tasks. NULLs have a folder of their own."""
    modes = {"partitions": ("overwrite", "dynamic"), "all": ("overwrite", "static"),
             "none": ("append", "static")}
    if replace not in modes:
        raise ValueError(f"replace must be one of {', '.join(modes)}")
    mode, scope = modes[replace]
    by = as_list(by)
    writer = (df.hint("rebalance", *by).write.mode(mode).partitionBy(*by)
              .option("partitionOverwriteMode", scope))
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def read_partitioned(spark: SparkSession, path: str, by="Year", only: dict | None = None,
                     types: dict | None = None) -> DataFrame:
    """The table of ``write_partitioned``. Folder columns are strings unless ``types`` names
    another type (``{"Year": "int"}``): folder names never change type with their content.
    ``only={"Year": ["2006", "2007"]}`` reads those folders."""
    by = as_list(by)
    types = types or {}
    found = spark.read.parquet(path).schema
    kinds = {c: T._parse_datatype_string(types.get(c, "string")) for c in by}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType), True, f.metadata)
                           for f in found.fields])
    out = spark.read.schema(schema).parquet(path)
    for name, values in (only or {}).items():
        if name not in by:
            raise ValueError(f"{name} is not a folder column")
        kind = kinds[name]
        out = out.where(F.col(name).isin([F.lit(v).cast(kind) for v in as_list(values)]))
    return out


def convert_years(spark: SparkSession, src, dst: str, drop=LEAKAGE_COLUMNS, by="Year",
                  replace: str = "partitions") -> Ingested:
    """CSV files -> Parquet by year without the leakage columns. Converting one more year, or one
    year again, leaves the other years alone. Returns the account of the files' lines."""
    found = ingest(spark, src)
    write_partitioned(found.good.drop(*drop), dst, by, replace)
    return found
