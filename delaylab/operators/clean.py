"""Projections and filters that clean a flight table (DataFrame -> DataFrame).

All casts are ``try_cast``: the sentinel ``"NA"`` becomes NULL instead of failing the task
under ANSI mode. Filters are plain predicates, so Catalyst pushes them into the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.encode import flight_date
from ..sources.flights import LEAKAGE_COLUMNS, NA

# Columns that must hold a value for a flight to be used, and the columns the
# cleaning step turns into integers.
REQUIRED_COLUMNS = ("ArrDelay", "DepTime", "CRSDepTime", "CRSArrTime")
INT_COLUMNS = ("ArrDelay", "DepDelay", "CRSElapsedTime", "Distance", "TaxiOut")


def drop_leakage(df: DataFrame, cols=LEAKAGE_COLUMNS) -> DataFrame:
    """Drop columns known only after the outcome; absent names are ignored."""
    return df.drop(*cols)


def add_int_columns(df: DataFrame, cols, suffix: str = "_Int") -> DataFrame:
    """Add ``<c><suffix>`` = ``try_cast(c AS INT)`` beside each original column."""
    return df.withColumns({c + suffix: F.col(c).try_cast("int") for c in cols})


def cast_columns(df: DataFrame, types: dict, keep_order: bool = True) -> DataFrame:
    """Cast columns in place with ``try_cast``. ``keep_order=False`` moves each cast column to
    the end, as a drop-and-re-add would."""
    if keep_order:
        return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    rest = [c for c in df.columns if c not in types]
    return df.select(*rest, *[F.col(c).try_cast(t).alias(c) for c, t in types.items()])


def numeric_columns(df: DataFrame, types=("int", "double")) -> list[str]:
    """Names of the columns whose simple type is in ``types`` (schema only, no job)."""
    return [name for name, t in df.dtypes if t in types]


def sentinel_condition(cols=REQUIRED_COLUMNS, sentinel: str = NA):
    """True where every column in ``cols`` is non-NULL and not the sentinel."""
    return reduce(lambda a, b: a & b,
                  [F.col(c).isNotNull() & (F.col(c) != F.lit(sentinel)) for c in cols])


def drop_na_sentinel(df: DataFrame, cols=REQUIRED_COLUMNS, sentinel: str = NA) -> DataFrame:
    """Keep rows where every column in ``cols`` is non-NULL and not the sentinel."""
    return df.where(sentinel_condition(cols, sentinel))


def outliers(df: DataFrame, col: str, threshold) -> DataFrame:
    """Rows whose ``col`` exceeds ``threshold``."""
    return df.where(F.col(col) > F.lit(threshold))


def exclude_value(df: DataFrame, cols, value) -> DataFrame:
    """Rows where none of ``cols`` equals ``value`` (NULL never passes, as in SQL)."""
    cond = reduce(lambda a, b: a & b, [F.col(c) != F.lit(value) for c in cols])
    return df.where(cond)


def clean_flights(df: DataFrame, required=REQUIRED_COLUMNS, int_cols=INT_COLUMNS,
                  keep_order: bool = True) -> DataFrame:
    """Sentinel filter, then ``Date`` from year/month/day, then integer casts."""
    out = drop_na_sentinel(df, required).withColumn(
        "Date", flight_date("Year", "Month", "DayofMonth"))
    return cast_columns(out, {c: "int" for c in int_cols if c in df.columns}, keep_order)
