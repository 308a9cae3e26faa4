"""Distance to the nearest holiday of an arbitrary calendar table (JOI2 as a join).

For the built-in rules ``functions.holiday_distance`` is a pure expression and needs no join.
For a custom calendar (any table of ``year``, ``holiday_date``) the distance is computed once
per distinct date, not per row: distinct dates are bounded by the days in the data's range, the
calendar by years x rules, and the per-date result is attached back with a measured broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.holidays import DISTANCE_HOLIDAYS, holidays_for_years
from ._plan import attach_small, materialize


def nearest_holiday_distance(df: DataFrame, date_col: str, out: str,
                             calendar: DataFrame | None = None, span_years: bool = False,
                             names=DISTANCE_HOLIDAYS) -> DataFrame:
    """Add ``out`` = days from ``date_col`` to the nearest ``calendar`` date of the same year
    (or of the neighbouring years with ``span_years``). NULL date -> NULL."""
    dates = materialize(df.select(F.col(date_col).alias("_d")).where(F.col("_d").isNotNull())
                        .distinct())
    y = F.year("_d")
    if calendar is None:
        calendar = holidays_for_years(dates.select(y.alias("year")), "year", tuple(names))
        if span_years:
            calendar = holidays_for_years(
                dates.select(F.explode(F.array(y - 1, y, y + 1)).alias("year")), "year",
                tuple(names))
    years = F.array(y - 1, y, y + 1) if span_years else F.array(y)
    cand = dates.select("_d", F.explode(years).alias("year"))
    pairs = attach_small(cand, calendar.select("year", "holiday_date"), ["year"], "inner")
    per_date = pairs.groupBy("_d").agg(
        F.min(F.abs(F.datediff("_d", "holiday_date"))).cast("int").alias(out))
    return attach_small(df, per_date.withColumnRenamed("_d", date_col), [date_col], "left")
