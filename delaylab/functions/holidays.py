"""US holiday rules as native date expressions of a year column, and the distance to the
nearest holiday.

Every rule maps an INT year column to a DATE column, so a calendar is a projection of a
``spark.range`` of years (or of the years found in a table) and the distance of a date to its
nearest holiday is a ``least`` over a few rule expressions: no UDF, no per-row calendar object.

Rules follow the public definitions: nth weekday of a month, last weekday of a month, the
Gregorian computus for Easter, and the federal "observed" shift (Saturday -> Friday before,
Sunday -> Monday after).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .._util import as_col


def _md(y: Column, month: int, day: int) -> Column:
    return F.make_date(y, F.lit(month), F.lit(day))


def nth_weekday(y, month: int, weekday: str, n: int) -> Column:
    """The n-th ``weekday`` ('MON', 'TUE', ...) of ``month`` in year ``y``."""
    first_on_or_after = F.next_day(F.date_sub(_md(as_col(y), month, 1), 1), weekday)
    return F.date_add(first_on_or_after, 7 * (n - 1))


def last_weekday(y, month: int, weekday: str) -> Column:
    """The last ``weekday`` of ``month`` in year ``y``."""
    return F.next_day(F.date_sub(F.last_day(_md(as_col(y), month, 1)), 7), weekday)


def observed(d: Column) -> Column:
    """Federal observance: a Saturday holiday is kept on Friday, a Sunday one on Monday."""
    wd = F.weekday(d)  # 0 = Monday ... 6 = Sunday
    return F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_add(d, 1)).otherwise(d)


def easter_sunday(y) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus), integer column arithmetic."""
    y = as_col(y).cast("int")

    def div(a, b):
        return F.floor(a / b).cast("int")

    a = y % 19
    b = div(y, 100)
    c = y % 100
    d = div(b, 4)
    e = b % 4
    f = div(b + 8, 25)
    g = div(b - f + 1, 3)
    h = (19 * a + b - d - g + 15) % 30
    i = div(c, 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = div(a + 11 * h + 22 * l_, 451)
    s = h + l_ - 7 * m + 114
    return F.make_date(y, div(s, 31), (s % 31) + 1)


# The twenty holiday names in calendar order, and the ten used by the distance
# feature (New Year, MLK, Presidents, Memorial, Independence, Labor, Columbus, Veterans,
# Thanksgiving, Christmas).
HOLIDAY_RULES: dict[str, Callable[[Column], Column]] = {
    "new_years_day": lambda y: _md(y, 1, 1),
    "new_years_day_observed": lambda y: observed(_md(y, 1, 1)),
    "martin_luther_king": lambda y: nth_weekday(y, 1, "MON", 3),
    "lincolns_birthday": lambda y: _md(y, 2, 12),
    "valentines_day": lambda y: _md(y, 2, 14),
    "presidents_day": lambda y: nth_weekday(y, 2, "MON", 3),
    "good_friday": lambda y: F.date_sub(easter_sunday(y), 2),
    "easter_sunday": lambda y: easter_sunday(y),
    "easter_monday": lambda y: F.date_add(easter_sunday(y), 1),
    "memorial_day": lambda y: last_weekday(y, 5, "MON"),
    "independence_day": lambda y: _md(y, 7, 4),
    "independence_day_observed": lambda y: observed(_md(y, 7, 4)),
    "labor_day": lambda y: nth_weekday(y, 9, "MON", 1),
    "columbus_day": lambda y: nth_weekday(y, 10, "MON", 2),
    "halloween": lambda y: _md(y, 10, 31),
    "us_election_day": lambda y: F.date_add(nth_weekday(y, 11, "MON", 1), 1),
    "veterans_day": lambda y: _md(y, 11, 11),
    "thanksgiving": lambda y: nth_weekday(y, 11, "THU", 4),
    "christmas_day": lambda y: _md(y, 12, 25),
    "christmas_day_observed": lambda y: observed(_md(y, 12, 25)),
}

DISTANCE_HOLIDAYS = ("new_years_day", "martin_luther_king", "presidents_day", "memorial_day",
                     "independence_day", "labor_day", "columbus_day", "veterans_day",
                     "thanksgiving", "christmas_day")


def holiday(name: str, y) -> Column:
    """Date of holiday ``name`` in year ``y`` (a column or an int)."""
    y = F.lit(y) if isinstance(y, int) else as_col(y)
    return HOLIDAY_RULES[name](y.cast("int"))


def holiday_distance(date_col, span_years: bool = False,
                     holidays: tuple[str, ...] = DISTANCE_HOLIDAYS) -> Column:
    """Days from ``date_col`` to the nearest of ``holidays`` in the same year (INT).

    With ``span_years`` the previous and next years' holidays count too, so 31 Dec is one day
    from New Year rather than six from Christmas. NULL date -> NULL.
    """
    d = as_col(date_col)
    y = F.year(d)
    years = [y - 1, y, y + 1] if span_years else [y]
    dists = [F.abs(F.datediff(d, holiday(h, yy))) for yy in years for h in holidays]
    return F.least(*dists).cast("int")


def holidays_for_years(years: DataFrame, year_col: str = "year",
                       names: tuple[str, ...] | None = None) -> DataFrame:
    """Calendar (``year``, ``holiday``, ``holiday_date``) for the distinct years of a table."""
    names = tuple(names or HOLIDAY_RULES)
    y = F.col(year_col).cast("int")
    rows = F.array(*[F.struct(F.lit(n).alias("holiday"), holiday(n, y).alias("holiday_date"))
                     for n in names])
    return (years.select(y.alias("year")).where(F.col("year").isNotNull()).distinct()
            .select("year", F.inline(rows)))


def holiday_calendar(spark: SparkSession, first_year: int, last_year: int,
                     names: tuple[str, ...] | None = None) -> DataFrame:
    """Calendar table for ``first_year`` .. ``last_year`` inclusive."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return holidays_for_years(years, "year", names)
