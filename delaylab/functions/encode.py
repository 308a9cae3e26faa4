"""Date and time encodings (Column -> Column), all native expressions.

* ``flight_date`` builds a date from unpadded year / month / day strings; bad dates give NULL.
* ``cyclic_sin`` / ``cyclic_cos`` encode a periodic integer on the unit circle.
* ``hhmm_hours`` / ``hhmm_minutes`` split an unpadded ``hhmm`` clock string and encode both parts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._util import as_col

# The periods of the reference's cyclic encodings.
MONTH_PERIOD = 12.0
DAY_OF_MONTH_PERIOD = 30.5
DAY_OF_WEEK_PERIOD = 7.0
HOUR_PERIOD = 24.0
MINUTE_PERIOD = 60.0


def try_int(c) -> Column:
    """String (or number) -> INT, NULL when it does not parse (never raises under ANSI)."""
    return as_col(c).try_cast("int")


def flight_date(year, month, day) -> Column:
    """``Year-Month-DayofMonth`` strings (unpadded) -> DATE; invalid dates (30 Feb) -> NULL."""
    return F.try_to_date(F.concat_ws("-", as_col(year), as_col(month), as_col(day)), "y-M-d")


def cyclic_sin(c, period: float) -> Column:
    """``sin(2*pi*x/period)``: month 12, day of month 30.5, day of week 7, hour 24, minute 60."""
    return F.sin(F.lit(2.0 * math.pi / period) * as_col(c))


def cyclic_cos(c, period: float) -> Column:
    """Companion of ``cyclic_sin`` so that two points of the cycle never share a code."""
    return F.cos(F.lit(2.0 * math.pi / period) * as_col(c))


def _hhmm_parts(c) -> tuple[Column, Column, Column]:
    t = as_col(c).try_cast("int")
    hours = F.floor(t / 100).cast("int")
    minutes = t % 100
    valid = (t >= 0) & (hours <= 24) & (minutes <= 59)
    return t, F.when(valid, hours), F.when(valid, minutes)


def hhmm_hour(c) -> Column:
    """Hours part of an unpadded ``hhmm`` value (``5`` -> 0, ``1430`` -> 14); invalid -> NULL."""
    return _hhmm_parts(c)[1]


def hhmm_minute(c) -> Column:
    """Minutes part of an unpadded ``hhmm`` value (``5`` -> 5, ``1430`` -> 30); invalid -> NULL."""
    return _hhmm_parts(c)[2]


def hhmm_hours(c) -> Column:
    """Sine encoding of the hours of an ``hhmm`` value (period 24)."""
    return cyclic_sin(hhmm_hour(c), HOUR_PERIOD)


def hhmm_minutes(c) -> Column:
    """Sine encoding of the minutes of an ``hhmm`` value (period 60)."""
    return cyclic_sin(hhmm_minute(c), MINUTE_PERIOD)


def iso_weekday(date_col) -> Column:
    """1 = Monday ... 7 = Sunday, the flight tables' ``DayOfWeek`` convention."""
    return F.weekday(as_col(date_col)) + 1
