"""Column -> Column functions: encodings, holidays, transforms."""

from .encode import (cyclic_cos, cyclic_sin, flight_date, hhmm_hour, hhmm_hours, hhmm_minute,
                     hhmm_minutes, iso_weekday, try_int)
from .holidays import (DISTANCE_HOLIDAYS, HOLIDAY_RULES, easter_sunday, holiday, holiday_calendar,
                       holiday_distance, holidays_for_years, last_weekday, nth_weekday, observed)
from .transforms import boxcox_value, log_transform

__all__ = [
    "cyclic_cos", "cyclic_sin", "flight_date", "hhmm_hour", "hhmm_hours", "hhmm_minute",
    "hhmm_minutes", "iso_weekday", "try_int", "DISTANCE_HOLIDAYS", "HOLIDAY_RULES",
    "easter_sunday", "holiday", "holiday_calendar", "holiday_distance", "holidays_for_years",
    "last_weekday", "nth_weekday", "observed", "boxcox_value", "log_transform",
]
