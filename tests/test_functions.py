"""Golden values and properties of the column functions (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaylab.functions import encode, holidays

HHMM = [("0", 0.0, 0.0), ("5", 0.0, 0.5), ("59", 0.0, -0.104528), ("600", 1.0, 0.0),
        ("1430", -0.5, 0.0), ("2359", -0.258819, -0.104528), ("2400", 0.0, 0.0),
        ("12345", None, None), ("x", None, None), ("NA", None, None), (None, None, None)]


def test_hhmm_split_golden(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in HHMM], "t string")
    out = df.select("t", (F.round(encode.hhmm_hours("t"), 6) + 0.0).alias("h"),
                    (F.round(encode.hhmm_minutes("t"), 6) + 0.0).alias("m")).collect()
    got = {r["t"]: (r["h"], r["m"]) for r in out}
    for s, h, m in HHMM:
        assert got[s] == (h, m), s


def test_cyclic_golden(spark):
    df = spark.range(1).select(
        *[F.round(encode.cyclic_sin(F.lit(m), 12), 6).alias(f"m{m}") for m in (1, 3, 6, 7, 12)],
        *[F.round(encode.cyclic_sin(F.lit(d), 30.5), 6).alias(f"d{d}") for d in (1, 15, 31)],
        *[F.round(encode.cyclic_sin(F.lit(w), 7), 6).alias(f"w{w}") for w in (1, 4, 7)])
    r = df.first()
    assert [r[f"m{m}"] + 0.0 for m in (1, 3, 6, 7, 12)] == [0.5, 1.0, 0.0, -0.5, 0.0]
    assert [r[f"d{d}"] for d in (1, 15, 31)] == [0.204552, 0.051479, 0.102821]
    assert [r[f"w{w}"] + 0.0 for w in (1, 4, 7)] == [0.781831, -0.433884, 0.0]


def test_encodings_bounded(spark):
    df = spark.range(0, 2500).select(F.col("id").cast("string").alias("t"))
    r = df.select(F.min(encode.hhmm_hours("t")), F.max(encode.hhmm_hours("t")),
                  F.min(encode.hhmm_minutes("t")), F.max(encode.hhmm_minutes("t"))).first()
    assert all(-1.0 <= v <= 1.0 for v in r)


def test_flight_date(spark):
    df = spark.createDataFrame([("2007", "2", "3"), ("2007", "02", "30"), ("2008", "2", "29"),
                                ("NA", "1", "1"), (None, "1", "1")], "y string, m string, d string")
    got = [r[0] for r in df.select(encode.flight_date("y", "m", "d")).collect()]
    assert got == [dt.date(2007, 2, 3), None, dt.date(2008, 2, 29), None, None]


CALENDAR = {
    "new_years_day": ("2006-01-01", "2007-01-01", "2008-01-01"),
    "new_years_day_observed": ("2006-01-02", "2007-01-01", "2008-01-01"),
    "martin_luther_king": ("2006-01-16", "2007-01-15", "2008-01-21"),
    "lincolns_birthday": ("2006-02-12", "2007-02-12", "2008-02-12"),
    "valentines_day": ("2006-02-14", "2007-02-14", "2008-02-14"),
    "presidents_day": ("2006-02-20", "2007-02-19", "2008-02-18"),
    "good_friday": ("2006-04-14", "2007-04-06", "2008-03-21"),
    "easter_sunday": ("2006-04-16", "2007-04-08", "2008-03-23"),
    "easter_monday": ("2006-04-17", "2007-04-09", "2008-03-24"),
    "memorial_day": ("2006-05-29", "2007-05-28", "2008-05-26"),
    "independence_day": ("2006-07-04", "2007-07-04", "2008-07-04"),
    "independence_day_observed": ("2006-07-04", "2007-07-04", "2008-07-04"),
    "labor_day": ("2006-09-04", "2007-09-03", "2008-09-01"),
    "columbus_day": ("2006-10-09", "2007-10-08", "2008-10-13"),
    "halloween": ("2006-10-31", "2007-10-31", "2008-10-31"),
    "us_election_day": ("2006-11-07", "2007-11-06", "2008-11-04"),
    "veterans_day": ("2006-11-11", "2007-11-11", "2008-11-11"),
    "thanksgiving": ("2006-11-23", "2007-11-22", "2008-11-27"),
    "christmas_day": ("2006-12-25", "2007-12-25", "2008-12-25"),
    "christmas_day_observed": ("2006-12-25", "2007-12-25", "2008-12-25"),
}


def test_holiday_calendar_golden(spark):
    cal = holidays.holiday_calendar(spark, 2006, 2008).collect()
    assert len(cal) == 60
    got = {(r["holiday"], r["year"]): r["holiday_date"].isoformat() for r in cal}
    for name, dates in CALENDAR.items():
        for y, d in zip((2006, 2007, 2008), dates):
            assert got[(name, y)] == d, (name, y)


def test_easter_known_years(spark):
    known = {1995: "1995-04-16", 2000: "2000-04-23", 2011: "2011-04-24", 2019: "2019-04-21",
             2024: "2024-03-31", 2038: "2038-04-25", 1818: "1818-03-22"}
    df = spark.createDataFrame([(y,) for y in known], "y int")
    got = {r[0]: r[1].isoformat() for r in df.select("y", holidays.easter_sunday("y")).collect()}
    assert got == known


def test_weekday_rules_property(spark):
    cal = holidays.holiday_calendar(spark, 1990, 2045).select(
        "year", "holiday", "holiday_date", (F.weekday("holiday_date") + 1).alias("dow"),
        F.dayofmonth("holiday_date").alias("dom"), F.month("holiday_date").alias("mon"))
    rows = cal.collect()
    expect = {"martin_luther_king": (1, 1, 15, 21), "presidents_day": (2, 1, 15, 21),
              "memorial_day": (5, 1, 25, 31), "labor_day": (9, 1, 1, 7),
              "columbus_day": (10, 1, 8, 14), "thanksgiving": (11, 4, 22, 28),
              "us_election_day": (11, 2, 2, 8), "easter_sunday": (None, 7, 1, 31),
              "good_friday": (None, 5, 1, 31)}
    for r in rows:
        if r["holiday"] in expect:
            mon, dow, lo, hi = expect[r["holiday"]]
            assert r["dow"] == dow, r
            assert lo <= r["dom"] <= hi, r
            if mon:
                assert r["mon"] == mon, r
        if r["holiday"].endswith("_observed"):
            assert r["dow"] <= 5, r


def test_election_and_thanksgiving_rule_choices(spark):
    cal = {(r["holiday"], r["year"]): r["holiday_date"]
           for r in holidays.holiday_calendar(spark, 1990, 2030).collect()}
    first_tuesday_differs = []
    for y in range(1990, 2031):
        nov1 = dt.date(y, 11, 1)
        first_tue = nov1 + dt.timedelta((1 - nov1.weekday()) % 7)
        if first_tue != cal[("us_election_day", y)]:
            first_tuesday_differs.append(y)
    assert {1994, 2005, 2011, 2016, 2022} <= set(first_tuesday_differs)
    last_thu_not_fourth = [y for y in (2000, 2001, 2006, 2007, 2012)
                           if (cal[("thanksgiving", y)] + dt.timedelta(7)).month == 11]
    assert last_thu_not_fourth == [2000, 2001, 2006, 2007, 2012]


DISTANCE = [("2007-01-01", 0, 0), ("2007-01-15", 0, 0), ("2007-03-20", 29, 29),
            ("2007-07-04", 0, 0), ("2007-07-05", 1, 1), ("2007-11-21", 1, 1),
            ("2007-12-31", 6, 1), ("2008-02-29", 11, 11), (None, None, None)]


@pytest.mark.parametrize("span", [False, True])
def test_holiday_distance_golden(spark, span):
    df = spark.createDataFrame([(d,) for d, _, _ in DISTANCE], "s string").select(
        "s", F.to_date("s").alias("d"))
    got = {r["s"]: r["h"] for r in df.select(
        "s", holidays.holiday_distance("d", span_years=span).alias("h")).collect()}
    for s, same, spanning in DISTANCE:
        assert got[s] == (spanning if span else same), s


def test_span_never_larger(spark):
    df = spark.range(0, 3 * 366).select(F.date_add(F.lit("2006-01-01").cast("date"),
                                                   F.col("id").cast("int")).alias("d"))
    bad = df.where(holidays.holiday_distance("d", True) > holidays.holiday_distance("d")).count()
    assert bad == 0


def test_join_distance_equals_expression(spark):
    from delaylab.operators.calendar import nearest_holiday_distance

    df = spark.range(0, 800).select(
        F.date_add(F.lit("2006-06-01").cast("date"), F.col("id").cast("int")).alias("d"))
    df = df.union(spark.createDataFrame([(None,)], "d date"))
    joined = nearest_holiday_distance(df, "d", "j", span_years=True)
    bad = joined.where(~F.col("j").eqNullSafe(holidays.holiday_distance("d", True))).count()
    assert bad == 0 and joined.count() == 801


def _py_calendar(y: int) -> dict:
    """The same public rules computed with the standard library and dateutil."""
    import calendar

    from dateutil.easter import easter

    def nth(month, weekday, n):
        days = [d for d in calendar.Calendar().itermonthdates(y, month)
                if d.month == month and d.weekday() == weekday]
        return days[n - 1] if n > 0 else days[-1]

    def obs(d):
        return d - dt.timedelta(1) if d.weekday() == 5 else (
            d + dt.timedelta(1) if d.weekday() == 6 else d)

    e = easter(y)
    return {
        "new_years_day": dt.date(y, 1, 1), "new_years_day_observed": obs(dt.date(y, 1, 1)),
        "martin_luther_king": nth(1, 0, 3), "lincolns_birthday": dt.date(y, 2, 12),
        "valentines_day": dt.date(y, 2, 14), "presidents_day": nth(2, 0, 3),
        "good_friday": e - dt.timedelta(2), "easter_sunday": e,
        "easter_monday": e + dt.timedelta(1), "memorial_day": nth(5, 0, -1),
        "independence_day": dt.date(y, 7, 4),
        "independence_day_observed": obs(dt.date(y, 7, 4)), "labor_day": nth(9, 0, 1),
        "columbus_day": nth(10, 0, 2), "halloween": dt.date(y, 10, 31),
        "us_election_day": nth(11, 0, 1) + dt.timedelta(1), "veterans_day": dt.date(y, 11, 11),
        "thanksgiving": nth(11, 3, 4), "christmas_day": dt.date(y, 12, 25),
        "christmas_day_observed": obs(dt.date(y, 12, 25)),
    }


def test_calendar_matches_standard_library_1600_2400(spark):
    rows = holidays.holiday_calendar(spark, 1600, 2400).collect()
    assert len(rows) == 801 * 20
    expected = {y: _py_calendar(y) for y in range(1600, 2401)}
    bad = [(r["year"], r["holiday"], r["holiday_date"]) for r in rows
           if expected[r["year"]][r["holiday"]] != r["holiday_date"]]
    assert bad == []


def test_distance_matches_brute_force(spark):
    start = dt.date(1999, 1, 1)
    days = [start + dt.timedelta(i) for i in range(0, 3 * 366, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r["d"]: (r["a"], r["b"]) for r in df.select(
        "d", holidays.holiday_distance("d").alias("a"),
        holidays.holiday_distance("d", span_years=True).alias("b")).collect()}
    for d in days:
        same = min(abs((h - d).days) for n, h in _py_calendar(d.year).items()
                   if n in holidays.DISTANCE_HOLIDAYS)
        span = min(abs((h - d).days) for y in (d.year - 1, d.year, d.year + 1)
                   for n, h in _py_calendar(y).items() if n in holidays.DISTANCE_HOLIDAYS)
        assert got[d] == (same, span), d


def test_hhmm_matches_python_rule(spark):
    import math

    vals = [str(i) for i in range(0, 2600, 7)] + ["-5", " 930", "9.5", "0930", ""]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = {r["t"]: (r["h"], r["m"]) for r in df.select(
        "t", encode.hhmm_hours("t").alias("h"), encode.hhmm_minutes("t").alias("m")).collect()}
    for v in vals:
        try:
            t = int(v.strip()) if v.strip().lstrip("-").isdigit() else None
        except ValueError:
            t = None
        ok = t is not None and t >= 0 and t // 100 <= 24 and t % 100 <= 59
        if not ok:
            assert got[v] == (None, None), v
        else:
            h, m = got[v]
            assert math.isclose(h, math.sin(2 * math.pi * (t // 100) / 24), abs_tol=1e-12), v
            assert math.isclose(m, math.sin(2 * math.pi * (t % 100) / 60), abs_tol=1e-12), v
