"""DuckDB SQL fragments used by the oracle twins (the same rules written in DuckDB's dialect).

Day of week: DuckDB ``isodow`` (1 = Monday) equals Spark ``weekday(d) + 1``.
"""

from __future__ import annotations

import math

_ISO = {"MON": 1, "TUE": 2, "WED": 3, "THU": 4, "FRI": 5, "SAT": 6, "SUN": 7}


def _md(y: str, m: int, d: int) -> str:
    return f"make_date(CAST({y} AS BIGINT), {m}, {d})"


def nth_weekday(y: str, month: int, wd: str, n: int) -> str:
    first = _md(y, month, 1)
    return (f"({first} + CAST((({_ISO[wd]} - isodow({first}) + 7) % 7) + {7 * (n - 1)} "
            f"AS INTEGER))")


def last_weekday(y: str, month: int, wd: str) -> str:
    last = f"CAST(last_day({_md(y, month, 1)}) AS DATE)"
    return f"({last} - CAST(((isodow({last}) - {_ISO[wd]} + 7) % 7) AS INTEGER))"


def observed(d: str) -> str:
    return (f"(CASE isodow({d}) WHEN 6 THEN {d} - 1 WHEN 7 THEN {d} + 1 ELSE {d} END)")


def easter(y: str) -> str:
    y = f"CAST({y} AS BIGINT)"
    a = f"({y} % 19)"
    b = f"({y} // 100)"
    c = f"({y} % 100)"
    d = f"({b} // 4)"
    e = f"({b} % 4)"
    f_ = f"(({b} + 8) // 25)"
    g = f"(({b} - {f_} + 1) // 3)"
    h = f"((19 * {a} + {b} - {d} - {g} + 15) % 30)"
    i = f"({c} // 4)"
    k = f"({c} % 4)"
    l_ = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {l_}) // 451)"
    s = f"({h} + {l_} - 7 * {m} + 114)"
    return f"make_date({y}, {s} // 31, ({s} % 31) + 1)"


HOLIDAY_SQL = {
    "new_years_day": lambda y: _md(y, 1, 1),
    "new_years_day_observed": lambda y: observed(_md(y, 1, 1)),
    "martin_luther_king": lambda y: nth_weekday(y, 1, "MON", 3),
    "lincolns_birthday": lambda y: _md(y, 2, 12),
    "valentines_day": lambda y: _md(y, 2, 14),
    "presidents_day": lambda y: nth_weekday(y, 2, "MON", 3),
    "good_friday": lambda y: f"({easter(y)} - 2)",
    "easter_sunday": lambda y: easter(y),
    "easter_monday": lambda y: f"({easter(y)} + 1)",
    "memorial_day": lambda y: last_weekday(y, 5, "MON"),
    "independence_day": lambda y: _md(y, 7, 4),
    "independence_day_observed": lambda y: observed(_md(y, 7, 4)),
    "labor_day": lambda y: nth_weekday(y, 9, "MON", 1),
    "columbus_day": lambda y: nth_weekday(y, 10, "MON", 2),
    "halloween": lambda y: _md(y, 10, 31),
    "us_election_day": lambda y: f"({nth_weekday(y, 11, 'MON', 1)} + 1)",
    "veterans_day": lambda y: _md(y, 11, 11),
    "thanksgiving": lambda y: nth_weekday(y, 11, "THU", 4),
    "christmas_day": lambda y: _md(y, 12, 25),
    "christmas_day_observed": lambda y: observed(_md(y, 12, 25)),
}


def holiday_distance(d: str, span_years: bool = False) -> str:
    from ..functions.holidays import DISTANCE_HOLIDAYS

    years = [f"(year({d}) - 1)", f"year({d})", f"(year({d}) + 1)"] if span_years else [
        f"year({d})"]
    parts = [f"abs(datediff('day', {HOLIDAY_SQL[h](y)}, {d}))" for y in years
             for h in DISTANCE_HOLIDAYS]
    return f"CAST(least({', '.join(parts)}) AS INTEGER)"


def cyc(x: str, period: float) -> str:
    return f"sin({2.0 * math.pi / period!r} * ({x}))"


def r6(x: str, digits: int = 6) -> str:
    """Round and normalize -0.0 to 0.0."""
    return f"(round({x}, {digits}) + 0.0)"


def hash_unit(keys: list[str], seed: int = 42) -> str:
    parts = " || ':' || ".join([f"'{seed}'"] + [f"coalesce(CAST({k} AS VARCHAR), '')"
                                                for k in keys])
    return f"CAST(('0x' || substr(md5({parts}), 1, 15)) AS BIGINT)"


# The constants of the public 32-bit murmur3 hash.
_C1, _C2, _ADD, _F1, _F2 = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
_WORD = 1 << 32


def _mul(x: str, c: int) -> str:
    return f"CAST(CAST({x} AS HUGEINT) * {c} % {_WORD} AS BIGINT)"


def _rotl(x: str, r: int) -> str:
    return f"((({x} << {r}) & {_WORD - 1}) | ({x} >> {32 - r}))"


def murmur3_slots(keys: str, slots: int, seed: int = 42) -> str:
    """A table (k, slot) for the table ``keys(k)`` of ASCII texts: murmur3 of the text's bytes as
    a signed number, modulo ``slots``. Each step of the hash is one subquery."""
    mixed = _mul(_rotl(_mul("w", _C1), 15), _C2)
    step = f"({_mul(_rotl(f'xor(a, {mixed})', 13), 5)} + {_ADD}) % {_WORD}"
    tail = " + ".join(f"coalesce(b[4 * n + {i + 1}], 0) * {1 << 8 * i}" for i in range(3))
    tailed = mixed.replace("w", "t")
    return f"""
(SELECT k, CAST(((CASE WHEN h >= {_WORD // 2} THEN h - {_WORD} ELSE h END) % {slots} + {slots})
        % {slots} AS INTEGER) AS slot
 FROM (SELECT k, xor(f2, f2 >> 16) AS h
 FROM (SELECT k, {_mul('xor(f1, f1 >> 13)', _F2)} AS f2
 FROM (SELECT k, {_mul('xor(f0, f0 >> 16)', _F1)} AS f1
 FROM (SELECT k, xor(xor(a, {tailed}), len(b)) AS f0
 FROM (SELECT k, b, n, {tail} AS t, list_reduce(list_prepend({seed}::BIGINT, blocks), lambda a, w: {step}) AS a
 FROM (SELECT k, b, n, list_transform(range(0, n), lambda i: b[4 * i + 1] + b[4 * i + 2] * 256
              + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216) AS blocks
 FROM (SELECT k, b, len(b) // 4 AS n
 FROM (SELECT k, list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT)) AS b
       FROM {keys}) s0) s1) s2) s3) s4) s5) s6) s7)"""
