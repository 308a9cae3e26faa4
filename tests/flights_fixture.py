"""Seeded synthetic on-time flights CSV with the special rows the operators must handle."""

from __future__ import annotations

import csv
import os
import random

from delaylab.sources.flights import FLIGHT_COLUMNS

CARRIERS = [f"C{i:02d}" for i in range(20)]
AIRPORTS = ["ORD", "ATL", "DFW", "LAX", "DEN", "JFK", "SFO", "SEA", "BOS", "MIA", "PHX", "IAH"]


def _row(rng: random.Random, **over) -> dict:
    year = rng.choice([2006, 2007, 2008])
    month = rng.randint(1, 12)
    day = rng.randint(1, 28)
    dep = rng.randint(5, 23) * 100 + rng.randint(0, 59)
    crs_dep = dep
    dep_delay = rng.randint(-10, 60)
    taxi_out = rng.randint(5, 40)
    arr_delay = dep_delay + taxi_out - 15 + rng.randint(-3, 3)
    origin, dest = rng.sample(AIRPORTS, 2)
    r = {
        "Year": str(year), "Month": str(month), "DayofMonth": str(day),
        "DayOfWeek": str(rng.randint(1, 7)), "DepTime": str(dep), "CRSDepTime": str(crs_dep),
        "ArrTime": str((dep + 200) % 2400), "CRSArrTime": str((crs_dep + 200) % 2400),
        "UniqueCarrier": rng.choice(CARRIERS), "FlightNum": str(rng.randint(1, 300)),
        "TailNum": f"N{rng.randint(100, 400)}", "ActualElapsedTime": str(rng.randint(60, 300)),
        "CRSElapsedTime": str(rng.randint(60, 300)), "AirTime": str(rng.randint(40, 280)),
        "ArrDelay": str(arr_delay), "DepDelay": str(dep_delay), "Origin": origin, "Dest": dest,
        "Distance": str(rng.randint(100, 2500)), "TaxiIn": str(rng.randint(2, 20)),
        "TaxiOut": str(taxi_out), "Cancelled": "0", "CancellationCode": "", "Diverted": "0",
        "CarrierDelay": "NA", "WeatherDelay": "NA", "NASDelay": "NA", "SecurityDelay": "NA",
        "LateAircraftDelay": "NA",
    }
    r.update(over)
    return r


def flight_rows(n: int = 1500, seed: int = 7) -> list[dict]:
    rng = random.Random(seed)
    rows = [_row(rng) for _ in range(n)]
    # cancelled flights, one per code: times and delays missing
    for code in "ABCD":
        rows.append(_row(rng, Cancelled="1", CancellationCode=code, DepTime="NA", ArrTime="NA",
                         ArrDelay="NA", DepDelay="NA", Year="2007", Month="3", DayofMonth="5",
                         Origin="ORD"))
    rows.append(_row(rng, Diverted="1", ArrDelay="NA"))  # diverted
    rows.append(_row(rng, CRSElapsedTime="NA"))  # NA in a cast column with a valid delay
    rows.append(_row(rng, TaxiOut="NA"))
    for tm in ("0", "5", "59", "2359", "2400", "12345", "x"):
        rows.append(_row(rng, DepTime=tm))
    rows.append(_row(rng, Year="2007", Month="2", DayofMonth="30"))  # invalid date
    rows.append(_row(rng, ArrDelay="300"))  # above 175
    rows.append(_row(rng, Origin="ORD", Dest="ORD"))
    dup = _row(rng)
    rows += [dup, dict(dup)]  # duplicate rows
    return rows


def write_flights_csv(folder: str, rows=None, malformed: bool = True) -> str:
    rows = rows if rows is not None else flight_rows()
    path = os.path.join(folder, "flights.csv")
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(FLIGHT_COLUMNS)
        for r in rows:
            w.writerow([r[c] for c in FLIGHT_COLUMNS])
        if malformed:
            fh.write("2007,1,1,1,900\n")  # short row
            fh.write(",".join(["2007"] * (len(FLIGHT_COLUMNS) + 2)) + "\n")  # long row
    return path
