"""Per-group counts attached to every row (the reference's unordered count windows).

``add_group_aggregates`` computes the counts with a partial (map-side) aggregation, so a hot
key such as a hub airport on a busy day collapses to one row per task before any shuffle, then
joins the per-key table back. The per-key table is bounded by the number of (day, airport)
pairs, is measured, and is broadcast when small: the large table is then never shuffled.
``method="window"`` gives the plain ``count(...) OVER (PARTITION BY ...)`` plan for comparison;
it shuffles and sorts the whole table and puts each group into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._plan import MAX_BROADCAST_BYTES, attach_small

# The day keys of the flight table and the cancellation codes
# (A carrier, B weather, C NAS, D security) with the reference's output names.
DAY_KEYS = ("Year", "Month", "DayofMonth")
CANCELLATION_CODES = {
    "A": "NrOfCancelledCarrier",
    "B": "NrOfCancelledWeather",
    "C": "NrOfCancelledNAS",
    "D": "NrOfCancelledSecurity",
}


def add_group_aggregates(df: DataFrame, keys, aggs: dict[str, Column], method: str = "join",
                         max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Add ``{name: aggregate}`` computed over the rows sharing ``keys`` (NULL is a key value)."""
    keys = list(keys)
    if method == "window":
        w = Window.partitionBy(*keys)
        return df.withColumns({name: agg.over(w) for name, agg in aggs.items()})
    per_key = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return attach_small(df, per_key, keys, "left", max_broadcast_bytes)


def add_group_count(df: DataFrame, keys, counted: str, out: str, method: str = "join",
                    **kw) -> DataFrame:
    """``out`` = number of non-NULL ``counted`` values among rows with the same ``keys``
    (WIN1: departures per day and origin; WIN2: arrivals per day and destination)."""
    return add_group_aggregates(df, keys, {out: F.count(counted)}, method, **kw)


def add_cancellation_counts(df: DataFrame, keys=(*DAY_KEYS, "Origin"),
                            code_col: str = "CancellationCode", codes=None,
                            count_nonnull: bool = False, method: str = "join", **kw) -> DataFrame:
    """Cancellations per day and origin, one column per reason code.

    Default: ``count_if(code = x)`` per (day, origin). ``count_nonnull=True`` reproduces the
    reference's expression ``count(code = x) OVER (PARTITION BY day, origin, code)``, which
    counts rows whose comparison is non-NULL, true or false, so all four columns are equal.
    """
    codes = codes or CANCELLATION_CODES
    if count_nonnull:
        aggs = {name: F.count(F.col(code_col) == F.lit(code)) for code, name in codes.items()}
        return add_group_aggregates(df, [*keys, code_col], aggs, method, **kw)
    aggs = {name: F.count_if(F.col(code_col) == F.lit(code)) for code, name in codes.items()}
    return add_group_aggregates(df, list(keys), aggs, method, **kw)
