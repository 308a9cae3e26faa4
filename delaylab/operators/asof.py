"""As-of join: to every row the last (or first following, or nearest) row of another table by time.

Both tables are put together and range-partitioned by key and time once; inside a partition the
last row of the other table seen so far is a running aggregate, and what a partition has not seen
is the last one of the partitions before, taken from a table of one row per partition and key. No
row of one table meets more than the rows it takes: a calendar of any number of dates costs one sort.
Rows of one instant may be split over several partitions, so a crowded day is not one task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._util import as_list
from ._plan import materialize, null_safe_join

DIRECTIONS = ("backward", "forward", "nearest")


def _one_side(ranged: DataFrame, by: list[str], ahead: bool) -> DataFrame:
    """``ranged`` with ``_found``: the payload of the nearest event at or before (``ahead``: at or
    after) each row."""
    turn = (lambda c: F.col(c).desc()) if ahead else (lambda c: F.col(c).asc())
    # at one instant events come first in either direction
    order = [turn("_t"), F.col("_event").desc(), F.col("_salt").asc()]
    inside = (Window.partitionBy("_pid", *by).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = F.min_by if ahead else F.max_by
    lasts = ranged.groupBy("_pid", *by).agg(
        edge("_payload", F.when(F.col("_event") == 1, F.struct("_t", "_salt"))).alias("_edge"))
    before = (Window.partitionBy(*by).orderBy(turn("_pid"))
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = lasts.select("_pid", *by,
                           F.last("_edge", ignorenulls=True).over(before).alias("_carry"))
    if not by:
        carried = F.broadcast(carried)  # a row per partition
    seen = ranged.withColumn("_here", F.last("_payload", ignorenulls=True).over(inside))
    return (null_safe_join(seen, carried, ["_pid", *by], "left")
            .withColumn("_found", F.coalesce("_here", "_carry")).drop("_here", "_carry"))


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by=None,
              direction: str = "backward", suffix: str = "_event",
              num_partitions: int | None = None) -> DataFrame:
    """``left`` with the columns of one row of ``right`` each (those of ``by`` aside; a column whose
    name ``left`` has gets ``suffix``): the last with ``right_on`` <= ``left_on``
    (``backward``), the first with ``right_on`` >= ``left_on`` (``forward``), or the nearer of both
    (``nearest``; at equal distance the earlier).

    Rows match within equal ``by``; a NULL time or key matches nothing, and a row without a match
    has NULLs. Of events at one instant one is taken, the same on every layout. Empty tables give
    an empty or an unmatched result; repeated rows are kept."""
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {', '.join(DIRECTIONS)}")
    by, spark = as_list(by), left.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = {c: c + suffix if c in left.columns else c for c in right.columns if c not in by}
    if set(names.values()) & set(left.columns) or len(set(names.values())) < len(names):
        raise ValueError("suffix does not keep the columns of the two tables apart")
    keys = {f"_k{i}": c for i, c in enumerate(by)}
    row = F.struct(*[left[c] for c in left.columns])
    payload = F.struct(*[right[c].alias(n) for c, n in names.items()])
    rows = left.select(row.alias("_row"), left[left_on].alias("_t"),
                       *[left[c].alias(k) for k, c in keys.items()], F.lit(0).alias("_event"))
    events = right.select(payload.alias("_payload"), right[right_on].alias("_t"),
                          *[right[c].alias(k) for k, c in keys.items()],
                          F.lit(1).alias("_event"))
    for c in ("_t", *keys):
        events = events.where(F.col(c).isNotNull())
    both = rows.unionByName(events, allowMissingColumns=True).withColumn(
        "_salt", F.coalesce(F.xxhash64("_payload"), F.xxhash64("_row")))
    # the layout is fixed before partitions are numbered
    ranged = materialize(both.repartitionByRange(parts, *keys, "_t", F.desc("_event"), "_salt")
                         .withColumn("_pid", F.spark_partition_id()))
    if direction != "forward":
        ranged = _one_side(ranged, list(keys), False).withColumnRenamed("_found", "_past")
    if direction != "backward":
        ranged = _one_side(ranged, list(keys), True).withColumnRenamed("_found", "_next")
    if direction == "nearest":
        past, coming = (F.col(f"{c}.{names[right_on]}") for c in ("_past", "_next"))
        gap = (lambda a, b: F.unix_micros(a.cast("timestamp")) - F.unix_micros(
            b.cast("timestamp"))) if dict(left.dtypes)[left_on] in (
            "date", "timestamp", "timestamp_ntz") else (lambda a, b: a - b)
        later = F.coalesce(gap(coming, F.col("_t")) < gap(F.col("_t"), past), past.isNull())
        found = F.when(later, F.col("_next")).otherwise(F.col("_past"))
    else:
        found = F.col("_past" if direction == "backward" else "_next")
    known = F.col("_t").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    out = ranged.where("_event = 0").withColumn("_found", F.when(known, found))
    return out.select(*[F.col("_row")[c].alias(c) for c in left.columns],
                      *[F.col("_found")[n].alias(n) for n in names.values()])


def nearest_event_distance(df: DataFrame, date_col: str, events: DataFrame, event_col: str,
                           out: str) -> DataFrame:
    """Add ``out``: days from ``date_col`` to the nearest date of any calendar (of any number of
    dates, across years). NULL date, or no event at all: NULL."""
    dates = events.select(F.col(event_col).cast("date").alias("_event_date")).distinct()
    met = asof_join(df, dates, date_col, "_event_date", direction="nearest")
    return met.withColumn(out, F.abs(F.datediff(date_col, "_event_date")).cast("int")).drop(
        "_event_date")
