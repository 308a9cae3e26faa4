"""Feature stages: the two custom transformers (hhmm split, holiday distance), indexers,
hashing, one-hot, assembly, and the flight preparation chain.

The custom transformers are ordinary PySpark ``Transformer`` classes whose ``_transform`` adds
native column expressions, so they stay inside whole-stage codegen and are saved and loaded
with the pipeline (``DefaultParamsWritable``).
"""

from __future__ import annotations

from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import (FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler,
                                VectorIndexer)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.encode import (DAY_OF_MONTH_PERIOD, DAY_OF_WEEK_PERIOD, MONTH_PERIOD,
                                cyclic_sin, flight_date, hhmm_hours, hhmm_minutes)
from ..functions.holidays import holiday_distance
from ..operators import clean, windows
from ..operators._plan import attach_small, materialize

_TIME_TYPES = (T.StringType, T.IntegerType, T.LongType, T.ShortType)


class TimeSplitter(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``<in>_Hours`` and ``<in>_Minutes``: sine encodings of an unpadded ``hhmm`` column.
    Invalid clock values give NULL (no task failure)."""

    @keyword_only
    def __init__(self, inputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def setInputCol(self, value: str) -> "TimeSplitter":
        return self._set(inputCol=value)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.getInputCol()
        dtype = df.schema[c].dataType
        if not isinstance(dtype, _TIME_TYPES):
            raise TypeError(f"{c}: expected a string or integer hhmm column, got {dtype}")
        return df.withColumns({f"{c}_Hours": hhmm_hours(c), f"{c}_Minutes": hhmm_minutes(c)})


class HolidayDistance(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable,
                      DefaultParamsWritable):
    """Days from a DATE column to the nearest of the ten federal holidays (INT, NULL-safe)."""

    spanYears = Param(Params._dummy(), "spanYears",
                      "also count the neighbouring years' holidays", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None,
                 spanYears: bool = False):
        super().__init__()
        self._setDefault(spanYears=False)
        self._set(**self._input_kwargs)

    def setInputCol(self, value: str) -> "HolidayDistance":
        return self._set(inputCol=value)

    def setOutputCol(self, value: str) -> "HolidayDistance":
        return self._set(outputCol=value)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.getInputCol()
        dtype = df.schema[c].dataType
        if not isinstance(dtype, T.DateType):
            raise TypeError(f"{c}: expected DateType, got {dtype}")
        return df.withColumn(self.getOutputCol(),
                             holiday_distance(c, self.getOrDefault(self.spanYears)))


# The reference's feature column names and feature sets.
TIME_COLUMNS = ("DepTime", "CRSDepTime", "CRSArrTime")
NOMINAL_COLUMNS = ("UniqueCarrier", "FlightNum", "TailNum", "Origin", "Dest")
BASE_FEATURES = (
    "Year_Int", "Month_sin", "DayofMonth_sin", "DayOfWeek_sin",
    "DepTime_Hours", "DepTime_Minutes", "CRSDepTime_Hours", "CRSDepTime_Minutes",
    "CRSArrTime_Hours", "CRSArrTime_Minutes",
    "CRSElapsedTime_Int", "DepDelay_Int", "Distance_Int", "TaxiOut_Int",
)
NOMINAL_INDEXES = tuple(f"{c}_Index" for c in NOMINAL_COLUMNS)
COUNT_COLUMNS = ("NrOfArrivals", "NrOfDepartures", "NrOfCancelledNAS", "NrOfCancelledSecurity",
                 "NrOfCancelledCarrier", "NrOfCancelledWeather")
FEATURE_SETS = {
    "indexed": BASE_FEATURES + ("DistanceToHoliday",) + NOMINAL_INDEXES,
    "hashed": BASE_FEATURES + ("NominalHashed",),
    "holiday": BASE_FEATURES + ("DistanceToHoliday",),
    "windowed": ("Month_sin", "DayofMonth_sin", "DayOfWeek_sin", "DepTime_Hours",
                 "CRSElapsedTime_Int", "DepDelay_Int", "TaxiOut_Int", "DistanceToHoliday",
                 "NrOfArrivals", "NrOfDepartures"),
    "counts": BASE_FEATURES + NOMINAL_INDEXES + ("NrOfDepartures",),
    "cancellations": (
        "Year_Int", "Month_sin", "DayofMonth_sin", "DayOfWeek_sin", "DepTime_Hours",
        "DepTime_Minutes", "CRSDepTime_Hours", "CRSDepTime_Minutes", "CRSArrTime_Hours",
        "CRSArrTime_Minutes", "CRSElapsedTime_Int", "DepDelay_Int", "TaxiOut_Int",
        "DistanceToHoliday", "UniqueCarrier_Index", "Origin_Index", "Dest_Index",
        "NrOfArrivals", "NrOfDepartures", "NrOfCancelledNAS", "NrOfCancelledSecurity",
        "NrOfCancelledCarrier", "NrOfCancelledWeather"),
}
LABEL = "ArrDelay_Int"


def string_indexer(cols, handle_invalid: str = "keep", suffix: str = "_Index") -> StringIndexer:
    """One multi-column indexer, labels by descending frequency (ties alphabetical)."""
    cols = list(cols)
    return StringIndexer(inputCols=cols, outputCols=[c + suffix for c in cols],
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def feature_hasher(cols, num_features: int = 2000, out: str = "NominalHashed") -> FeatureHasher:
    return FeatureHasher(inputCols=list(cols), outputCol=out, numFeatures=num_features,
                         categoricalCols=list(cols))


def sparse_entries(col: str) -> Column:
    """``slot:value`` of every entry of a vector that is not zero, joined by commas (whole values,
    for inspection of a few distinct vectors)."""
    cells = F.transform(vector_to_array(col), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    used = F.filter(cells, lambda e: e["x"] != 0)
    return F.array_join(F.transform(used, lambda e: F.concat(
        e["i"].cast("string"), F.lit(":"), e["x"].cast("int").cast("string"))), ",")


def suggest_hash_sizes(df: DataFrame, cols, square_up_to: int = 1000, factor: int = 20,
                       exact: bool = True) -> DataFrame:
    """Cardinality of each column and a hash-space size: the square for small domains,
    ``factor`` x cardinality for large ones. (``column``, ``cardinality``, ``num_features``).
    Exact counts are one distinct aggregation per column (several distinct counts in one
    aggregate would multiply every row by their number); ``exact=False`` uses mergeable sketches
    in a single pass, enough for sizing a hash space."""
    cols = list(cols)
    if exact:
        sized = reduce(DataFrame.unionByName, [
            df.select(c).where(F.col(c).isNotNull()).distinct().agg(
                F.count(F.lit(1)).alias("cardinality"))
            .select(F.lit(c).alias("column"), "cardinality") for c in cols])
    else:
        wide = df.agg(*[F.approx_count_distinct(c, 0.01).alias(f"c{i}")
                        for i, c in enumerate(cols)])
        sized = wide.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("cardinality"))
            for i, c in enumerate(cols)])))
    card = F.col("cardinality")
    return sized.withColumn(
        "num_features", F.when(card <= square_up_to, card * card).otherwise(card * factor))


def one_hot(cols, suffix: str = "_Vec", drop_last: bool = True) -> OneHotEncoder:
    cols = list(cols)
    return OneHotEncoder(inputCols=cols, outputCols=[c + suffix for c in cols],
                         dropLast=drop_last, handleInvalid="keep")


def assemble(cols, out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """``handle_invalid``: ``error`` (fail on NULL), ``keep`` (NaN), ``skip`` (drop the row; no
    pipeline or job of this library uses it)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def vector_indexer(col: str, out: str, max_categories: int = 2) -> VectorIndexer:
    return VectorIndexer(inputCol=col, outputCol=out, maxCategories=max_categories,
                         handleInvalid="keep")


def add_day_counts(df: DataFrame) -> DataFrame:
    """Per (day, origin): departures among the flights that pass the sentinel filter and
    cancellations per reason among all flights (the filter removes cancelled ones, so they must
    be counted first); per (day, destination): arrivals. One aggregation over the raw scan holds
    both groupings; the two per-key tables are attached with a measured broadcast."""
    keep = clean.sentinel_condition(clean.REQUIRED_COLUMNS)
    aggs = [F.count_if(keep & F.col("Origin").isNotNull()).alias("NrOfDepartures"),
            F.count_if(keep & F.col("Dest").isNotNull()).alias("NrOfArrivals")]
    names = ["NrOfDepartures"]
    if "CancellationCode" in df.columns:
        for code, name in windows.CANCELLATION_CODES.items():
            aggs.append(F.count_if(F.col("CancellationCode") == F.lit(code)).alias(name))
            names.append(name)
    day = list(windows.DAY_KEYS)
    both = materialize(
        df.groupingSets([[*day, "Origin"], [*day, "Dest"]], *day, "Origin", "Dest")
        .agg(*aggs, F.grouping("Dest").alias("_by_origin")))
    out = attach_small(df, both.where("_by_origin = 1").select(*day, "Origin", *names),
                       [*day, "Origin"])
    return attach_small(out, both.where("_by_origin = 0").select(*day, "Dest", "NrOfArrivals"),
                        [*day, "Dest"])


def prepare_flights(df: DataFrame, with_windows: bool = True) -> DataFrame:
    """Raw flight strings -> typed feature columns: leakage columns dropped, per-day counts
    (``add_day_counts``) attached if asked for, then the sentinel filter, integer casts, cyclic
    encodings and the date."""
    out = clean.drop_leakage(df)
    if with_windows:
        out = add_day_counts(out)
    out = clean.drop_na_sentinel(out)
    out = clean.add_int_columns(out, ["Year", "CRSElapsedTime", "DepDelay", "Distance",
                                      "TaxiOut", "ArrDelay"])
    return out.withColumns({
        "Month_sin": cyclic_sin(F.col("Month").try_cast("int"), MONTH_PERIOD),
        "DayofMonth_sin": cyclic_sin(F.col("DayofMonth").try_cast("int"), DAY_OF_MONTH_PERIOD),
        "DayOfWeek_sin": cyclic_sin(F.col("DayOfWeek").try_cast("int"), DAY_OF_WEEK_PERIOD),
        "Date": flight_date("Year", "Month", "DayofMonth"),
    })


def row_wise_stages(cols) -> list:
    """The custom transformers that the feature columns ``cols`` need."""
    stages: list = [TimeSplitter(inputCol=c) for c in TIME_COLUMNS
                    if any(f.startswith(c + "_") for f in cols)]
    if "DistanceToHoliday" in cols:
        stages.append(HolidayDistance(inputCol="Date", outputCol="DistanceToHoliday"))
    return stages


def nominal_columns(cols) -> list[str]:
    """Nominal source columns behind the feature columns ``cols``."""
    if "NominalHashed" in cols:
        return list(NOMINAL_COLUMNS)
    return [c for c in NOMINAL_COLUMNS if f"{c}_Index" in cols]


def nominal_stages(cols, num_hash_features: int = 2000) -> list:
    """Indexer or hasher for the nominal features among ``cols``."""
    names = nominal_columns(cols)
    if "NominalHashed" in cols:
        return [feature_hasher(names, num_hash_features)]
    return [string_indexer(names, "keep")] if names else []


def feature_stages(feature_set: str = "indexed", num_hash_features: int = 2000) -> list:
    """Only the stages the chosen feature set needs, from prepared flights to ``features``."""
    cols = FEATURE_SETS[feature_set]
    return [*row_wise_stages(cols), *nominal_stages(cols, num_hash_features), assemble(cols)]


def build_pipeline(feature_set: str = "indexed", estimator=None, **kw) -> Pipeline:
    """Feature stages (+ an estimator) as one MLlib ``Pipeline``: fit on the training split
    only, so test rows never shape the indexes."""
    stages = feature_stages(feature_set, **kw)
    if estimator is not None:
        stages.append(estimator)
    return Pipeline(stages=stages)
