"""Regressors (MLlib) with the reference's settings made valid for Spark's limits."""

from __future__ import annotations

from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TREE_DEPTH = 30  # Spark rejects deeper trees


def _depth(d: int) -> int:
    if d > MAX_TREE_DEPTH:
        raise ValueError(f"maxDepth {d} is above Spark's limit of {MAX_TREE_DEPTH}")
    return d


def max_bins_for(df: DataFrame, cols, minimum: int = 32) -> int:
    """``maxBins`` must exceed the largest category count (+1 for the ``keep`` bucket); one
    distinct aggregation per column. With a fitted indexer use ``max_bins_of`` (no scan)."""
    sizes = [df.select(c).where(F.col(c).isNotNull()).distinct().count() for c in cols]
    return max([minimum, *[n + 1 for n in sizes]])


def max_bins_of(indexer, minimum: int = 32) -> int:
    """``maxBins`` from the numbers of labels of a fitted multi-column indexer."""
    sizes = getattr(indexer, "sizes", None)
    if sizes is None:
        sizes = [len(labels) for labels in indexer.labelsArray]
    return max([minimum, *[n + 1 for n in sizes]])


def linear(features: str = "features", label: str = "ArrDelay_Int", max_iter: int = 10,
           reg_param: float = 0.0, elastic_net: float = 0.8, **kw) -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=reg_param, elasticNetParam=elastic_net, **kw)


def tree(features="features", label="ArrDelay_Int", max_depth=5, max_bins=32, seed=42, **kw):
    return DecisionTreeRegressor(featuresCol=features, labelCol=label, maxDepth=_depth(max_depth),
                                 maxBins=max_bins, seed=seed, **kw)


def forest(features="features", label="ArrDelay_Int", num_trees=20, max_depth=5, max_bins=32,
           seed=42, **kw):
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees,
                                 maxDepth=_depth(max_depth), maxBins=max_bins, seed=seed, **kw)


def gbt(features="features", label="ArrDelay_Int", max_iter=20, max_depth=5, max_bins=32,
        step_size=0.1, seed=42, **kw):
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter,
                        maxDepth=_depth(max_depth), maxBins=max_bins, stepSize=step_size,
                        seed=seed, **kw)


def fit(estimator, df: DataFrame, params=None):
    return estimator.fit(df, params) if params is not None else estimator.fit(df)


def predict(model, df: DataFrame) -> DataFrame:
    """Score a table (``prediction`` column added)."""
    return model.transform(df)
