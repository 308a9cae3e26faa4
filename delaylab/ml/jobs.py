"""End-to-end training jobs over a raw flight table (all-string columns as read from CSV).

Each job is the same chain: ``prepare_flights`` (leakage dropped, per-day loads counted if the
feature set uses them, sentinels filtered, casts, encodings), the row-wise transformers, and a
reproducible hash split on the flight's identity. The result, pruned to the label, the numeric
features and the nominal columns of the feature set, is persisted once: no later pass evaluates a
row-wise expression again. Indexers are fitted on the training split only, then the estimator, and
the metrics come from the test split. Each job returns ``(metrics DataFrame, fitted model)``.

Missing feature values never remove a row: ``missing="error"`` (the default) fails on them,
``missing="impute"`` fills the training split's mean and adds the number of filled values as one
more feature (``NrOfMissing``).
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sampling
from ..operators._plan import compiled_methods, spread
from ..session import ensure_checkpoint_dir
from . import deep, evaluate, features, models, tuning
from .nominal import frequency_indexer

# The columns that identify one flight (the split key), and the reference's grids.
FLIGHT_KEY = ("Year", "Month", "DayofMonth", "UniqueCarrier", "FlightNum", "Origin", "CRSDepTime")
GBT_GRID = {"stepSize": [0.1, 0.01], "maxDepth": [5, 7]}
LINEAR_GRID = {"regParam": [0.1, 0.01], "fitIntercept": [True, False],
               "elasticNetParam": [0.0, 1.0]}
#: Depths 50 and 100 of the reference are beyond what Spark accepts; both become its limit, 30.
FOREST_GRID = {"numTrees": [10, 20, 30], "maxDepth": [10, models.MAX_TREE_DEPTH]}
MISSING = "NrOfMissing"
#: Depth from which on a fit keeps the node of every row.
DEEP = 11


class TrainingTable:
    """The persisted table of a job: ``columns`` are the features to assemble."""

    def __init__(self, data: DataFrame, columns: list[str]):
        self.data, self.columns = data, columns
        self.train = data.where(F.col("split") == 0)
        self.test = data.where(F.col("split") == 1)


@contextmanager
def training_table(flights: DataFrame, columns, sample: float | None = None, seed: int = 42,
                   weights=(0.7, 0.3), missing: str = "error", partitions: int | None = None,
                   chunks: tuple[int, float] | None = None):
    """Prepare, split and persist the ``columns`` of a feature set; released afterwards. With
    ``sample`` only that fraction is kept (after the per-day counts, which see every flight);
    ``chunks = (n, fraction)`` adds a disjoint ``chunk`` number; ``partitions`` deals the rows
    over so many tasks (for an input of few splits)."""
    if missing not in ("error", "impute"):
        raise ValueError("missing must be 'error' or 'impute'")
    columns = list(columns)
    counts = any(c in features.COUNT_COLUMNS for c in columns)
    with compiled_methods(flights.sparkSession):
        out = features.prepare_flights(flights, with_windows=counts)
        out = out.where(F.col(features.LABEL).isNotNull())
        for stage in features.row_wise_stages(columns):
            out = stage.transform(out)
        nominal = features.nominal_columns(columns)
        numeric = [c for c in columns if c in out.columns]
        out = sampling.hash_split(out, list(FLIGHT_KEY), weights, seed, "split")
        extra = ["split"]
        if chunks:
            out = sampling.disjoint_chunks(out, list(FLIGHT_KEY), *chunks, keep_unassigned=True)
            extra.append("chunk")
        out = out.select(features.LABEL, *numeric, *nominal, *extra)
        if sample:
            out = sampling.bernoulli_sample(out, sample, seed)
        out = spread(out, partitions).persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
    try:
        if missing == "impute":
            row = out.where("split = 0").agg(*[F.avg(c).alias(c) for c in numeric]).first()
            lost = sum((F.col(c).isNull().cast("int") for c in numeric), F.lit(0))
            filled = out.withColumn(MISSING, lost).withColumns(
                {c: F.coalesce(F.col(c).cast("double"), F.lit(row[c] or 0.0)) for c in numeric})
            yield TrainingTable(filled, [*columns, MISSING])
        else:
            yield TrainingTable(out, columns)
    finally:
        out.unpersist()


def _metrics(scored: DataFrame, seconds: float, job: str, test: DataFrame) -> DataFrame:
    """Test metrics; ``n`` is the rows scored and ``n_test`` the rows in the test split (always
    equal: no row is skipped)."""
    m = evaluate.regression_metrics(scored, "prediction", features.LABEL)
    return m.select(F.lit(job).alias("job"), "*",
                    F.lit(test.count()).cast("long").alias("n_test"),
                    F.lit(float(seconds)).alias("train_seconds"))


def _freeze(df: DataFrame) -> DataFrame:
    """A small result (one row per job or grid point) computed now, while the training table
    is still persisted, and kept as a local table."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def indexed_stages(table: TrainingTable) -> tuple[list, int]:
    """Fitted indexer and assembler of a table's features, and the ``maxBins`` its labels need."""
    nominal = features.nominal_columns(table.columns)
    if not nominal or "NominalHashed" in table.columns:
        return [*features.nominal_stages(table.columns), features.assemble(table.columns)], 32
    indexer = frequency_indexer(nominal, "keep").fit(table.train)
    return [indexer, features.assemble(table.columns)], models.max_bins_of(indexer)


def deep_trees(spark, depth: int) -> dict:
    """Settings of a fit of trees so deep that they have many nodes: each row's node is kept while they
    grow, instead of sending the trees grown so far with every group of nodes. The trees are the
    same. What is kept is cut from its history in the checkpoint folder."""
    if depth < DEEP:
        return {}
    ensure_checkpoint_dir(spark)
    return {"cacheNodeIds": True}


def run_job(table: TrainingTable, stages, job: str = "job"):
    """Fit the stages on the training split, score the test split."""
    t0 = time.perf_counter()
    model = models.fit(Pipeline(stages=list(stages)), table.train)
    seconds = time.perf_counter() - t0
    return _freeze(_metrics(model.transform(table.test), seconds, job, table.test)), model


def tree_run(flights: DataFrame, variant: str = "holiday", max_depth: int = 5,
             max_bins: int | None = None, **kw):
    """Decision-tree experiments: ``hashed`` nominals (2000 slots), ``indexed`` nominals
    through a vector indexer, ``holiday_indexed`` (holiday distance + indexed nominals),
    ``holiday`` (holiday distance, no nominals)."""
    columns = {"holiday_indexed": features.FEATURE_SETS["indexed"],
               "indexed": features.BASE_FEATURES + features.NOMINAL_INDEXES}.get(
        variant) or features.FEATURE_SETS[variant]
    with training_table(flights, columns, **kw) as table:
        stages, bins = indexed_stages(table)
        if variant == "indexed":
            rest = [c for c in table.columns if c not in features.NOMINAL_INDEXES]
            stages = [stages[0], features.assemble(features.NOMINAL_INDEXES, "nominal"),
                      features.vector_indexer("nominal", "nominal_indexed", max_categories=2),
                      features.assemble([*rest, "nominal_indexed"])]
        est = models.tree(max_depth=max_depth, max_bins=max_bins or bins)
        return run_job(table, [*stages, est], f"tree_{variant}")


def boosted_job(flights: DataFrame, max_depth: int = models.MAX_TREE_DEPTH, max_iter: int = 20,
                feature_set: str = "indexed", **kw):
    """Gradient-boosted trees on indexed nominals (``maxBins`` from the indexer's labels)."""
    with training_table(flights, features.FEATURE_SETS[feature_set], **kw) as table:
        stages, bins = indexed_stages(table)
        est = deep.grown(models.gbt(max_depth=max_depth, max_iter=max_iter, max_bins=bins,
                                    **deep_trees(flights.sparkSession, max_depth)))
        return run_job(table, [*stages, est], f"gbt_{feature_set}")


def linear_hashed_job(flights: DataFrame, max_iter: int = 10, reg_param: float = 0.0,
                      elastic_net: float = 0.8, **kw):
    """Linear regression on numeric features + hashed nominals."""
    est = models.linear(max_iter=max_iter, reg_param=reg_param, elastic_net=elastic_net)
    with training_table(flights, features.FEATURE_SETS["hashed"], **kw) as table:
        return run_job(table, [*indexed_stages(table)[0], est], "linear_hashed")


def tuned_job(flights: DataFrame, kind: str = "gbt", grid: dict | None = None,
              feature_set: str | None = None, parallelism: int = 1, **kw):
    """A tuned linear model (23 features with the cancellation counts) or boosted trees (10
    features with the daily loads): train/validation split 0.75 inside the training split, scored
    on the test split. Returns (metrics with the best model's parameters, best model, results,
    report of the best model)."""
    est = models.gbt() if kind == "gbt" else models.linear(max_iter=100, elastic_net=0.0)
    pm = tuning.param_grid(est, grid or (GBT_GRID if kind == "gbt" else LINEAR_GRID))
    name = feature_set or ("windowed" if kind == "gbt" else "cancellations")
    with training_table(flights, features.FEATURE_SETS[name], **kw) as table:
        stages = [*features.nominal_stages(table.columns), features.assemble(table.columns), est]
        results, best, seconds = tuning.train_validation(
            Pipeline(stages=stages), pm, table.train, parallelism=parallelism, persist=False)
        scored = best.transform(table.test)
        stage = tuning.best_stage(best)
        text = tuning.params_text({p: stage.getOrDefault(p.name) for p in pm[0]})
        metrics = _freeze(_metrics(scored, seconds, f"tuned_{kind}", table.test)
                          .withColumn("best_stage", F.lit(type(stage).__name__))
                          .withColumn("best_params", F.lit(text)))
        report = _freeze(evaluate.best_report(stage, scored, features.LABEL))
    return metrics, best, results, report


def forest_chunks_job(flights: DataFrame, grid: dict | None = None, n_chunks: int = 6,
                      fraction: float = 0.001, parallelism: int = 1, **kw):
    """Random forest, every grid point trained on each of five disjoint chunks and scored on
    the sixth; returns the per-grid-point mean / variance / std table with the rows scored."""
    with training_table(flights, features.FEATURE_SETS["indexed"], chunks=(n_chunks, fraction),
                        **kw) as table:
        chunked = table.data.where(F.col("chunk").isNotNull())
        known = TrainingTable(chunked, table.columns)
        known.train = chunked.where(F.col("chunk") < n_chunks - 1)
        (indexer, assembler), _ = indexed_stages(known)
        # Spark has no categorical feature of more values than the rows it is fitted on: such an
        # index is read as a number, the rank of its label
        sizes = [n + 1 for n in indexer.sizes]
        rows = known.train.groupBy("chunk").count().agg(F.min("count")).first()[0] or 0
        indexed = indexer.transform(chunked)
        for name, n in zip(indexer.getOutputCols(), sizes):
            indexed = indexed.withMetadata(name, {}) if n > rows else indexed
        assembled = assembler.transform(indexed).select("features", features.LABEL, "chunk")
        grid = grid or FOREST_GRID
        rf = deep.grown(models.forest(
            max_bins=max([32, *[n for n in sizes if n <= rows]]),
            **deep_trees(flights.sparkSession, max(grid.get("maxDepth", [5])))))
        return _freeze(tuning.chunked_selection(
            rf, tuning.param_grid(rf, grid), assembled, features.LABEL,
            n_train=n_chunks - 1, parallelism=parallelism))


def forest_cv_job(flights: DataFrame, grid: dict | None = None, sample: float | None = None,
                  folds: int = 3, parallelism: int = 1, **kw):
    """Random forest under k-fold cross-validation of indexers and estimator; returns the results
    table (with the rows of the table validated on) and the best model."""
    with training_table(flights, features.FEATURE_SETS["indexed"], sample=sample, **kw) as table:
        bins = models.max_bins_for(table.data, features.nominal_columns(table.columns))
        grid = grid or FOREST_GRID
        rf = deep.grown(models.forest(max_bins=bins, **deep_trees(
            flights.sparkSession, max(grid.get("maxDepth", [5])))))
        pm = tuning.param_grid(rf, grid)
        stages = [*features.nominal_stages(table.columns), features.assemble(table.columns), rf]
        results, best, _ = tuning.cross_validate(Pipeline(stages=stages), pm, table.data,
                                                 folds=folds, parallelism=parallelism,
                                                 persist=False)
        n = table.data.count()
        return _freeze(results.withColumn("n", F.lit(n).cast("long"))), best
