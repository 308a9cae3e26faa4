"""What tuning and the training table do once, whatever the grid: leading stages, generated code, and
rows of equal features."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.ml.tuning import CrossValidator, TrainValidationSplit
from pyspark.sql import functions as F

from delaylab.ml import features, jobs, models, tuning
from delaylab.operators import sampling
from delaylab.operators._plan import COMPILED_METHOD_BYTES

LABEL, LIMIT = "y", "spark.sql.codegen.hugeMethodLimit"


def rows(spark, n=900):
    return spark.range(n, numPartitions=3).select(
        "id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 4).cast("string").alias("s"),
        (2.0 * (F.col("id") % 7) + (F.col("id") % 4) * (F.col("id") % 3)
         + (F.col("id") * 7919) % 13).alias(LABEL))


def pipeline(est):
    return Pipeline(stages=[features.string_indexer(["s"], "keep"),
                            features.assemble(["x", "s_Index"]), est])


def test_leading_stages_are_fitted_once_a_fold_with_sparks_results(spark, monkeypatch):
    data = rows(spark).persist()
    lr = models.linear(label=LABEL)
    grid = tuning.param_grid(lr, {"regParam": [0.0, 0.5], "elasticNetParam": [0.0, 0.8]})
    ev = tuning.evaluator(LABEL)
    cv = CrossValidator(estimator=pipeline(lr), estimatorParamMaps=grid, evaluator=ev, numFolds=3,
                        seed=42).fit(data)
    tvs = TrainValidationSplit(estimator=pipeline(lr), estimatorParamMaps=grid, evaluator=ev,
                               trainRatio=0.75, seed=42).fit(data)
    fits, fit = [], StringIndexer._fit
    monkeypatch.setattr(StringIndexer, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    found, best, _ = tuning.cross_validate(pipeline(lr), grid, data, LABEL, parallelism=2)
    assert len(fits) == 3 + 1
    found = sorted(found.collect())
    assert [r["mean_rmse"] for r in found] == pytest.approx(cv.avgMetrics, rel=1e-9)
    assert [r["std_rmse"] for r in found] == pytest.approx(cv.stdMetrics, rel=1e-6)
    assert best.stages[-1].coefficients.toArray() == pytest.approx(
        cv.bestModel.stages[-1].coefficients.toArray(), rel=1e-9)
    fits.clear()
    found, best, _ = tuning.train_validation(pipeline(lr), grid, data, LABEL)
    assert len(fits) == 1 + 1
    assert [r["rmse"] for r in sorted(found.collect())] == pytest.approx(tvs.validationMetrics,
                                                                         rel=1e-9)
    assert best.transform(data).count() == 900


def test_a_grid_over_a_leading_stage_fits_it_for_every_point(spark):
    est = pipeline(models.linear(label=LABEL))
    indexer = est.getStages()[0]
    assert tuning.split_head(est, tuning.param_grid(indexer, {"handleInvalid": ["keep", "skip"]})
                             ) == ([], est)


def test_bad_fold_numbers_are_errors(spark):
    data = features.assemble(["x"]).transform(rows(spark, 60))
    lr = models.linear(label=LABEL)
    grid = tuning.param_grid(lr, {"regParam": [0.0]})
    for bad in (F.col("id") % 4, F.when(F.col("id") > 3, F.col("id") % 3), F.col("id") % 2):
        with pytest.raises(ValueError):
            tuning.cross_validate(lr, grid, data.withColumn("f", bad.cast("int")), LABEL, fold_col="f")


def test_boosted_trees_on_weighted_rows_are_those_on_all_rows(spark):
    data = Pipeline(stages=pipeline(None).getStages()[:2]).fit(rows(spark)).transform(rows(spark))
    est = models.gbt(label=LABEL, max_iter=5, max_depth=3)
    grid = tuning.param_grid(est, {"stepSize": [0.1]})
    with tuning.weighted_rows(est, grid, data) as (light, few):
        assert few.count() == 28 and few.agg(F.sum(tuning.ROWS)).first()[0] == 900.0
        model = light.fit(few, grid[0])
    full = est.fit(data, grid[0]).transform(data).select("id", F.col("prediction").alias("full"))
    off = model.transform(data).join(full, "id").agg(F.max(F.abs(F.col("prediction") - F.col("full"))))
    assert off.first()[0] < 1e-9
    # rows that differ, and estimators that read each row, keep all rows
    apart = features.assemble(["id"]).transform(rows(spark))
    for other, df in ((est, apart), (models.forest(label=LABEL), data),
                      (models.gbt(label=LABEL, subsamplingRate=0.5), data),
                      (models.gbt(label=LABEL, minInstancesPerNode=2), data)):
        with tuning.weighted_rows(other, [{}], df) as (same, all_rows):
            assert same is other and all_rows is df


def test_a_missing_label_is_an_error_on_weighted_rows_too(spark):
    data = rows(spark).withColumn(LABEL, F.when(F.col("id") != 5, F.col(LABEL)))
    data = features.assemble(["x"]).transform(data)
    est = models.gbt(label=LABEL, max_iter=1, max_depth=2)
    for fit in (lambda: est.fit(data), lambda: tuning.train_validation(
            Pipeline(stages=pipeline(est).getStages()), tuning.param_grid(est, {"stepSize": [0.1]}),
            data.drop("features"), LABEL)):
        with pytest.raises(Exception):
            fit()


def test_large_fits_run_one_at_a_time(spark, monkeypatch):
    data = rows(spark, 100)
    assert tuning.fits_at_once(data, 4) == 4
    monkeypatch.setattr(tuning, "ROWS_AT_ONCE", 250)
    assert tuning.fits_at_once(data, 4) == 2
    monkeypatch.setattr(tuning, "ROWS_AT_ONCE", 50)
    assert tuning.fits_at_once(data, 4) == 1


def test_training_table_is_built_by_compiled_code(spark, flights, monkeypatch):
    before, seen, spread = spark.conf.get(LIMIT), [], jobs.spread
    monkeypatch.setattr(jobs, "spread", lambda df, n: seen.append(spark.conf.get(LIMIT))
                        or spread(df, n))
    with jobs.training_table(flights, features.FEATURE_SETS["holiday"], missing="impute"):
        assert spark.conf.get(LIMIT) == before
    assert seen == [str(COMPILED_METHOD_BYTES)]


def test_chunks_evaluate_the_hash_once_a_row(spark):
    keys = spark.range(3000).withColumn("k", F.col("id") * 7919)
    chunked = sampling.disjoint_chunks(keys, ["id", "k"], n=6, fraction=0.1)
    width, h = sampling.hash_bound(0.1), sampling.hash_unit(["id", "k"], 42)
    wrong = chunked.where((h < F.col("chunk") * F.lit(width))
                          | (h >= (F.col("chunk") + 1) * F.lit(width))).count()
    assert wrong == 0 and chunked.count() == keys.where(h < F.lit(6 * width)).count()
    tagged = sampling.disjoint_chunks(keys, ["id", "k"], n=6, fraction=0.1, keep_unassigned=True)
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and dict(tagged.dtypes)["chunk"] == "int"


def test_forest_chunks_of_fewer_rows_than_labels(flights):
    """A chunk of a twentieth has fewer rows than there are flight numbers."""
    found = jobs.forest_chunks_job(flights, {"numTrees": [2], "maxDepth": [3]}, fraction=0.05,
                                   missing="impute", parallelism=2).first()
    assert found["n_chunks"] == 5 and found["n"] > 0


def test_trees_of_fits_side_by_side_have_bounded_leaves(spark, monkeypatch):
    data = features.assemble(["x"]).transform(rows(spark, 600)).persist()
    rf = models.forest(label=LABEL)
    grid = tuning.param_grid(rf, {"numTrees": [2, 30], "maxDepth": [3, 30]})
    assert tuning.most_leaves(rf, grid, 600) == 30 * 600
    assert tuning.most_leaves(rf, grid[:1], 600) == 2 * 8
    assert tuning.most_leaves(models.linear(label=LABEL), [{}], 600) == 0
    assert tuning.fits_at_once(data, 4, rf, grid) == 4
    monkeypatch.setattr(tuning, "LEAVES_AT_ONCE", 2 * 30 * 600)
    assert tuning.fits_at_once(data, 4, rf, grid) == 2
    monkeypatch.setattr(tuning, "LEAVES_AT_ONCE", 1)
    assert tuning.fits_at_once(data, 4, rf, grid) == 1


def test_keeping_nodes_grows_the_same_deep_trees(spark):
    data = features.assemble(["x", "id"]).transform(rows(spark, 600)).persist()
    keep = jobs.deep_trees(spark, 30)
    assert keep == {"cacheNodeIds": True} and jobs.deep_trees(spark, 10) == {}
    for make in (lambda **kw: models.gbt(label=LABEL, max_iter=3, max_depth=30, **kw),
                 lambda **kw: models.forest(label=LABEL, num_trees=3, max_depth=30, **kw)):
        plain, kept = (make(**kw).fit(data) for kw in ({}, keep))
        strip = lambda m: m.toDebugString.split("\n", 1)[1]  # noqa: E731  (the first line is the uid)
        assert strip(kept) == strip(plain)
