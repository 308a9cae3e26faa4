"""Feature stages, models, evaluation, tuning on the synthetic flights."""

from __future__ import annotations

import math
import os

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from delaylab.ml import evaluate, features, models, tuning
from delaylab.operators import sampling


def test_regression_metrics_golden(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.5, 2.0), (3.0, 5.0), (4.0, 4.5)], "p double, y double")
    m = evaluate.regression_metrics(df, "p", "y").first()
    assert round(m["rmse"], 6) == 1.172604
    assert round(m["r2"], 6) == 0.284553
    assert round(m["var"], 6) == 1.734375
    assert m["mse"] == 1.375 and m["mae"] == 1.0
    from pyspark.ml.evaluation import RegressionEvaluator

    for name in ("rmse", "r2", "var", "mae"):
        ev = RegressionEvaluator(predictionCol="p", labelCol="y", metricName=name)
        assert math.isclose(ev.evaluate(df), m[name], rel_tol=1e-12), name


def test_string_index_golden(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "v string")
    out = features.string_indexer(["v"], "keep").fit(df).transform(df).collect()
    assert {r["v"]: r["v_Index"] for r in out} == {"b": 0.0, "a": 1.0, "c": 2.0, None: 3.0}
    ties = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",)], "v string")
    assert features.string_indexer(["v"], "error").fit(ties).labelsArray[0] == ["a", "b", "c"]


def test_transformer_type_checks(spark):
    df = spark.createDataFrame([(1.5, "2007-01-01")], "t double, d string")
    with pytest.raises(TypeError):
        features.TimeSplitter(inputCol="t").transform(df)
    with pytest.raises(TypeError):
        features.HolidayDistance(inputCol="d", outputCol="h").transform(df)


def test_prepare_flights_and_plan_is_native(flights):
    prepared = features.prepare_flights(flights)
    cols = set(prepared.columns)
    assert {"NrOfDepartures", "NrOfArrivals", "NrOfCancelledNAS", "Month_sin", "Date"} <= cols
    plan = prepared._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "PythonUDF" not in plan
    assert prepared.count() == flights.where(
        (F.col("ArrDelay") != "NA") & (F.col("DepTime") != "NA") & (F.col("CRSDepTime") != "NA")
        & (F.col("CRSArrTime") != "NA")).count()
    # cancellations are counted before the filter that removes cancelled flights
    row = prepared.where((F.col("Year") == "2007") & (F.col("Month") == "3")
                         & (F.col("DayofMonth") == "5") & (F.col("Origin") == "ORD")).first()
    if row is not None:
        assert row["NrOfCancelledNAS"] == 1


@pytest.fixture(scope="module")
def prepared(flights):
    """Prepared flights without the planted missing values."""
    out = features.prepare_flights(flights).where(F.col("ArrDelay_Int").isNotNull())
    full = out
    for stage in features.row_wise_stages(features.FEATURE_SETS["indexed"]):
        full = stage.transform(full)
    numeric = [c for c in features.FEATURE_SETS["indexed"] if c in full.columns]
    return full.dropna(subset=numeric).select(*out.columns)


@pytest.mark.parametrize("feature_set", ["indexed", "hashed", "holiday", "windowed", "counts",
                                         "cancellations"])
def test_feature_sets_build(prepared, feature_set):
    p = features.build_pipeline(feature_set)
    out = p.fit(prepared).transform(prepared)
    assert out.select("features").first()[0].size == (
        len(features.FEATURE_SETS[feature_set]) - (1 if feature_set == "hashed" else 0)
        + (2000 if feature_set == "hashed" else 0))


def _split(df):
    return sampling.split_frames(df, ["Year", "Month", "DayofMonth", "FlightNum", "Origin",
                                      "DepTime"], (0.7, 0.3), 42)


def test_models_beat_constant(prepared):
    train, test = _split(prepared)
    mean = train.agg(F.avg("ArrDelay_Int")).first()[0]
    base = evaluate.regression_metrics(test.withColumn("prediction", F.lit(mean)),
                                       "prediction").first()["rmse"]
    bins = models.max_bins_for(train, features.NOMINAL_COLUMNS)
    for est in (models.linear(), models.tree(max_depth=6, max_bins=bins),
                models.forest(num_trees=10, max_depth=6, max_bins=bins),
                models.gbt(max_iter=10, max_depth=4, max_bins=bins)):
        model = features.build_pipeline("holiday", est).fit(train)
        scored = models.predict(model, test)
        rmse = evaluate.regression_metrics(scored, "prediction").first()["rmse"]
        assert rmse < 0.6 * base, (type(est).__name__, rmse, base)
    imp = evaluate.feature_importances(model.stages[-1], scored).collect()
    assert len(imp) == 15 and {r["feature"] for r in imp} >= {"DepDelay_Int", "TaxiOut_Int"}
    assert evaluate.describe_model(model.stages[-1], max_nodes=10**6) is not None


def test_depth_beyond_the_limit_is_an_error():
    assert models.tree(max_depth=30).getMaxDepth() == 30
    with pytest.raises(ValueError):
        models.tree(max_depth=50)


def test_linear_matches_sql(spark, prepared):
    a = features.assemble(["DepDelay_Int"]).transform(prepared)
    from pyspark.ml.regression import LinearRegression

    m = LinearRegression(featuresCol="features", labelCol="ArrDelay_Int", solver="normal").fit(a)
    a.createOrReplaceTempView("prep")
    slope, icpt = spark.sql("SELECT regr_slope(ArrDelay_Int, DepDelay_Int), "
                            "regr_intercept(ArrDelay_Int, DepDelay_Int) FROM prep "
                            "WHERE features IS NOT NULL").first()
    assert math.isclose(m.coefficients[0], slope, rel_tol=1e-9)
    assert math.isclose(m.intercept, icpt, rel_tol=1e-9, abs_tol=1e-9)
    rep = {r["term"]: r["value"] for r in evaluate.linear_report(m, a).collect()}
    assert math.isclose(rep["DepDelay_Int"], slope, rel_tol=1e-9)


def test_save_load_same_predictions(prepared, scratch):
    model = features.build_pipeline("holiday", models.tree(max_depth=4)).fit(prepared)
    path = os.path.join(scratch, "model")
    from delaylab.sources import sinks

    sinks.save_model(model, path)
    loaded = sinks.load_model(path)
    assert isinstance(loaded, PipelineModel)
    a = model.transform(prepared).select("prediction")
    b = loaded.transform(prepared).select("prediction")
    assert a.exceptAll(b).count() == 0


def test_tuning_tables(prepared):
    lr = models.linear()
    stages = features.feature_stages("holiday") + [lr]
    grid = tuning.param_grid(lr, {"regParam": [0.0, 0.5]})
    res, best, secs = tuning.cross_validate(Pipeline(stages=stages), grid, prepared, folds=2)
    assert res.count() == 2 and secs > 0
    assert tuning.best_stage(best).__class__.__name__ == "LinearRegressionModel"
    res2, _, _ = tuning.train_validation(Pipeline(stages=stages), grid, prepared)
    assert res2.count() == 2
    assembled = Pipeline(stages=features.feature_stages("holiday")).fit(prepared).transform(prepared)
    chunked = sampling.disjoint_chunks(assembled, ["Year", "Month", "DayofMonth", "FlightNum",
                                                   "DepTime"], n=6, fraction=0.15)
    sel = tuning.chunked_selection(lr, grid, chunked.select("features", "ArrDelay_Int", "chunk"))
    rows = sel.collect()
    assert len(rows) == 2 and all(r["n_chunks"] == 5 for r in rows)


def test_prepare_flights_counts_equal_reference_windows(flights):
    """One aggregation per key set gives the same counts as the reference's three windows
    (departures / arrivals after the sentinel filter, cancellations before it)."""
    from pyspark.sql import Window

    from delaylab.operators import clean, windows

    got = features.prepare_flights(flights)
    day_o = Window.partitionBy("Year", "Month", "DayofMonth", "Origin")
    day_d = Window.partitionBy("Year", "Month", "DayofMonth", "Dest")
    base = clean.drop_leakage(flights).withColumn(
        "NrOfCancelledNAS", F.count_if(F.col("CancellationCode") == "C").over(day_o))
    base = clean.drop_na_sentinel(base).withColumns({
        "NrOfDepartures": F.count("Origin").over(day_o),
        "NrOfArrivals": F.count("Dest").over(day_d)})
    cols = ["Year", "Month", "DayofMonth", "FlightNum", "Origin", "Dest", "DepTime",
            "NrOfDepartures", "NrOfArrivals", "NrOfCancelledNAS"]
    assert got.select(*cols).exceptAll(base.select(*cols)).count() == 0
    assert base.select(*cols).exceptAll(got.select(*cols)).count() == 0
    assert windows.DAY_KEYS == ("Year", "Month", "DayofMonth")


def test_model_summary_small_tree(prepared):
    model = features.build_pipeline("holiday", models.tree(max_depth=2)).fit(prepared)
    row = evaluate.model_summary(model.stages[-1]).first()
    assert row["num_nodes"] <= 7 and row["depth"] <= 2 and "If (feature" in row["tree"]
    big = evaluate.model_summary(model.stages[-1], max_nodes=1).first()
    assert big["tree"] is None
