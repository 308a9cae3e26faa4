"""Queries for the feature stages, estimators, evaluation and tuning.

lineitem stands in for the flight table: ``l_extendedprice`` is the label, quantity /
discount / tax the numeric features, return flag / line status / supplier the nominal ones.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml import evaluate, features, ledger, models, nominal, tuning
from ..operators import explore, sampling
from ..operators._plan import attach_small
from ..session import scratch_path
from ..sources.sinks import write_results
from . import duck
from .common import r6, t
from .registry import register

LABEL = "l_extendedprice"
NUMERIC = ("l_quantity", "l_discount", "l_tax")
NOMINAL = ("l_returnflag", "l_linestatus")


def _lineitem_ml(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *NUMERIC, *NOMINAL,
                     F.col("l_suppkey").cast("string").alias("l_suppkey"), LABEL)


def _tree_stages(estimator):
    return [features.string_indexer(NOMINAL, "keep"),
            features.assemble([*NUMERIC, *[c + "_Index" for c in NOMINAL]]), estimator]


def _train_test(df):
    return sampling.split_frames(df, ["l_orderkey", "l_linenumber"], (0.7, 0.3), 42)


_IDX_SQL = """(SELECT event_type AS v,
  CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS idx
  FROM events {where} GROUP BY event_type)"""


@register("string_index", "FEA1", oracle=f"""
SELECT e.event_id, e.event_type, r.idx AS event_type_Index
FROM events e JOIN {_IDX_SQL.format(where="")} r ON e.event_type = r.v""")
def q_string_index(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", "event_type")
    model = features.string_indexer(["event_type"], "error").fit(e)
    return model.transform(e)


@register("string_index_keep", "FEA2", oracle=f"""
SELECT e.event_id, e.event_type,
       coalesce(r.idx, (SELECT count(DISTINCT event_type) FROM events
                        WHERE event_type <> 'error')) AS event_type_Index
FROM (SELECT event_id, nullif(event_type, 'error') AS event_type FROM events) e
LEFT JOIN {_IDX_SQL.format(where="WHERE event_type <> 'error'")} r ON e.event_type = r.v""")
def q_string_index_keep(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))
    model = features.string_indexer(["event_type"], "keep").fit(e)
    return model.transform(e)


_RANK = """(SELECT CAST({c} AS VARCHAR) AS v,
  CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS DOUBLE) AS idx
  FROM lineitem {where} GROUP BY {c})"""


@register("nominal_index", "FEA1", oracle=f"""
SELECT l_orderkey, l_linenumber, o.idx AS l_orderkey_Index, p.idx AS l_partkey_Index,
       f.idx AS l_returnflag_Index
FROM lineitem JOIN {_RANK.format(c="l_orderkey", where="")} o ON CAST(l_orderkey AS VARCHAR) = o.v
     JOIN {_RANK.format(c="l_partkey", where="")} p ON CAST(l_partkey AS VARCHAR) = p.v
     JOIN {_RANK.format(c="l_returnflag", where="")} f ON l_returnflag = f.v""")
def q_nominal_index(spark, sf_dir):
    """Index of columns with as many labels as a quarter of the rows: the labels stay a table."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                             "l_returnflag")
    model = nominal.frequency_indexer(["l_orderkey", "l_partkey", "l_returnflag"], "error").fit(li)
    return model.transform(li).drop("l_partkey", "l_returnflag")


@register("nominal_index_keep", "FEA2", oracle=f"""
SELECT l_orderkey, l_linenumber, coalesce(p.idx, (SELECT count(DISTINCT l_partkey) FROM lineitem
         WHERE l_linenumber = 1)) AS l_partkey_Index,
       coalesce(f.idx, (SELECT count(DISTINCT l_returnflag) FROM lineitem
         WHERE l_linenumber = 1 AND l_returnflag <> 'R')) AS l_returnflag_Index
FROM lineitem
LEFT JOIN {_RANK.format(c="l_partkey", where="WHERE l_linenumber = 1")} p
  ON CAST(l_partkey AS VARCHAR) = p.v
LEFT JOIN {_RANK.format(c="l_returnflag", where="WHERE l_linenumber = 1 AND l_returnflag <> 'R'")} f
  ON l_returnflag = f.v""")
def q_nominal_index_keep(spark, sf_dir):
    """Fitted on the first line of every order: unseen labels and NULLs get the next index. The
    model goes through storage."""
    li = t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("l_returnflag"))
    model = nominal.frequency_indexer(["l_partkey", "l_returnflag"]).fit(
        li.where("l_linenumber = 1"))
    path = scratch_path(spark, "nominal-index")
    model.save(path)
    loaded = nominal.FrequencyIndexerModel.load(path)
    return loaded.transform(li).drop("l_partkey", "l_returnflag")


_HASHED = ("l_returnflag", "l_linestatus", "l_suppkey")
_KEYS = " UNION ".join(f"SELECT '{c}=' || CAST({c} AS VARCHAR) AS k FROM lineitem"
                       for c in _HASHED)


@register("feature_hash", "FEA3", oracle=f"""
WITH m AS (SELECT * FROM {duck.murmur3_slots(f"({_KEYS})", 2000)} x),
d AS (SELECT DISTINCT {", ".join(_HASHED)} FROM lineitem),
e AS (SELECT {", ".join(_HASHED)}, slot, count(*) AS n
      FROM d JOIN m ON m.k IN ({", ".join(f"'{c}=' || CAST({c} AS VARCHAR)" for c in _HASHED)})
      GROUP BY ALL),
s AS (SELECT {", ".join(_HASHED)}, string_agg(slot || ':' || n, ',' ORDER BY slot) AS slots
      FROM e GROUP BY {", ".join(_HASHED)})
SELECT l_orderkey, l_linenumber, slots FROM lineitem JOIN s USING ({", ".join(_HASHED)})""")
def q_feature_hash(spark, sf_dir):
    """Slot and value of every hashed feature, by row. The few thousand distinct inputs are
    hashed, their slots read from the sparse vectors and joined back."""
    li = _lineitem_ml(spark, sf_dir)
    names = list(_HASHED)
    seen = li.select(*names).distinct()
    v = features.feature_hasher(names, 2000, "hashed").transform(seen)
    slots = v.select(*names, features.sparse_entries("hashed").alias("slots"))
    return attach_small(li, slots, names).select("l_orderkey", "l_linenumber", "slots")


@register("hash_sizes", "FEA4", oracle="""
SELECT "column", cardinality,
       CASE WHEN cardinality <= 1000 THEN cardinality * cardinality ELSE cardinality * 20 END
         AS num_features
FROM (SELECT 'l_returnflag' AS "column", count(DISTINCT l_returnflag) AS cardinality FROM lineitem
      UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus) FROM lineitem
      UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem
      UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem) c""")
def q_hash_sizes(spark, sf_dir):
    return features.suggest_hash_sizes(t(spark, sf_dir, "lineitem"),
                                       ["l_returnflag", "l_linestatus", "l_suppkey", "l_partkey"])


@register("assemble", "FEA5", oracle="""
SELECT l_orderkey, l_linenumber, [l_quantity, l_discount, l_tax]::DOUBLE[] AS features
FROM lineitem""")
def q_assemble(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    a = features.assemble(NUMERIC, "features", "error").transform(li)
    return a.select("l_orderkey", "l_linenumber", vector_to_array("features").alias("features"))


@register("one_hot", ("FEA7", "FEA1"), oracle=f"""
SELECT e.event_id,
  CAST([{", ".join(f"CASE WHEN r.idx = {i} THEN 1.0 ELSE 0.0 END" for i in range(4))}] AS DOUBLE[])
  AS event_type_Vec
FROM events e JOIN {_IDX_SQL.format(where="")} r ON e.event_type = r.v""")
def q_one_hot(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", "event_type")
    idx = features.string_indexer(["event_type"], "error").fit(e).transform(e)
    enc = features.one_hot(["event_type_Index"], suffix="_Vec").setHandleInvalid("error")
    out = enc.fit(idx).transform(idx)
    return out.select("event_id", vector_to_array("event_type_Index_Vec").alias("event_type_Vec"))


@register("vector_index", "FEA6", oracle=f"""
WITH c AS (SELECT l_returnflag, l_linestatus, count(*) OVER (PARTITION BY l_returnflag) AS n_flag,
                  count(*) OVER (PARTITION BY l_linestatus) AS n_status,
                  l_orderkey, l_linenumber, l_tax FROM lineitem),
i AS (SELECT *, dense_rank() OVER (ORDER BY n_flag DESC, l_returnflag) - 1 AS flag,
             dense_rank() OVER (ORDER BY n_status DESC, l_linestatus) - 1 AS status FROM c)
SELECT l_orderkey, l_linenumber,
       CAST([flag, status, l_tax] AS DOUBLE[]) AS nominal_indexed FROM i""")
def q_vector_index(spark, sf_dir):
    li = _lineitem_ml(spark, sf_dir)
    stages = [features.string_indexer(NOMINAL, "keep"),
              features.assemble([c + "_Index" for c in NOMINAL] + ["l_tax"], "nominal"),
              features.vector_indexer("nominal", "nominal_indexed", max_categories=2)]
    out = Pipeline(stages=stages).fit(li).transform(li)
    return out.select("l_orderkey", "l_linenumber",
                      vector_to_array("nominal_indexed").alias("nominal_indexed"))


def hhmm_sql(col):
    """Hour and minute of an hhmm text in DuckDB, NULL for invalid clock values."""
    tt = f"TRY_CAST({col} AS INTEGER)"
    valid = f"({tt} >= 0 AND {tt} // 100 <= 24 AND {tt} % 100 <= 59)"
    return (f"CASE WHEN {valid} THEN {tt} // 100 END", f"CASE WHEN {valid} THEN {tt} % 100 END")


@register("custom_stage_features", ("FEA8", "FEA9", "FEA11"), oracle=f"""
SELECT event_id, {duck.r6(duck.cyc(hhmm_sql('hhmm')[0], 24.0))} AS hhmm_Hours,
       {duck.r6(duck.cyc(hhmm_sql('hhmm')[1], 60.0))} AS hhmm_Minutes,
       {duck.holiday_distance("Date")} AS DistanceToHoliday
FROM (SELECT event_id, CAST(hour(ts) * 100 + minute(ts) AS VARCHAR) AS hhmm,
             CAST(ts AS DATE) AS Date FROM events) e""")
def q_custom_stage_features(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(
        "event_id", (F.hour("ts") * 100 + F.minute("ts")).cast("string").alias("hhmm"),
        F.to_date("ts").alias("Date"))
    stages = [features.TimeSplitter(inputCol="hhmm"),
              features.HolidayDistance(inputCol="Date", outputCol="DistanceToHoliday")]
    out = Pipeline(stages=stages).fit(e).transform(e)
    return out.select("event_id", r6("hhmm_Hours").alias("hhmm_Hours"),
                      r6("hhmm_Minutes").alias("hhmm_Minutes"), "DistanceToHoliday")


def _linear_model(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    a = features.assemble(["l_quantity"], "features").transform(li)
    return a, models.fit(models.linear(label=LABEL, solver="normal"), a)


@register("linear_fit", ("EST1", "EVA3"), oracle=f"""
WITH c AS (SELECT regr_intercept({LABEL}, l_quantity) AS a, regr_slope({LABEL}, l_quantity) AS b,
                  regr_r2({LABEL}, l_quantity) AS r2 FROM lineitem),
e AS (SELECT sqrt(avg(pow({LABEL} - (a + b * l_quantity), 2))) AS rmse FROM lineitem, c)
SELECT 'intercept' AS term, round(a, 3) AS value FROM c
UNION ALL SELECT 'l_quantity', round(b, 3) FROM c
UNION ALL SELECT 'r2', round(r2, 6) FROM c
UNION ALL SELECT 'rmse', round(rmse, 3) FROM e""")
def q_linear_fit(spark, sf_dir):
    a, model = _linear_model(spark, sf_dir)
    rep = evaluate.linear_report(model, a)
    rep = rep.where(F.col("term").isin("intercept", "l_quantity", "r2", "rmse"))
    return rep.select("term", F.when(F.col("term") == "r2", F.round("value", 6))
                      .otherwise(F.round("value", 3)).alias("value"))


@register("residuals", "EVA3", oracle=f"""
WITH c AS (SELECT regr_intercept({LABEL}, l_quantity) AS a, regr_slope({LABEL}, l_quantity) AS b
           FROM lineitem)
SELECT l_orderkey, l_linenumber, round({LABEL} - (a + b * l_quantity), 2) AS residual
FROM lineitem, c""")
def q_residuals(spark, sf_dir):
    a, model = _linear_model(spark, sf_dir)
    r = evaluate.residuals(models.predict(model, a), "prediction", LABEL)
    return r.select("l_orderkey", "l_linenumber", F.round("residual", 2).alias("residual"))


@register("linear_elastic_hashed", ("EST1", "FEA3", "FEA5"))
def q_linear_elastic_hashed(spark, sf_dir):
    li = _lineitem_ml(spark, sf_dir)
    stages = [features.feature_hasher(["l_returnflag", "l_linestatus", "l_suppkey"], 2000,
                                      "hashed"),
              features.assemble([*NUMERIC, "hashed"]),
              models.linear(label=LABEL, max_iter=10, reg_param=0.1, elastic_net=0.8)]
    train, test = _train_test(li)
    model = models.fit(Pipeline(stages=stages), train)
    scored = model.transform(test)
    return evaluate.regression_metrics(scored, "prediction", LABEL)


def _fit_trees(spark, sf_dir, estimator):
    li = _lineitem_ml(spark, sf_dir)
    train, test = _train_test(li)
    model = models.fit(Pipeline(stages=_tree_stages(estimator)), train)
    scored = model.transform(test)
    imp = evaluate.feature_importances(model.stages[-1], scored)
    return imp, evaluate.regression_metrics(scored, "prediction", LABEL)


@register("tree_summary", ("EST2", "EVA5"))
def q_tree_summary(spark, sf_dir):
    li = _lineitem_ml(spark, sf_dir)
    model = models.fit(Pipeline(stages=_tree_stages(models.tree(label=LABEL, max_depth=3))), li)
    return evaluate.model_summary(model.stages[-1], max_nodes=30)


_STATUS_MEAN = f"""SELECT l_orderkey, l_linenumber,
  round(avg({LABEL}) OVER (PARTITION BY l_linestatus), 4) AS prediction FROM lineitem"""


def _status_mean(spark, sf_dir, estimator):
    """Predictions of a model on one two-valued feature: the mean of each value's rows."""
    li = _lineitem_ml(spark, sf_dir)
    stages = [features.string_indexer(["l_linestatus"], "error"),
              features.assemble(["l_linestatus_Index"]), estimator]
    model = models.fit(Pipeline(stages=stages), li)
    return models.predict(model, li).select(
        "l_orderkey", "l_linenumber", F.round("prediction", 4).alias("prediction"))


@register("tree_group_means", ("EST2", "EST5"), oracle=_STATUS_MEAN)
def q_tree_group_means(spark, sf_dir):
    return _status_mean(spark, sf_dir, models.tree(label=LABEL, max_depth=1))


@register("forest_group_means", ("EST3", "EST5"), oracle=_STATUS_MEAN)
def q_forest_group_means(spark, sf_dir):
    """One tree on all rows, without bootstrap."""
    return _status_mean(spark, sf_dir, models.forest(
        label=LABEL, num_trees=1, max_depth=1, bootstrap=False, subsamplingRate=1.0))


@register("gbt_group_means", ("EST4", "EST5"), oracle=_STATUS_MEAN)
def q_gbt_group_means(spark, sf_dir):
    """One boosting iteration."""
    return _status_mean(spark, sf_dir, models.gbt(label=LABEL, max_iter=1, max_depth=1))


@register("tree_importances", ("EVA4", "EVA5"), oracle="""
SELECT 'l_linestatus_Index' AS feature, 1.0::DOUBLE AS importance, 3 AS num_nodes, 1 AS depth,
       true AS printed
UNION ALL SELECT 'constant', 0.0, 3, 1, true""")
def q_tree_importances(spark, sf_dir):
    """A constant feature has no importance, the only informative one has all of it; a tree of
    three nodes is printed."""
    li = _lineitem_ml(spark, sf_dir).withColumn("constant", F.lit(1.0))
    stages = [features.string_indexer(["l_linestatus"], "error"),
              features.assemble(["l_linestatus_Index", "constant"]),
              models.tree(label=LABEL, max_depth=1)]
    model = models.fit(Pipeline(stages=stages), li)
    rep = evaluate.model_summary(tuning.best_stage(model), max_nodes=30).first()
    imp = evaluate.feature_importances(tuning.best_stage(model), model.transform(li))
    return imp.select("feature", "importance", F.lit(rep["num_nodes"]).alias("num_nodes"),
                      F.lit(rep["depth"]).alias("depth"),
                      F.lit(bool(rep["tree"])).alias("printed"))


@register("tree_fit", ("EST2", "EST5", "EVA4"))
def q_tree_fit(spark, sf_dir):
    est = models.tree(label=LABEL, max_depth=6)
    return _fit_trees(spark, sf_dir, est)[0]


@register("forest_fit", ("EST3", "EST5", "EVA4"))
def q_forest_fit(spark, sf_dir):
    est = models.forest(label=LABEL, num_trees=10, max_depth=5)
    return _fit_trees(spark, sf_dir, est)[0]


@register("gbt_fit", ("EST4", "EST5", "EVA4"))
def q_gbt_fit(spark, sf_dir):
    est = models.gbt(label=LABEL, max_iter=10, max_depth=4)
    return _fit_trees(spark, sf_dir, est)[0]


_GROUP_MEAN_SQL = f"""
WITH g AS (SELECT l_returnflag, avg({LABEL}) AS p FROM lineitem GROUP BY 1),
j AS (SELECT {LABEL} AS y, p FROM lineitem JOIN g USING (l_returnflag)),
m AS (SELECT avg(y) AS my, var_pop(y) AS vy FROM j)
SELECT count(*) AS n, round(sqrt(avg(pow(p - y, 2))), 4) AS rmse,
       round(avg(pow(p - y, 2)), 1) AS mse, round(avg(abs(p - y)), 4) AS mae,
       round(1 - avg(pow(p - y, 2)) / min(vy), 6) AS r2,
       round(avg(pow(p - my, 2)), 1) AS "var"
FROM j, m"""


def _rounded_metrics(m):
    return m.select("n", F.round("rmse", 4).alias("rmse"), F.round("mse", 1).alias("mse"),
                    F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"),
                    F.round("var", 1).alias("var"))


@register("regression_metrics", ("EVA1", "EVA2"), oracle=_GROUP_MEAN_SQL)
def q_regression_metrics(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select("l_returnflag", LABEL)
    scored = explore.group_mean_column(li, ["l_returnflag"], LABEL, "prediction")
    return _rounded_metrics(evaluate.regression_metrics(scored, "prediction", LABEL))


_U = duck.hash_unit(["l_orderkey", "l_linenumber"], 42)
_THIRD, _QUARTERS = sampling.hash_bound(1 / 3), sampling.hash_bound(0.75)
_TENTH = sampling.hash_bound(0.1)


def _regr(train: str, test: str) -> str:
    """RMSE on ``test`` rows of the line through quantity fitted on ``train`` rows, in DuckDB."""
    return f"""(SELECT sqrt(avg(pow({LABEL} - (a + b * l_quantity), 2))) FROM h,
  (SELECT regr_intercept({LABEL}, l_quantity) AS a, regr_slope({LABEL}, l_quantity) AS b
   FROM h WHERE {train}) f WHERE {test})"""


def _tagged(spark, sf_dir, **kw):
    li = t(spark, sf_dir, "lineitem")
    return features.assemble(["l_quantity"]).transform(li), models.linear(label=LABEL, **kw)


@register("tune_cv_folds", ("TUN1", "TUN2", "TUN5", "TUN6", "EVA6"), oracle=f"""
WITH h AS (SELECT {LABEL}, l_quantity, CAST(least({_U} // {_THIRD}, 2) AS INTEGER) AS f
           FROM lineitem),
r AS (SELECT unnest([{", ".join(_regr(f"f <> {i}", f"f = {i}") for i in range(3))}]) AS rmse)
SELECT g.grid_point, g.params, round(avg(rmse), 3) AS mean_rmse,
       round(stddev_pop(rmse), 3) AS std_rmse, true AS timed, 'LinearRegressionModel' AS best_stage
FROM r, (VALUES (0, 'maxIter=5'), (1, 'maxIter=10')) g(grid_point, params)
GROUP BY g.grid_point, g.params""")
def q_tune_cv_folds(spark, sf_dir):
    """Cross-validation over folds that the md5 hash names: one feature, exact solver, so each
    grid point is the regression line itself."""
    data, lr = _tagged(spark, sf_dir, solver="normal")
    data = sampling.hash_split(data, ["l_orderkey", "l_linenumber"], (1, 1, 1), 42, "fold")
    grid = tuning.param_grid(lr, {"maxIter": [5, 10]})
    results, best, _ = tuning.cross_validate(lr, grid, data, LABEL, folds=3, fold_col="fold")
    return results.select(
        "grid_point", "params", F.round("mean_rmse", 3).alias("mean_rmse"),
        F.round("std_rmse", 3).alias("std_rmse"), (F.col("train_seconds") > 0).alias("timed"),
        F.lit(type(tuning.best_stage(best)).__name__).alias("best_stage"))


class _Interrupted(Exception):
    """Stands for the end of a run."""


@register("tune_restart", ("TUN1", "TUN2", "TUN4", "TUN5", "EVA6"), oracle=f"""
WITH h AS (SELECT {LABEL}, l_quantity, CAST(least({_U} // {_THIRD}, 2) AS INTEGER) AS f
           FROM lineitem),
r AS (SELECT unnest([{", ".join(_regr(f"f <> {i}", f"f = {i}") for i in range(3))}]) AS rmse)
SELECT g.grid_point, g.params, round(avg(rmse), 3) AS mean_rmse,
       round(stddev_pop(rmse), 3) AS std_rmse, 4 AS fits_before, 3 AS fits_after,
       'LinearRegressionModel' AS best_stage
FROM r, (VALUES (0, 'maxIter=5'), (1, 'maxIter=10')) g(grid_point, params)
GROUP BY g.grid_point, g.params""")
def q_tune_restart(spark, sf_dir):
    """A cross-validation that ends after four of its six fits and is started again with the same
    ledger: the second run fits the other two and the best model."""
    data, lr = _tagged(spark, sf_dir, solver="normal")
    data = sampling.hash_split(data, ["l_orderkey", "l_linenumber"], (1, 1, 1), 42, "fold")
    grid = tuning.param_grid(lr, {"maxIter": [5, 10]})
    kept = ledger.Ledger(spark, scratch_path(spark, "ledger"), "cv")
    fit, fits = lr.fit, []

    def counted(train, params=None, stop=None):
        if stop is not None and len(fits) >= stop:
            raise _Interrupted
        fits.append(params)
        return fit(train, params)

    lr.fit = lambda train, params=None: counted(train, params, 4)
    try:
        tuning.cross_validate(lr, grid, data, LABEL, fold_col="fold", ledger=kept)
    except _Interrupted:
        pass
    before = len(fits)
    lr.fit = counted
    results, best, _ = tuning.cross_validate(lr, grid, data, LABEL, fold_col="fold", ledger=kept)
    return results.select(
        "grid_point", "params", F.round("mean_rmse", 3).alias("mean_rmse"),
        F.round("std_rmse", 3).alias("std_rmse"), F.lit(before).alias("fits_before"),
        F.lit(len(fits) - before).alias("fits_after"),
        F.lit(type(tuning.best_stage(best)).__name__).alias("best_stage"))


@register("tune_tvs_hash", ("TUN1", "TUN3", "TUN6", "EVA6"), oracle=f"""
WITH h AS (SELECT {LABEL}, l_quantity, {_U} < {_QUARTERS} AS train FROM lineitem)
SELECT 0 AS grid_point, 'solver=normal' AS params,
       round({_regr("train", "NOT train")}, 3) AS rmse, true AS timed,
       'LinearRegressionModel' AS best_stage""")
def q_tune_tvs_hash(spark, sf_dir):
    """Train/validation tuning with a hash-based validation set."""
    data, lr = _tagged(spark, sf_dir)
    data = sampling.hash_split(data, ["l_orderkey", "l_linenumber"], (0.75, 0.25), 42, "part")
    grid = tuning.param_grid(lr, {"solver": ["normal"]})
    results, best, _ = tuning.train_validation(lr, grid, data, LABEL, split_col="part")
    return results.select(
        "grid_point", "params", F.round("rmse", 3).alias("rmse"),
        (F.col("train_seconds") > 0).alias("timed"),
        F.lit(type(tuning.best_stage(best)).__name__).alias("best_stage"))


@register("chunked_linear", ("TUN4", "TUN5", "SAM4", "SAM5", "EVA6", "SNK3"), oracle=f"""
WITH h AS (SELECT {LABEL}, l_quantity, CAST({_U} // {_TENTH} AS INTEGER) AS c FROM lineitem
           WHERE {_U} < {6 * _TENTH}),
r AS (SELECT unnest([{", ".join(_regr(f"c = {i}", "c = 5") for i in range(5))}]) AS rmse)
SELECT 0 AS grid_point, 'solver=normal' AS params, round(avg(rmse), 3) AS mean_rmse,
       round(var_pop(rmse), 2) AS var_rmse, round(stddev_pop(rmse), 3) AS std_rmse,
       count(*) AS n_chunks, true AS timed, (SELECT count(*) FROM h WHERE c = 5) AS n FROM r""")
def q_chunked_linear(spark, sf_dir):
    """A line fitted on each of five hash chunks and scored on the sixth; the results table goes
    through the results sink."""
    data, lr = _tagged(spark, sf_dir)
    chunked = sampling.disjoint_chunks(data, ["l_orderkey", "l_linenumber"], n=6, fraction=0.1)
    results = tuning.chunked_selection(lr, tuning.param_grid(lr, {"solver": ["normal"]}), chunked,
                                       LABEL, parallelism=2)
    path = scratch_path(spark, "tuning-results")
    write_results(results, path)
    return spark.read.parquet(path).select(
        "grid_point", "params", F.round("mean_rmse", 3).alias("mean_rmse"),
        F.round("var_rmse", 2).alias("var_rmse"), F.round("std_rmse", 3).alias("std_rmse"),
        "n_chunks", (F.col("train_seconds") > 0).alias("timed"), "n")


@register("feature_errors", ("FEA10",), oracle="""
SELECT 'hhmm_Hours' AS stage, true AS rejected
UNION ALL SELECT 'DistanceToHoliday', true UNION ALL SELECT 'missing feature', true""")
def q_feature_errors(spark, sf_dir):
    """Wrong input types and missing feature values are errors, not NULLs or lost rows."""
    li = t(spark, sf_dir, "lineitem")
    gaps = li.select(F.when(F.col("l_linenumber") > 1, F.col("l_tax")).alias("x"))
    cases = {"hhmm_Hours": lambda: features.TimeSplitter(inputCol="l_tax").transform(li),
             "DistanceToHoliday": lambda: features.HolidayDistance(
                 inputCol="l_tax", outputCol="d").transform(li),
             "missing feature": lambda: features.assemble(["x"]).transform(gaps).agg(
                 F.max(F.size(vector_to_array("features")))).collect()}
    rows = []
    for name, run in cases.items():
        try:
            run()
            rows.append((name, False))
        except Exception:  # noqa: BLE001  (TypeError of the stage, or Spark's task error)
            rows.append((name, True))
    return spark.createDataFrame(rows, "stage string, rejected boolean")


@register("tune_cv", ("TUN1", "TUN2", "TUN5", "EVA6"))
def q_tune_cv(spark, sf_dir):
    li = _lineitem_ml(spark, sf_dir)
    lr = models.linear(label=LABEL, max_iter=10)
    stages = [features.string_indexer(NOMINAL, "keep"),
              features.assemble([*NUMERIC, *[c + "_Index" for c in NOMINAL]]), lr]
    grid = tuning.param_grid(lr, {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.8]})
    return tuning.cross_validate(Pipeline(stages=stages), grid, li, LABEL, folds=3,
                                 parallelism=4)[0]


@register("tune_tvs", ("TUN1", "TUN3", "EVA6"))
def q_tune_tvs(spark, sf_dir):
    li = _lineitem_ml(spark, sf_dir)
    g = models.gbt(label=LABEL)
    grid = tuning.param_grid(g, {"stepSize": [0.1, 0.01], "maxDepth": [5, 7]})
    return tuning.train_validation(Pipeline(stages=_tree_stages(g)), grid, li, LABEL,
                                   parallelism=4)[0]


@register("chunked_selection", ("TUN4", "TUN5", "SAM4", "SAM5"))
def q_chunked_selection(spark, sf_dir):
    li = _lineitem_ml(spark, sf_dir)
    prep = Pipeline(stages=_tree_stages(models.linear(label=LABEL))[:-1])
    chunked = sampling.disjoint_chunks(li, ["l_orderkey", "l_linenumber"], n=6, fraction=0.1)
    # kept narrow: the indexer, the sizes and the layout of the chunks each pass over it
    chunked = chunked.select(*NUMERIC, *NOMINAL, LABEL, "chunk").persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        assembled = prep.fit(chunked.where(F.col("chunk") < 5)).transform(chunked)
        rf = models.forest(label=LABEL, max_depth=4)
        grid = tuning.param_grid(rf, {"numTrees": [5, 10]})
        return tuning.chunked_selection(rf, grid, assembled.select("features", LABEL, "chunk"),
                                        LABEL)
    finally:
        chunked.unpersist()
