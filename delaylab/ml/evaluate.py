"""Evaluation as DataFrame aggregates, and model reports as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._util import as_list


def regression_metrics(df: DataFrame, prediction: str = "prediction", label: str = "ArrDelay_Int",
                       by=None) -> DataFrame:
    """RMSE, MSE, MAE, R^2 and explained variance (mean squared deviation of the predictions
    from the label mean), per group or overall. One aggregate of mergeable central moments, one row
    per group: the mean squared deviation of p from the mean of y is the variance of p plus the
    square of the mean of p - y, so large labels do not cancel."""
    by = as_list(by)
    p, y = F.col(prediction).cast("double"), F.col(label).cast("double")
    pairs = df.select(*by, p.alias("_p"), y.alias("_y")).where(
        F.col("_p").isNotNull() & F.col("_y").isNotNull())
    agg = pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("_p") - F.col("_y")) ** 2).alias("_sse"),
        F.sum(F.abs(F.col("_p") - F.col("_y"))).alias("_sae"),
        F.var_pop("_y").alias("_vy"), F.var_pop("_p").alias("_vp"),
        F.avg(F.col("_p") - F.col("_y")).alias("_bias"))
    mse = F.col("_sse") / F.col("n")
    var_expl = F.col("_vp") + F.col("_bias") ** 2
    return agg.select(*by, "n", F.sqrt(mse).alias("rmse"), mse.alias("mse"),
                      (F.col("_sae") / F.col("n")).alias("mae"),
                      (1 - mse / F.col("_vy")).alias("r2"), var_expl.alias("var"))


def feature_importances(model, df: DataFrame, features_col: str = "features") -> DataFrame:
    """(``feature``, ``importance``) with names from the assembled vector's metadata."""
    names = feature_names(df, features_col)
    imp = model.featureImportances.toArray().tolist()
    rows = [(names[i] if i < len(names) else f"f{i}", float(v)) for i, v in enumerate(imp)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def feature_names(df: DataFrame, features_col: str = "features") -> list[str]:
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    out: dict[int, str] = {}
    for group in attrs.values():
        for a in group:
            out[a["idx"]] = a.get("name", f"f{a['idx']}")
    n = meta.get("num_attrs", len(out))
    return [out.get(i, f"f{i}") for i in range(n)]


def linear_report(model, df: DataFrame | None = None, features_col: str = "features"
                  ) -> DataFrame:
    """(``term``, ``value``): intercept, one coefficient per feature, then the training
    summary (RMSE, R^2, iterations, the objective after each iteration)."""
    from pyspark.sql import SparkSession

    spark = df.sparkSession if df is not None else SparkSession.getActiveSession()
    names = feature_names(df, features_col) if df is not None else []
    coefs = model.coefficients.toArray().tolist()
    rows = [("intercept", float(model.intercept))]
    rows += [(names[i] if i < len(names) else f"coef_{i}", float(c)) for i, c in enumerate(coefs)]
    if model.hasSummary:
        s = model.summary
        rows += [("rmse", float(s.rootMeanSquaredError)), ("r2", float(s.r2)),
                 ("iterations", float(s.totalIterations))]
        rows += [(f"objective_{i}", float(v)) for i, v in enumerate(s.objectiveHistory or [])]
    return spark.createDataFrame(rows, "term string, value double")


def best_report(stage, scored: DataFrame, label: str, features_col: str = "features") -> DataFrame:
    """(``term``, ``value``, ``text``) of a tuned run's best model: importances or coefficients,
    the model's size and, if small, its tree, then the test metrics."""
    metrics = regression_metrics(scored, "prediction", label).first()
    rows = [(k, float(metrics[k]), None) for k in ("rmse", "mse", "mae", "r2", "var")]
    if hasattr(stage, "featureImportances"):
        rows += [(f"importance {r['feature']}", r["importance"], None)
                 for r in feature_importances(stage, scored, features_col).collect()]
        size = float(getattr(stage, "totalNumNodes", getattr(stage, "numNodes", 0)))
        rows.append(("nodes", size, describe_model(stage)))
    else:
        rows += [(r["term"], r["value"], None)
                 for r in linear_report(stage, scored, features_col).collect()]
    return scored.sparkSession.createDataFrame(rows, "term string, value double, text string")


def residuals(df: DataFrame, prediction: str = "prediction", label: str = "ArrDelay_Int",
              out: str = "residual") -> DataFrame:
    """Label minus prediction per row, as a DataFrame (never collected)."""
    return df.withColumn(out, F.col(label).cast("double") - F.col(prediction))


def describe_model(model, max_nodes: int = 30) -> str | None:
    """Printable tree when it is small enough to read."""
    n = getattr(model, "totalNumNodes", None)
    if n is None:
        n = getattr(model, "numNodes", None)
    if n is not None and n < max_nodes:
        return model.toDebugString
    return None


def model_summary(model, max_nodes: int = 30) -> DataFrame:
    """(``num_nodes``, ``depth``, ``tree``): size of a tree model and its printable form when it
    has fewer than ``max_nodes`` nodes (NULL otherwise)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    n = int(getattr(model, "totalNumNodes", getattr(model, "numNodes", 0)))
    depth = int(getattr(model, "depth", -1)) if hasattr(model, "depth") else None
    return spark.createDataFrame([(n, depth, describe_model(model, max_nodes))],
                                 "num_nodes int, depth int, tree string")
