"""Sinks and result delivery: CSV, tuning results, fitted models, views, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, num_files: int | None = None, mode: str = "overwrite",
              header: bool = True) -> None:
    """Headered CSV. Files are written in parallel; ``num_files`` only when the consumer needs
    a fixed count (it coalesces, so it does not add a shuffle but narrows the last stage)."""
    out = df.coalesce(num_files) if num_files else df
    out.write.mode(mode).option("header", header).csv(path)


def write_results(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tuning or metric results as parquet (a table, not a serialized local object)."""
    df.write.mode(mode).parquet(path)


def save_model(model, path: str) -> None:
    """Persist a fitted MLlib model or pipeline model with its own distributed writer."""
    model.write().overwrite().save(path)


def load_model(path: str, kind=None):
    """Load a model saved by ``save_model``; ``kind`` defaults to ``PipelineModel``."""
    if kind is None:
        from pyspark.ml import PipelineModel

        kind = PipelineModel
    return kind.load(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def preview(df: DataFrame, cols=None, n: int = 20, order_by=None) -> DataFrame:
    """First ``n`` rows (by ``order_by`` when given, which makes the preview deterministic)."""
    out = df.select(*cols) if cols else df
    if order_by:
        out = out.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return out.limit(n)
