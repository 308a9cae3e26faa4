"""Plan inspection helpers: what Catalyst and AQE actually chose."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical(df: DataFrame) -> str:
    """Executed physical plan as text (final plan once AQE has run, initial plan before)."""
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df: DataFrame) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def count(text: str, node: str) -> int:
    return len(re.findall(rf"\b{node}\b", text))


def exchanges(df: DataFrame) -> int:
    return count(physical(df), "Exchange")


def has_python(df: DataFrame) -> bool:
    p = physical(df)
    return any(n in p for n in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"))
