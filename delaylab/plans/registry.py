"""Registry of named queries over the driver tables and their DuckDB twins.

Each query is a function ``(spark, sf_dir) -> DataFrame`` that maps an operator of the library
onto the driver table with the same shape (orders as flights per day, lineitem as a numeric
flight table, events as timed events). ``oracle`` is the same computation in DuckDB SQL over
views of the same parquet files, or ``None`` when only a row check is possible (models,
random samples).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, tuple[str, ...]] = {}


def register(name: str, operators: tuple[str, ...] | str = (), oracle: str | None = None):
    """Decorator: add a query under ``name`` with the survey operator ids it covers."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPERATORS[name] = (operators,) if isinstance(operators, str) else tuple(operators)
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco
