"""Import every query module so the registry is complete."""

from __future__ import annotations

import importlib

MODULES = ("features_q", "explore_q", "sampling_q", "ml_q", "io_q", "jobs_q")


def load() -> None:
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")


def queries():
    load()
    from .registry import QUERIES

    return dict(QUERIES)


def oracle_sql():
    load()
    from .registry import ORACLE

    return dict(ORACLE)


def operators():
    load()
    from .registry import OPERATORS

    return dict(OPERATORS)
