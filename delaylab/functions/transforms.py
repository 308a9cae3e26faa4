"""Delay transforms that are plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._util import as_col


def log_transform(c) -> Column:
    """Natural log; NULL for values <= 0 (where numpy would give NaN or -inf)."""
    x = as_col(c)
    return F.when(x > 0, F.ln(x))


def boxcox_value(c, lam: float) -> Column:
    """Box-Cox of a positive column for a fixed lambda: ``(x^l - 1)/l``, ``ln x`` at l = 0."""
    x = as_col(c)
    if abs(lam) < 1e-12:
        return F.when(x > 0, F.ln(x))
    return F.when(x > 0, (F.pow(x, F.lit(float(lam))) - 1.0) / F.lit(float(lam)))
