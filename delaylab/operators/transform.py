"""Distribution transforms of a delay column: shifted log and Box-Cox with lambda by maximum
likelihood.

The Box-Cox log-likelihood of every lambda on a grid is one aggregate over the table
(``n``, ``sum(ln x)`` and one ``var_pop`` per lambda), so choosing lambda is a single
distributed pass instead of a solver over a column pulled to one machine.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.transforms import boxcox_value
from ._plan import spread


def default_lambdas(lo: float = -2.0, hi: float = 2.0, step: float = 0.1) -> list[float]:
    n = int(round((hi - lo) / step))
    return [round(lo + i * step, 10) for i in range(n + 1)]


def shift_for(df: DataFrame, col: str) -> float:
    """``1 + abs(min(col))``: a one-row aggregate read back as one number."""
    m = df.agg(F.min(F.col(col).cast("double"))).first()[0]
    return 1.0 + abs(m if m is not None else 0.0)


def shifted_log(df: DataFrame, col: str, out: str, shift: float | None = None) -> DataFrame:
    """``out = ln(col + 1 + abs(min(col)))`` so that every value has a log."""
    s = shift_for(df, col) if shift is None else shift
    return df.withColumn(out, F.ln(F.col(col).cast("double") + F.lit(s)))


def require_positive(df: DataFrame, col: str, shift: float) -> None:
    """Box-Cox needs positive values; fail instead of leaving rows out of the likelihood."""
    x = F.col(col).cast("double")
    low = df.where(~F.isnan(x)).agg(F.min(x)).first()[0]
    if low is not None and low + shift <= 0:
        raise ValueError(f"{col} + {shift} has the value {low + shift}; Box-Cox needs positive "
                         "values (shift=None shifts by 1 + abs(min))")


def boxcox_profile(df: DataFrame, col: str, lambdas=None, shift: float = 0.0,
                   partitions: int | None = None) -> DataFrame:
    """Profile log-likelihood (``lambda``, ``llf``) of the Box-Cox transform of ``col + shift``
    over a grid of lambdas; ``llf = (l-1)*sum(ln x) - n/2 * ln(var_pop(y_l))``. NULL and NaN are
    missing; a value that is not positive after the shift is an error. ``partitions`` deals an
    under-split input over so many tasks."""
    lambdas = list(lambdas) if lambdas is not None else default_lambdas()
    x = F.col(col).cast("double") + F.lit(float(shift))
    require_positive(df, col, shift)
    pos = spread(df.select(x.alias("_x")).where(F.col("_x") > 0), partitions)
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(F.ln("_x")).alias("_sl")]
    aggs += [F.var_pop(boxcox_value(F.col("_x"), lam)).alias(f"_v{i}")
             for i, lam in enumerate(lambdas)]
    wide = pos.agg(*aggs)
    rows = F.array(*[F.struct(
        F.lit(float(lam)).alias("lambda"),
        (F.lit(float(lam) - 1.0) * F.col("_sl")
         - F.col("_n") / 2.0 * F.ln(F.col(f"_v{i}"))).alias("llf"))
        for i, lam in enumerate(lambdas)])
    return wide.select(F.inline(rows))


#: Widest bracket searched for lambda.
MAX_LAMBDA = 64.0


def _peak(df: DataFrame, col: str, lambdas, shift: float) -> float | None:
    prof = [r for r in boxcox_profile(df, col, lambdas, shift).collect()
            if r["llf"] is not None and not math.isnan(r["llf"]) and not math.isinf(r["llf"])]
    return max(prof, key=lambda r: (r["llf"], -r["lambda"]))["lambda"] if prof else None


def best_lambda(df: DataFrame, col: str, lambdas=None, shift: float = 0.0,
                refine: bool = True) -> float:
    """Arg-max of the profile on the grid, then (``refine``) on a 20x finer grid around it. While
    the maximum is at an end of the grid the bracket is doubled; if it is still there at
    ``MAX_LAMBDA``, or the column is constant, there is no maximum and that is an error. An
    explicit ``lambdas`` grid is searched as given, but its ends must not win either. Only the
    profile (one row per lambda) reaches the driver."""
    grid = list(lambdas) if lambdas is not None else default_lambdas()
    best, reach = _peak(df, col, grid, shift), 2.0
    while lambdas is None and best in (grid[0], grid[-1]) and reach < MAX_LAMBDA:
        reach *= 2
        grid = default_lambdas(-reach, reach, reach / 20)
        best = _peak(df, col, grid, shift)
    if best is None or len(grid) > 1 and best in (grid[0], grid[-1]):
        raise ValueError(f"the Box-Cox likelihood of {col} has no maximum inside "
                         f"[{grid[0]}, {grid[-1]}]")
    step = abs(grid[1] - grid[0]) if len(grid) > 1 else 0
    while refine and step > 0.01:
        best = _peak(df, col, [round(best - step + i * step / 10.0, 10) for i in range(21)], shift)
        step /= 10
    return float(best)


def boxcox(df: DataFrame, col: str, out: str, lam: float | None = None, lambdas=None,
           shift: float | None = 0.0, refine: bool = True) -> DataFrame:
    """Add ``out`` = Box-Cox of ``col + shift`` with ``lam`` (or lambda by maximum likelihood).
    ``shift=None`` uses ``1 + abs(min(col))`` so the input is positive."""
    s = shift_for(df, col) if shift is None else shift
    if lam is None:
        lam = best_lambda(df, col, lambdas, s, refine)
    return df.withColumn(out, boxcox_value(F.col(col).cast("double") + F.lit(float(s)), lam))
