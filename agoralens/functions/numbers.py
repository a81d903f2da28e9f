"""Small numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TIE_NUDGE = 1e-9


def settle(value: Column, digits: int) -> Column:
    """Round so that runs agree.

    Distributed sums arrive in any order, which moves the last bits of a double and can flip an
    exact half either way. A nudge far below the kept digits makes every half go up.
    """
    return F.round(value + F.lit(TIE_NUDGE), digits)


def ratio(top: Column, bottom: Column) -> Column:
    """`top / bottom`, NULL where the bottom is 0 (ANSI mode would fail the job)."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over rows with both values; NULL when a side does not vary.

    Spark's `corr` raises under ANSI when a side is constant, so it is built from moments.
    """
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    y = (F.col(y) if isinstance(y, str) else y).cast("double")
    spread = F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x))
    return F.try_divide(F.regr_sxy(y, x), spread)
