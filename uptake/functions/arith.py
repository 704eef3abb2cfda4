"""Scalar column expressions with the reference's null / NaN / infinity rules.

Spark runs with ANSI mode on, so a bare ``/`` by zero throws and ``ln(0)`` is
NULL. The helpers below reproduce what the numpy-based original computes
without ever switching ANSI off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POS_INF = float("inf")
NEG_INF = float("-inf")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(x, y) -> Column:
    """ratio with the zero rule of the original ``divider``.

    * x + y == 0          -> 0   (so 0/0 and x/-x give 0)
    * y == 0, x != 0      -> +inf or -inf with the sign of x
    * otherwise           -> x / y (doubles, no integer truncation)
    * a NULL input        -> NULL (also NULL / 0)
    """
    xd = _c(x).cast("double")
    yd = _c(y).cast("double")
    return (
        F.when(xd + yd == 0, F.lit(0.0))
        .when(yd == 0, F.when(xd > 0, F.lit(POS_INF)).when(xd < 0, F.lit(NEG_INF)))
        .otherwise(F.try_divide(xd, yd))
    )


def ln_inf(x) -> Column:
    """natural log as numpy computes it: ln(0) = -inf, negative -> NaN."""
    xd = _c(x).cast("double")
    return (
        F.when(xd == 0, F.lit(NEG_INF))
        .when(xd < 0, F.lit(float("nan")))
        .otherwise(F.ln(xd))
    )


def row_sum(*cols) -> Column:
    """F8: row sum over columns that skips NULLs (pandas ``sum(axis=1)``)."""
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(_c(c).cast("double"), F.lit(0.0))
    return total


def round_half_even(x, scale: int = 3) -> Column:
    """pandas/numpy ``round`` is half-to-even."""
    return F.bround(_c(x), scale)


def to_number(x, dtype: str = "double") -> Column:
    """text to number, NULL where it does not parse (``<5``, ``>10``)."""
    return _c(x).try_cast(dtype)


def nan_to_null(x) -> Column:
    """pandas NaN is a missing value; Spark keeps NaN distinct from NULL."""
    return F.nanvl(_c(x).cast("double"), F.lit(None).cast("double"))


def finite_or_null(x) -> Column:
    """+-inf and NaN become NULL (``replace([inf, -inf], nan)``)."""
    xd = nan_to_null(x)
    return F.when(F.abs(xd) == F.lit(POS_INF), F.lit(None).cast("double")).otherwise(xd)


def share_true(pred) -> Column:
    """A13 aggregate: share of rows where ``pred`` holds; NULL counts as false."""
    return F.avg(F.coalesce(_c(pred), F.lit(False)).cast("double"))


def ieee_divide(x, y) -> Column:
    """Plain floating division as pandas does it: x/0 -> +-inf, 0/0 -> missing (NULL)."""
    xd = _c(x).cast("double")
    yd = _c(y).cast("double")
    return F.when(yd == 0, F.when(xd > 0, F.lit(POS_INF)).when(xd < 0, F.lit(NEG_INF))).otherwise(
        F.try_divide(xd, yd)
    )
