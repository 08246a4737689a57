"""Exact rounding and NULL-safe division.

Ratios of sums are rounded half away from zero in integer arithmetic, so
the result does not depend on floating point or on intermediate decimal
scales (a decimal quotient rounded at scale 6 and then at scale 2 can be
off by one in the last digit). The rounded value is returned as a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_zero(c: str | Column) -> Column:
    """``nullif(c, 0)``: a zero denominator becomes NULL instead of raising."""
    col = _c(c)
    return F.when(col != 0, col)


def exact_ratio(num: str | Column, den: str | Column, num_scale: int = 0, factor: int = 1, digits: int = 2) -> Column:
    """``round(num * factor / den, digits)`` half away from zero, as double.

    ``num`` is an integer or a decimal with ``num_scale`` fraction digits,
    ``den`` an integer. NULL when ``den`` is 0 or NULL, or ``num`` is NULL.
    """
    a = (_c(num) * (10**num_scale)).cast("long") * (factor * 10**digits)
    b = nullif_zero(den).cast("long") * (10**num_scale)
    div = lambda x, y: F.call_function("div", x, y)
    q = F.when(a >= 0, div(2 * a + b, 2 * b)).otherwise(-div(-2 * a + b, 2 * b))
    return (q / F.lit(float(10**digits))).cast("double")


def sql_exact_ratio(num: str, den: str, num_scale: int = 0, factor: int = 1, digits: int = 2) -> str:
    """The same rounding rule as Spark SQL text."""
    a = f"(CAST(({num}) * {10**num_scale} AS BIGINT) * {factor * 10**digits})"
    b = f"(CAST(NULLIF({den}, 0) AS BIGINT) * {10**num_scale})"
    return (
        f"CAST(CASE WHEN {a} >= 0 THEN (2 * {a} + {b}) div (2 * {b}) "
        f"ELSE -((-2 * {a} + {b}) div (2 * {b})) END / {float(10**digits)} AS DOUBLE)"
    )
