"""Numeric column helpers with exact, engine-independent rounding.

``ROUND(q::NUMERIC / h, 3)`` (half away from zero) is computed on integers:
for q >= 0, h > 0 the thousandths are ``(2000*q + h) div (2*h)``; a
negative q is rounded on its magnitude and the sign restored.  The average
of ratios held as integer thousandths t is rounded the same way:
``(2*sum(t) + n) div (2*n)``.  No floating-point step precedes the rounding,
so the result is identical whichever engine computes it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) half away from zero, for den > 0; BIGINT result."""
    mag = (F.abs(num) * 2 + den).cast("long")
    q = _int_div(mag, den * 2)
    return F.when(num < 0, -q).otherwise(q)


def _int_div(a: Column, b: Column) -> Column:
    """a div b for a >= 0, b > 0: subtract the remainder first, so the quotient is exact."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def ratio_thousandths(q: Column, h: Column) -> Column:
    """round(q / h, 3) * 1000 as BIGINT, NULL unless h > 0."""
    return F.when(h > 0, _half_up_div(q.cast("long") * 1000, h.cast("long")))


def thousandths_to_double(t: Column) -> Column:
    return t.cast("double") / F.lit(1000.0)


def round_ratio3(q: Column, h: Column) -> Column:
    """``CASE WHEN h > 0 THEN ROUND(q::NUMERIC / h, 3) END`` as DOUBLE."""
    return thousandths_to_double(ratio_thousandths(q, h))


def avg_thousandths_round3(t: Column) -> Column:
    """ROUND(AVG(t / 1000), 3) for integer thousandths t; NULL if no non-null t."""
    n = F.count(t)
    s = F.sum(t)
    return F.when(n > 0, thousandths_to_double(_half_up_div(s, n)))


def money_out(c: Column) -> Column:
    """Exact decimal money to the DOUBLE that reports and exports carry."""
    return c.cast("double")


def safe_mean(c: Column) -> Column:
    """Mean as DOUBLE = CAST(sum AS DOUBLE) / count; NULL for an empty or all-NULL group."""
    n = F.count(c)
    return F.when(n > 0, F.sum(c).cast("double") / n.cast("double"))
