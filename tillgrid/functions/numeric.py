"""Numeric helpers: exact money, percent shares, ratios, month-on-month.

Convention shared with the SQL oracle: money is summed as DECIMAL(12,2)
(exact), only turned into DOUBLE in the final projection; every rounded ratio
is computed in DOUBLE and rounded HALF_UP through DECIMAL(38,10) so that ties
such as 50.005 round the same way in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Cast a source measure to exact cents."""
    return col(c).cast(MONEY)


def as_double(c: str | Column) -> Column:
    return col(c).cast("double")


def round_half_up(x: Column, digits: int) -> Column:
    """Decimal HALF_UP rounding of a DOUBLE, returned as DOUBLE."""
    return F.round(x.cast("decimal(38,10)"), digits).cast("double")


def ratio(num: str | Column, den: str | Column, digits: int) -> Column:
    """num/den rounded; NULL when the denominator is 0 or NULL."""
    return round_half_up(F.try_divide(as_double(num), as_double(den)), digits)


def pct(part: str | Column, total: str | Column, digits: int) -> Column:
    """Percent share; NULL when the total is 0 or NULL (SQL form)."""
    return round_half_up(F.try_divide(F.lit(100.0) * as_double(part), as_double(total)), digits)


def pct_or_zero(part: str | Column, total: str | Column, digits: int) -> Column:
    """P21 (pipeline form): 0.0 when the denominator is 0 or absent."""
    return F.coalesce(pct(part, total, digits), F.lit(0.0))


def mom_pct(cur: str | Column, prev: str | Column, digits: int = 2) -> Column:
    """(cur-prev)*100/prev; NULL on a zero or missing baseline."""
    return round_half_up(
        F.try_divide((as_double(cur) - as_double(prev)) * F.lit(100.0), as_double(prev)), digits)


def mom_pct_zero_baseline(cur: str | Column, prev: str | Column, digits: int = 2) -> Column:
    """The pipeline variant — 0.0 when the baseline is 0."""
    return F.when(as_double(prev) == 0, F.lit(0.0)).otherwise(mom_pct(cur, prev, digits))


def mom_list(values: Column, digits: int = 2) -> Column:
    """W4 over an ordered array: n-1 values, 0.0 on a zero baseline."""
    n = F.size(values)
    idx = F.sequence(F.lit(2), F.greatest(n, F.lit(2)))
    out = F.transform(
        idx,
        lambda i: F.when(F.element_at(values, i - 1).cast("double") == 0, F.lit(0.0)).otherwise(
            round_half_up((F.element_at(values, i).cast("double")
                           - F.element_at(values, i - 1).cast("double")) * F.lit(100.0)
                          / F.element_at(values, i - 1).cast("double"), digits)))
    return F.when(n >= 2, out).otherwise(F.array().cast("array<double>"))
