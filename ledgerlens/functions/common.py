"""Small Column helpers shared by the function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double; null when ``den`` is 0 or null (ANSI-safe)."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def money_sum(col: Column | str) -> Column:
    """Exact sum of an amount with two decimals: whole cents are added, so the
    result does not depend on the order of the rows."""
    return F.sum(F.round(as_col(col) * F.lit(100.0)).cast("bigint")).cast("double") / F.lit(100.0)


def pct(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """Rounded percentage ``num / den * 100``; null on a zero denominator."""
    return F.round(ratio(num, den) * F.lit(100.0), scale)
