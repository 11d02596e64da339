"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent_one_decimal(part, total) -> Column:
    """Share in percent with one decimal, rounded half up:
    ``floor(part*1000/total + 0.5) / 10``; a zero or null total gives 0.0."""
    ratio = F.try_divide(_c(part).cast("double") * F.lit(1000.0), _c(total).cast("double"))
    return F.coalesce(F.floor(ratio + F.lit(0.5)) / F.lit(10.0), F.lit(0.0))


def to_int_or_null(c) -> Column:
    """Text key -> INT, null when not a number."""
    return _c(c).try_cast("int")


def money(c) -> Column:
    """Money sums are compared through DECIMAL(18,2)."""
    return _c(c).cast("decimal(18,2)")
