"""Aggregate and ratio helpers shared by marts and questions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def flag(c: str | Column) -> Column:
    """A 0/1 flag with null counted as 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(0))


def rate(c: str | Column) -> Column:
    """Mean of a flag, null as 0."""
    return F.avg(flag(c))


def flag_count(c: str | Column) -> Column:
    """Number of set flags, null as 0."""
    return F.sum(flag(c)).cast("long")


def percent2(x: Column) -> Column:
    """x * 100 rounded to 2 places, in double arithmetic."""
    return F.round(x * F.lit(100.0), 2)


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; null on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round2(x: Column) -> Column:
    return F.round(x, 2)


def distinct(c: str | Column, rsd: float | None = None) -> Column:
    """Distinct count: exact, or with ``rsd`` (relative standard deviation) a
    HyperLogLog++ estimate, whose state is of one size whatever it counts."""
    col = F.col(c) if isinstance(c, str) else c
    return F.count_distinct(col) if rsd is None else F.approx_count_distinct(col, rsd)
