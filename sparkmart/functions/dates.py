"""Calendar arithmetic with boundary-count semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sparkmart.functions.nulls import as_col

__all__ = ["trunc_to", "boundary_diff", "day_of_week", "month_of", "to_infinity", "add_months_ntz", "INFINITY"]

# Fixed value: the open end of a validity interval.
INFINITY = "9999-12-31"


def trunc_to(unit: str, c) -> Column:
    """date_trunc that stays TIMESTAMP_NTZ."""
    return F.date_trunc(unit, as_col(c)).cast("timestamp_ntz")


def month_of(c) -> Column:
    """First day of the month as a date."""
    return F.trunc(as_col(c), "month")


def boundary_diff(unit: str, start, end) -> Column:
    """Number of unit boundaries crossed between start and end.

    Spark's own datediff counts complete units; a warehouse DATEDIFF counts
    boundaries (Jan 31 to Feb 1 is one month). Weeks start on Monday.
    """
    start, end = as_col(start), as_col(end)
    unit = unit.lower()
    if unit == "day":
        return F.datediff(end, start)
    if unit == "week":
        return (F.datediff(F.trunc(end, "week"), F.trunc(start, "week")) / 7).cast("int")
    if unit == "year":
        return F.year(end) - F.year(start)
    if unit == "quarter":
        return (F.year(end) - F.year(start)) * 4 + F.quarter(end) - F.quarter(start)
    if unit == "month":
        return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return F.timestamp_diff(unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end))


def day_of_week(c) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(as_col(c)) - 1


def to_infinity(c) -> Column:
    """Open-ended interval end as a far-future timestamp."""
    return F.coalesce(as_col(c).cast("timestamp_ntz"), F.lit(INFINITY).cast("timestamp_ntz"))


def add_months_ntz(c, n: int) -> Column:
    """Month shift of a date."""
    return F.add_months(as_col(c), n)
