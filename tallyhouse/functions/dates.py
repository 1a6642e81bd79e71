"""Date and duration expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import file_stem

MICROS_PER_DAY = 86_400_000_000


def _micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def days_between(start: Column, end: Column) -> Column:
    """Fractional days, microseconds kept; NULL if either side is."""
    return _micros(start, end) / F.lit(float(MICROS_PER_DAY))


def hours_between(start: Column, end: Column) -> Column:
    """Hours rounded to two digits."""
    hours = _micros(start, end).cast("decimal(38,10)") / F.lit(3_600_000_000)
    return F.round(hours, 2).cast("decimal(10,2)")


def mean_days(days: Column) -> Column:
    """Mean of fractional days, summed as whole microseconds.

    A sum of doubles depends on the order tasks finish in; this one does not, and
    as a decimal it does not run over.
    """
    micros = F.round(days * F.lit(float(MICROS_PER_DAY))).cast("decimal(20,0)")
    total = F.sum(micros).cast("double") / F.lit(float(MICROS_PER_DAY))
    return total / F.nullif(F.count(days), F.lit(0)).cast("double")


def file_date(name: Column) -> Column:
    """First ``_``-part of a file name that is a year-month-day date, else NULL."""
    shaped = F.filter(F.split(file_stem(name), "_"), lambda p: p.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"))
    dates = F.transform(shaped, lambda p: F.try_to_timestamp(p, F.lit("y-M-d")).cast("date"))
    return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))
