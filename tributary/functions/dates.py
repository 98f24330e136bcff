"""Dates from text, range flags and day differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.fixed_values import DAYS_PER_YEAR, FIRST_DATE, FLAG_OK, FLAG_OUT_OF_RANGE

# days that a 64-bit count of nanoseconds around 1970 can hold
_EARLIEST, _LATEST = "1677-09-22", "2262-04-11"


def as_of_date(as_of=None) -> Column:
    """The given day, today without one."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def parsed_date(text: Column) -> Column:
    """Date in the first ten characters, null if there is none."""
    day = F.substring(text, 1, 10)
    shaped = F.when(day.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), day)
    date = F.try_to_date(shaped, "yyyy-M-d")
    return F.when(date.between(F.lit(_EARLIEST).cast("date"), F.lit(_LATEST).cast("date")), date)


def range_flag(date: Column, as_of=None, first: str = FIRST_DATE) -> Column:
    in_range = date.between(F.lit(first).cast("date"), as_of_date(as_of))
    return F.when(in_range, FLAG_OK).otherwise(FLAG_OUT_OF_RANGE)


def day_difference(left: Column, right: Column) -> Column:
    return F.abs(F.datediff(left, right))


def tenure_years(date: Column, as_of=None) -> Column:
    return F.datediff(as_of_date(as_of), date) / F.lit(DAYS_PER_YEAR)
