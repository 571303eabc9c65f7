"""Calendar attributes that have no single built-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_year_monday(d: Column) -> Column:
    """Week of the year with Monday as first day; days before the first Monday
    are week 0 (strftime ``%W``).  ``weekday`` is 0 for Monday."""
    return F.floor((F.dayofyear(d) + F.lit(6) - F.weekday(d)) / F.lit(7)).cast("int")


def iso_day_of_week(d: Column) -> Column:
    """Monday=1 .. Sunday=7."""
    return (F.weekday(d) + F.lit(1)).cast("int")


def day_of_week_as_coded(d: Column) -> Column:
    """Day number as the reference computes it: ``(dow + 6) % 7`` with 0 -> 7 on
    a Sunday=0 day number, i.e. Monday=7, Tuesday=1 .. Sunday=6 (see README)."""
    sunday0 = F.dayofweek(d) - F.lit(1)
    shifted = (sunday0 + F.lit(6)) % F.lit(7)
    return F.when(shifted == 0, F.lit(7)).otherwise(shifted).cast("int")
