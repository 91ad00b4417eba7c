"""Calendar keys of days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_day(ts: Column, minutes: int = 330) -> Column:
    """Day of a UTC time in a zone ``minutes`` ahead (5:30 by default)."""
    return (ts + F.make_interval(mins=F.lit(minutes))).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def year_start(day: Column) -> Column:
    return F.trunc(day, "year")


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def fortnight(day: Column) -> Column:
    """0 to 26: fourteen-day periods counted from 1 January; the last one has a day or two."""
    return F.floor((F.dayofyear(day) - 1) / 14).cast("int")
