"""Dates, weeks and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_year(ts: Column) -> Column:
    """Monday-first week number, 1-based; days before the first Monday are week 1."""
    return (F.floor((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7) + 1).cast("int")


def week_label(ts: Column) -> Column:
    """``2024_07`` style label of ``week_of_year``."""
    return F.concat_ws(
        "_", F.year(ts).cast("string"), F.lpad(week_of_year(ts).cast("string"), 2, "0")
    )


def week_number(label: Column) -> Column:
    """Week digits of a label as an integer."""
    return F.substring(label, 6, 8).cast("int")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def clock_seconds(text: Column) -> Column:
    """Seconds of an ``h:mm:ss`` text; null for any other text."""
    hours, minutes, seconds = (F.get(F.split(text, ":"), F.lit(i)).try_cast("long") for i in range(3))
    return hours * 3600 + minutes * 60 + seconds


def daily(first: Column, last: Column) -> Column:
    """Array of all dates from ``first`` to ``last``."""
    return F.sequence(first, last, F.expr("interval 1 day"))
