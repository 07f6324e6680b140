"""Daily series: gap filling, derived columns, monthly means, rolling deviation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.calendar import clock_seconds, daily, day_name, month_name, year_month
from tarnworks.operators.scale import HOT_ROWS, positions

KM_PER_MILE = 1.60934


def describe_days(runs: DataFrame) -> DataFrame:
    """Add day name, month name, year-month and kilometres to ``Date, Miles``."""
    return runs.withColumns(
        {
            "day_of_week": day_name(F.col("Date")),
            "km": F.col("Miles") * KM_PER_MILE,
            "month": month_name(F.col("Date")),
            "y_m": year_month(F.col("Date")),
        }
    )


def calendar_spine(days: DataFrame, date: str, keys: list[str]) -> DataFrame:
    """All dates between the first and the last one of each key."""
    bounds = days.groupBy(*keys).agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    return bounds.select(*keys, F.explode(daily(F.col("lo"), F.col("hi"))).alias(date))


def fill_days(
    days: DataFrame, date: str = "Date", keys: list[str] = (), zero: list[str] = ("Miles",)
) -> DataFrame:
    """Add the missing dates; ``zero`` columns become 0 there, all others null.
    Several rows on one date are all kept."""
    on = [*keys, date]
    missing = calendar_spine(days, date, list(keys)).join(days.select(*on), on, "left_anti")
    filled = days.unionByName(missing, allowMissingColumns=True)
    return filled.na.fill({c: 0.0 for c in zero})


def add_duration(days: DataFrame, time: str = "Time") -> DataFrame:
    """Seconds and minutes of an ``h:mm:ss`` column."""
    seconds = clock_seconds(F.col(time))
    return days.withColumn("seconds", seconds).withColumn("minutes", F.col("seconds") / 60)


def prepare_runs(runs: DataFrame) -> DataFrame:
    """The full daily series of a running log. Filled days have 0 miles but no month,
    so monthly figures skip them while the rolling deviation does not."""
    return add_duration(fill_days(describe_days(runs)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.orderBy(F.desc("n"), column)


def group_mean(df: DataFrame, column: str, value: str) -> DataFrame:
    """Mean per group; rows without a group drop out."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.avg(value).alias("mean"))


def rolling_std(
    days: DataFrame,
    value: str,
    order: list[str],
    keys: list[str] = (),
    window: int = 7,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sample deviation of the last ``window`` rows, null before there are as many.

    Adds ``pos`` and ``rolling_std``. Each row is handed to the windows it lies in,
    so no task needs a whole series.
    """
    keys = list(keys)
    placed = positions(days, keys, order, "pos", hot_rows)
    spread = placed.select(
        *keys,
        value,
        F.explode(F.sequence(F.col("pos"), F.col("pos") + (window - 1))).alias("pos"),
    )
    stats = spread.groupBy(*keys, "pos").agg(
        F.when(F.count(value) == window, F.stddev_samp(value)).alias("rolling_std")
    )
    return placed.join(stats, [*keys, "pos"], "left")
