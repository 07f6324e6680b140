"""Daily series of orders, and waiting lines of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.operators import queueing as q
from tarnworks.operators import series as s
from tarnworks.sources.tables import table

DAY_SECONDS = 86400.0


def day_log(spark, d) -> DataFrame:
    """One row per priority and order day: turnover as the distance, a clock text from
    the number of orders, missing on days with a single one."""
    days = table(spark, d, "orders").groupBy(
        F.col("o_orderpriority").alias("priority"), F.to_date("o_orderdate").alias("Date")
    )
    n = F.count(F.lit(1))
    clock = F.format_string("%d:%02d:%02d", (n / 60).cast("bigint"), n % 60, n * 7 % 60)
    return days.agg(
        F.round(F.sum("o_totalprice") / 100000, 7).alias("Miles"),
        F.when(n > 1, clock).alias("Time"),
    )


def full_series(spark, d) -> DataFrame:
    """The day log with all columns derived and the gaps of each priority filled."""
    return s.add_duration(
        s.fill_days(s.describe_days(day_log(spark, d)), keys=["priority"])
    )


def _day() -> Column:
    return F.date_format("Date", "yyyy-MM-dd").alias("day")


def daily_spine(spark, d):
    return full_series(spark, d).select(
        "priority", _day(), F.round("Miles", 7).alias("miles"), "day_of_week", "month", "y_m",
        F.round("km", 4).alias("km"), "seconds", F.round("minutes", 6).alias("minutes"),
    )


def month_counts(spark, d):
    return s.value_counts(full_series(spark, d), "month")


def monthly_mean(spark, d):
    return _mean(s.group_mean(full_series(spark, d), "month", "Miles"))


def year_month_mean(spark, d):
    return _mean(s.group_mean(full_series(spark, d), "y_m", "Miles"))


def _mean(means: DataFrame) -> DataFrame:
    return means.withColumn("mean", F.round("mean", 6))


def rolling_std(spark, d):
    rolled = s.rolling_std(full_series(spark, d), "Miles", ["Date"], ["priority"])
    return rolled.select("priority", _day(), "pos", F.round("rolling_std", 6).alias("rolling_std"))


def longest_days(spark, d):
    return full_series(spark, d).orderBy(F.desc("Miles"), "Date", "priority").limit(20).select(
        "priority", _day(), F.round("Miles", 7).alias("miles")
    )


def _seconds(ts: str) -> Column:
    """Seconds since 1970 of a zone-less time."""
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return (F.unix_date(F.to_date(ts)) * DAY_SECONDS + clock).cast("double")


def arrivals(spark, d) -> DataFrame:
    """Events as jobs of one server per type; service time in seconds from the value."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("server"),
        F.col("event_id").alias("id"),
        _seconds("ts").alias("arrival"),
        F.round(F.col("value") * 20).alias("service"),
    )


def queue_schedule(spark, d):
    return q.schedule(arrivals(spark, d))


def queue_cutoff(spark, d):
    # fifteen days after the start of the stream's month
    return q.schedule(arrivals(spark, d), cutoff=1704067200 + 15 * DAY_SECONDS)


# --- SQL twins -------------------------------------------------------------------

SERIES = """WITH logged AS MATERIALIZED (
  SELECT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS d,
    round(sum(o_totalprice) / 100000, 7) AS miles, count(*) AS n FROM orders GROUP BY 1, 2),
spine AS (SELECT priority, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT priority, min(d) AS lo, max(d) AS hi FROM logged GROUP BY priority)),
days AS MATERIALIZED (
  SELECT s.priority, s.d, strftime(s.d, '%Y-%m-%d') AS day, coalesce(l.miles, 0) AS miles,
    strftime(l.d, '%A') AS day_of_week, strftime(l.d, '%B') AS month, strftime(l.d, '%Y-%m') AS y_m,
    l.miles * 1.60934::DOUBLE AS km,
    CASE WHEN n > 1 THEN (n // 60) * 3600 + (n % 60) * 60 + n * 7 % 60 END AS seconds
  FROM spine s LEFT JOIN logged l ON l.priority = s.priority AND l.d = s.d)"""

QUEUE = """WITH jobs AS MATERIALIZED (
  SELECT event_type AS server, event_id AS id, CAST(floor(epoch(ts)) AS DOUBLE) AS arrival,
    round(value * 20) AS service FROM events),
work AS (SELECT *, sum(service) OVER (PARTITION BY server ORDER BY arrival, id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS work FROM jobs),
timed AS (SELECT *, work + max(arrival - (work - service)) OVER (PARTITION BY server
  ORDER BY arrival, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done FROM work),
line AS (SELECT server, id, arrival, service, done - service AS start, done AS "end",
  done - service - arrival AS wait,
  lag(done) OVER (PARTITION BY server ORDER BY arrival, id) AS before FROM timed)
SELECT server, id, arrival, service, start, "end", wait FROM line"""

QUERIES = {
    "daily_spine": (
        daily_spine,
        f"""{SERIES} SELECT priority, day, round(miles, 7) AS miles, day_of_week, month, y_m,
round(km, 4) AS km, seconds, round(seconds / 60::DOUBLE, 6) AS minutes FROM days""",
    ),
    "month_counts": (
        month_counts,
        f"{SERIES} SELECT month, count(*) AS n FROM days WHERE month IS NOT NULL GROUP BY month",
    ),
    "monthly_mean": (
        monthly_mean,
        f"{SERIES} SELECT month, round(avg(miles), 6) AS mean FROM days WHERE month IS NOT NULL GROUP BY month",
    ),
    "year_month_mean": (
        year_month_mean,
        f"{SERIES} SELECT y_m, round(avg(miles), 6) AS mean FROM days WHERE y_m IS NOT NULL GROUP BY y_m",
    ),
    "rolling_std": (
        rolling_std,
        f"""{SERIES} SELECT priority, day, row_number() OVER (PARTITION BY priority ORDER BY d) - 1 AS pos,
round(CASE WHEN count(*) OVER w = 7 THEN stddev_samp(miles) OVER w END, 6) AS rolling_std
FROM days WINDOW w AS (PARTITION BY priority ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    ),
    "longest_days": (
        longest_days,
        f"""{SERIES} SELECT priority, day, round(miles, 7) AS miles FROM days
ORDER BY days.miles DESC, d, priority LIMIT 20""",
    ),
    "queue_schedule": (queue_schedule, QUEUE),
    "queue_cutoff": (
        queue_cutoff, f"{QUEUE} WHERE before IS NULL OR before < 1704067200 + 15 * 86400"
    ),
}
