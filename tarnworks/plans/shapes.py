"""Plain projections, filters and small reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnworks.functions.calendar import day_name, month_name, year_month
from tarnworks.sources.tables import register_views, run_sql, table


def scaled_filter(spark, d):
    """Scale a column, keep a range of the result."""
    doubled = table(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") * 2).alias("x2"))
    return doubled.filter("x2 > 600000")


def range_count(spark, d):
    """Count the rows that pass two nested range filters."""
    kept = scaled_filter(spark, d)
    return kept.filter("x2 < 700000").agg(F.count(F.lit(1)).alias("n"))


def null_safe_ratio(spark, d):
    lines = table(spark, d, "lineitem")
    sums = lines.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if((F.col("l_returnflag") == "A") & (F.col("l_quantity") > 48)).alias("large"),
    )
    ratio = F.try_divide(F.col("returned").cast("double"), "large")
    return sums.withColumn("ratio", F.round(ratio, 9))


def filled_left_join(spark, d):
    """Orders per customer with 0 where there is none."""
    per = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    joined = customers.join(per, "c_custkey", "left").na.fill({"orders": 0})
    return joined.withColumnRenamed("c_name", "customer").select("c_custkey", "customer", "orders")


def column_bounds(spark, d):
    return table(spark, d, "orders").agg(
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last"),
        (F.max("o_custkey") + 1).alias("next_id"),
    )


def distinct_rows(spark, d):
    return table(spark, d, "events").select("user_id", "event_type").distinct()


def largest_group(spark, d):
    per = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max("n").alias("largest"))


def date_names(spark, d):
    day = F.to_date("o_orderdate")
    named = table(spark, d, "orders").select(
        day_name(day).alias("day"), month_name(day).alias("month"), year_month(day).alias("y_m")
    )
    return named.groupBy("day", "month", "y_m").agg(F.count(F.lit(1)).alias("n"))


def top_values(spark, d):
    """The ten dearest orders."""
    return (
        table(spark, d, "orders")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(10)
        .select("o_orderkey", "o_totalprice")
    )


def sql_view(spark, d):
    """A report written in SQL over the registered tables."""
    register_views(spark, d)
    return run_sql(spark, SQL_REPORT)


SQL_REPORT = """SELECT r_name, count(*) AS customers, round(avg(c_acctbal), 4) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name"""

QUERIES = {
    "scaled_filter": (
        scaled_filter,
        "SELECT o_orderkey, o_totalprice * 2 AS x2 FROM orders WHERE o_totalprice * 2 > 600000",
    ),
    "range_count": (
        range_count,
        "SELECT count(*) AS n FROM orders WHERE o_totalprice * 2 > 600000 AND o_totalprice * 2 < 700000",
    ),
    "null_safe_ratio": (
        null_safe_ratio,
        """SELECT l_suppkey, returned, large, round(CAST(returned AS DOUBLE) / nullif(large, 0), 9) AS ratio
FROM (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned,
  count(*) FILTER (l_returnflag = 'A' AND l_quantity > 48) AS large FROM lineitem GROUP BY l_suppkey)""",
    ),
    "filled_left_join": (
        filled_left_join,
        """SELECT c_custkey, c_name AS customer, coalesce(n, 0) AS orders FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    ),
    "column_bounds": (
        column_bounds,
        """SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS first,
strftime(max(o_orderdate), '%Y-%m-%d') AS last, max(o_custkey) + 1 AS next_id FROM orders""",
    ),
    "distinct_rows": (distinct_rows, "SELECT DISTINCT user_id, event_type FROM events"),
    "largest_group": (
        largest_group,
        "SELECT max(n) AS largest FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type)",
    ),
    "date_names": (
        date_names,
        """SELECT strftime(o_orderdate, '%A') AS day, strftime(o_orderdate, '%B') AS month,
strftime(o_orderdate, '%Y-%m') AS y_m, count(*) AS n FROM orders GROUP BY 1, 2, 3""",
    ),
    "top_values": (
        top_values,
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    ),
    "sql_view": (sql_view, SQL_REPORT),
}
