"""Click-through queries over the event stream.

A view is an email link sent, a click is a click; ``k`` of the properties is the
article, a user's day is one email.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.calendar import week_label, week_number
from tarnworks.operators import rates as r
from tarnworks.session import checkpoint
from tarnworks.sources.lines import add_week, parse_clicks
from tarnworks.sources.tables import table


def _events(spark, d) -> DataFrame:
    return table(spark, d, "events").withColumn(
        "article_id", F.get_json_object("props", "$.k").cast("int")
    )


def emails(spark, d) -> DataFrame:
    sent = _events(spark, d).filter("event_type = 'view'").select(
        "user_id",
        F.date_format("ts", "yyyyMMdd").cast("int").alias("email_id"),
        "article_id",
        F.col("ts").alias("send_time"),
    )
    return add_week(sent)


def clicks(spark, d) -> DataFrame:
    return _events(spark, d).filter("event_type = 'click'").select(
        F.col("ts").alias("click_time"),
        week_label(F.col("ts")).alias("week_num"),
        "article_id",
        "user_id",
        F.when(F.col("value") < 5, 0).otherwise(200).alias("status"),
        F.length("props").alias("bsize"),
    )


def _kinds(spark, d) -> DataFrame:
    """Events of all kinds, so that articles and users can be told from their counts."""
    kind = F.col("event_type")
    return _events(spark, d).select(
        "user_id",
        F.when(kind == "view", F.date_format("ts", "yyyyMMdd").cast("int")).alias("email_id"),
        "article_id",
        week_label(F.col("ts")).alias("week_num"),
        F.when(kind == "view", "sent").otherwise(kind).alias("kind"),
        F.when(F.col("value") < 5, 0).otherwise(200).alias("status"),
    )


def week_facts(spark, d) -> DataFrame:
    return checkpoint(r.facts_by_week(_kinds(spark, d)))


def link_facts(spark, d) -> DataFrame:
    return checkpoint(r.facts_by_link(_kinds(spark, d)))


def articles(facts: DataFrame) -> DataFrame:
    known = facts.select("article_id").distinct()
    return known.select(
        "article_id",
        (F.col("article_id") * 7 % 50).alias("author_id"),
        (F.col("article_id") % 4).alias("type_id"),
        (F.col("article_id") % 10).alias("topic_id"),
    )


def topics(facts: DataFrame) -> DataFrame:
    known = articles(facts).select("topic_id").distinct()
    return known.withColumn("name", F.concat(F.lit("topic "), "topic_id"))


def types(facts: DataFrame) -> DataFrame:
    known = articles(facts).select("type_id").distinct()
    return known.withColumn("name", F.concat(F.lit("type "), "type_id"))


def users(facts: DataFrame) -> DataFrame:
    known = facts.select("user_id").distinct()
    return known.withColumn("email", F.concat(F.lit("u"), "user_id", F.lit("@example.org")))


def _weekly(spark, d, by: str) -> DataFrame:
    facts = week_facts(spark, d)
    names = topics(facts) if by == "topic_id" else types(facts)
    return r.rates_by_week(facts, articles(facts), names, by)


def weekly_rate(spark, d):
    return _weekly(spark, d, "topic_id").withColumn("rate", F.round("rate", 9))


def weekly_rate_by_type(spark, d):
    return _weekly(spark, d, "type_id").withColumn("rate", F.round("rate", 9))


def _trend(spark, d) -> DataFrame:
    trend = r.rate_trend(_weekly(spark, d, "topic_id"))
    return trend.select(
        "category",
        *[F.round(c, 7).alias(c) for c in ("change_rate", "mean_rate", "change_pct")],
    )


def rate_trend(spark, d):
    return _trend(spark, d)


def notable_changes(spark, d):
    return r.notable_changes(_trend(spark, d))


def most_falling(spark, d):
    return r.most_falling(_trend(spark, d))


def most_rising(spark, d):
    return r.most_rising(_trend(spark, d))


def category_rates(spark, d):
    return r.category_rates(weekly_rate(spark, d), "topic 3")


def email_rates(spark, d):
    facts = link_facts(spark, d)
    rates = r.rates_by_email(facts, articles(facts))
    return rates.withColumn("rate", F.round("rate", 9))


def email_positions(spark, d):
    return r.email_positions(emails(spark, d))


def _user_trend(facts: DataFrame, **options) -> DataFrame:
    return r.trend_by_user(facts, articles(facts), **options).withColumn("slope", F.round("slope", 7))


def user_trend(spark, d):
    return _user_trend(link_facts(spark, d))


def user_trend_options(spark, d):
    return _user_trend(link_facts(spark, d), include_last=True, dedupe_clicks=True)


def user_trend_named(spark, d):
    facts = link_facts(spark, d)
    return r.name_user_trend(_user_trend(facts), topics(facts), users(facts), "topic_id")


def user_top_changes(spark, d):
    return r.user_top_changes(user_trend_named(spark, d))


def check_sent_once(spark, d):
    return r.sent_once(emails(spark, d))


def check_author_clicks(spark, d):
    return r.author_clicks(clicks(spark, d), articles(_events(spark, d)))


def check_status(spark, d):
    return r.status_counts(clicks(spark, d))


def check_total_clicks(spark, d):
    return clicks(spark, d).agg(F.count(F.lit(1)).alias("clicks"))


def users_per_week(spark, d):
    return r.users_per_week(emails(spark, d))


def emails_per_user(spark, d):
    stats = r.emails_per_user(emails(spark, d))
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


def log_parse(spark, d):
    event = _events(spark, d)
    line = F.format_string(
        '[%s] "GET /click?article_id=%d&user_id=%d HTTP/1.1" %d %d',
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        "article_id",
        "user_id",
        F.when(F.col("value") < 5, 404).otherwise(200),
        F.length("props"),
    )
    parsed = parse_clicks(event.select(line.alias("value")))
    time = F.date_format("click_time", "yyyy-MM-dd HH:mm:ss")
    return parsed.withColumn("click_time", time)


def week_labels(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    week = week_label(F.col("day"))
    return days.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        week.alias("week"),
        week_number(week).alias("number"),
    )


# --- SQL twins -------------------------------------------------------------------

WEEK = "strftime({t}, '%Y') || '_' || lpad(CAST(CAST(strftime({t}, '%W') AS INTEGER) + 1 AS VARCHAR), 2, '0')"
EVENTS = f"""ev AS MATERIALIZED (
  SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS article_id,
    {WEEK.format(t="ts")} AS week FROM events),
emails AS (SELECT user_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS email_id, article_id, week
  FROM ev WHERE event_type = 'view'),
clicks AS (SELECT user_id, article_id, week, CASE WHEN value < 5 THEN 0 ELSE 200 END AS status
  FROM ev WHERE event_type = 'click')"""


def _weekly_sql(modulus: int, kind: str) -> str:
    return f"""WITH {EVENTS},
sent AS (SELECT week, '{kind} ' || article_id % {modulus} AS category, count(*) AS n_send FROM emails GROUP BY 1, 2),
hit AS (SELECT week, '{kind} ' || article_id % {modulus} AS category, count(*) AS n_click FROM clicks GROUP BY 1, 2),
weekly AS (
  SELECT s.week, s.category, n_send, coalesce(n_click, 0) AS n_click,
    coalesce(n_click, 0) / CAST(n_send AS DOUBLE) AS rate
  FROM sent s LEFT JOIN hit c ON c.week = s.week AND c.category = s.category WHERE n_send >= 10)"""


TREND = _weekly_sql(10, "topic") + """,
raw AS (SELECT category, CASE WHEN count(*) < 2 THEN 0
    ELSE regr_slope(rate, CAST(substr(week, 6) AS INTEGER)) END AS change_rate, avg(rate) AS mean_rate
  FROM weekly GROUP BY category),
trend AS MATERIALIZED (SELECT category, round(change_rate, 7) AS change_rate, round(mean_rate, 7) AS mean_rate,
  round(CASE WHEN mean_rate <> 0 THEN 100 * change_rate / mean_rate END, 7) AS change_pct FROM raw)
SELECT category, change_rate, mean_rate, change_pct FROM trend"""

WEEKLY_COLUMNS = " SELECT week, category, n_send, n_click, round(rate, 9) AS rate FROM weekly"


def _user_sql(last: int, dedupe: bool) -> str:
    if dedupe:
        copies = """(SELECT user_id, article_id, max(status) AS status FROM clicks GROUP BY ALL)"""
    else:
        copies = "clicks"
    return f"""WITH {EVENTS},
joined AS MATERIALIZED (SELECT e.user_id, e.email_id, e.article_id % 10 AS category, c.status
  FROM emails e LEFT JOIN {copies} c ON c.user_id = e.user_id AND c.article_id = e.article_id),
per_email AS MATERIALIZED (
  SELECT user_id, email_id, category, count(*) AS m_send, count(*) FILTER (status > 0) AS m_click,
    count(*) FILTER (status > 0) / CAST(count(*) AS DOUBLE) AS rate FROM joined GROUP BY ALL),
places AS MATERIALIZED (SELECT user_id, email_id,
    row_number() OVER (PARTITION BY user_id ORDER BY email_id) - 1 AS idx,
    count(*) OVER (PARTITION BY user_id) AS n
  FROM (SELECT DISTINCT user_id, email_id FROM emails)),
pairs AS (SELECT DISTINCT user_id, category FROM per_email),
grid AS MATERIALIZED (SELECT p.user_id, p.category, l.idx, l.n, e.rate FROM pairs p
  JOIN places l ON l.user_id = p.user_id
  LEFT JOIN per_email e ON e.user_id = p.user_id AND e.email_id = l.email_id AND e.category = p.category),
smooth AS (SELECT user_id, category, idx, n, avg(rate) OVER (
    PARTITION BY user_id, category ORDER BY idx ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS mean FROM grid),
slopes AS MATERIALIZED (SELECT user_id, category,
    round(CASE WHEN count(mean) FILTER (idx + 5 < n + {last}) >= 2
      THEN regr_slope(mean, idx) FILTER (idx + 5 < n + {last}) END, 7) AS slope
  FROM smooth GROUP BY user_id, category)"""


QUERIES = {
    "weekly_rate": (weekly_rate, _weekly_sql(10, "topic") + WEEKLY_COLUMNS),
    "weekly_rate_by_type": (weekly_rate_by_type, _weekly_sql(4, "type") + WEEKLY_COLUMNS),
    "rate_trend": (rate_trend, TREND),
    "notable_changes": (notable_changes, f"{TREND} WHERE abs(change_pct) >= 5"),
    "most_falling": (
        most_falling, f"{TREND} WHERE abs(change_pct) > 0 ORDER BY change_pct, category LIMIT 5"
    ),
    "most_rising": (
        most_rising, f"{TREND} WHERE abs(change_pct) > 0 ORDER BY change_pct DESC, category LIMIT 5"
    ),
    "category_rates": (
        category_rates, _weekly_sql(10, "topic") + WEEKLY_COLUMNS + " WHERE category = 'topic 3'"
    ),
    "email_rates": (
        email_rates,
        _user_sql(0, False) + """ SELECT user_id, email_id, CAST(category AS INTEGER) AS category,
m_send, m_click, round(rate, 9) AS rate FROM per_email""",
    ),
    "email_positions": (
        email_positions, _user_sql(0, False) + " SELECT user_id, email_id, idx FROM places"
    ),
    "user_trend": (
        user_trend,
        _user_sql(0, False) + " SELECT user_id, CAST(category AS INTEGER) AS category, slope FROM slopes",
    ),
    "user_trend_options": (
        user_trend_options,
        _user_sql(1, True) + " SELECT user_id, CAST(category AS INTEGER) AS category, slope FROM slopes",
    ),
    "user_trend_named": (
        user_trend_named,
        _user_sql(0, False) + """ SELECT user_id, 'u' || user_id || '@example.org' AS email,
'topic ' || category AS name, slope FROM slopes WHERE abs(slope) > 0""",
    ),
    "user_top_changes": (
        user_top_changes,
        _user_sql(0, False) + """ SELECT user_id, 'u' || user_id || '@example.org' AS email,
'topic ' || category AS name, slope, CAST(row_number() OVER (PARTITION BY user_id
  ORDER BY slope DESC, 'topic ' || category) AS INTEGER) AS place
FROM slopes WHERE abs(slope) > 0 QUALIFY place <= 5""",
    ),
    "check_sent_once": (
        check_sent_once,
        f"""WITH {EVENTS} SELECT max(n) AS max_sent FROM
(SELECT count(*) AS n FROM emails GROUP BY user_id, article_id)""",
    ),
    "check_author_clicks": (
        check_author_clicks,
        f"WITH {EVENTS} SELECT count(*) AS author_clicks FROM clicks WHERE user_id = article_id * 7 % 50",
    ),
    "check_status": (
        check_status, f"WITH {EVENTS} SELECT status, count(*) AS cnt FROM clicks GROUP BY status"
    ),
    "check_total_clicks": (
        check_total_clicks, "SELECT count(*) AS clicks FROM events WHERE event_type = 'click'"
    ),
    "users_per_week": (
        users_per_week,
        f"WITH {EVENTS} SELECT week AS week_num, count(DISTINCT user_id) AS users FROM emails GROUP BY week",
    ),
    "emails_per_user": (
        emails_per_user,
        f"""WITH {EVENTS}, n AS (SELECT user_id, count(DISTINCT email_id) AS n FROM emails GROUP BY user_id)
SELECT count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n) AS min,
  round(quantile_cont(n, 0.25), 6) AS q25, round(quantile_cont(n, 0.5), 6) AS q50,
  round(quantile_cont(n, 0.75), 6) AS q75, max(n) AS max FROM n""",
    ),
    "log_parse": (
        log_parse,
        f"""WITH {EVENTS} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS click_time, week AS week_num,
article_id, CAST(user_id AS INTEGER) AS user_id, CASE WHEN value < 5 THEN 404 ELSE 200 END AS status,
CAST(length(props) AS INTEGER) AS bsize FROM ev""",
    ),
    "week_labels": (
        week_labels,
        f"""WITH days AS (SELECT DISTINCT o_orderdate AS t FROM orders)
SELECT DISTINCT strftime(t, '%Y-%m-%d') AS day, {WEEK.format(t="t")} AS week,
CAST(strftime(t, '%W') AS INTEGER) + 1 AS number FROM days""",
    ),
}
