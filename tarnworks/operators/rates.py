"""Click-through rates by week and by user, and their trends.

Tables: ``emails`` (user_id, email_id, article_id, week_num), ``clicks`` (user_id,
article_id, week_num, status), ``articles`` (article_id and category id columns). The rates
start from counts of both kinds, made in one pass over one table of events: see ``tagged``,
``facts_by_week`` and ``facts_by_link``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.functions.calendar import week_number
from tarnworks.operators.scale import HOT_ROWS, positions
from tarnworks.session import checkpoint

MIN_SENT = 10
WINDOW = 5
KEYS = ("user_id", "email_id", "article_id")


def tagged(emails: DataFrame, clicks: DataFrame, *columns: str) -> DataFrame:
    """Links sent and clicks as rows of one table: ``kind`` is ``sent`` or ``click``."""
    sent = emails.select(*columns, F.lit("sent").alias("kind"), F.lit(None).cast("int").alias("status"))
    clicked = clicks.select(
        *[F.col(c) if c in clicks.columns else F.lit(None).alias(c) for c in columns],
        F.lit("click").alias("kind"), "status",
    )
    return sent.unionByName(clicked)


def facts_by_week(events: DataFrame) -> DataFrame:
    """``week_num, article_id, n_send, n_click`` in one pass over events of all kinds."""
    return events.groupBy("week_num", "article_id").agg(
        F.count_if(F.col("kind") == "sent").alias("n_send"),
        F.count_if(F.col("kind") == "click").alias("n_click"),
    )


def facts_by_link(events: DataFrame) -> DataFrame:
    """``user_id, email_id, article_id, kind, n, good`` in one pass over events of all kinds;
    ``good`` counts those with a status above 0."""
    return events.groupBy(*KEYS, "kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") > 0).alias("good")
    )


def rates_by_week(
    facts: DataFrame,
    articles: DataFrame,
    categories: DataFrame,
    by: str = "topic_id",
    min_sent: int = MIN_SENT,
) -> DataFrame:
    """``week, category, n_send, n_click, rate`` for groups with enough sends.

    ``facts`` comes from ``facts_by_week``, so a popular article meets the joins as one row
    per week. ``by`` is the category id column that ``articles`` and ``categories`` share.
    """
    named = facts.join(articles.select("article_id", by), "article_id").join(categories, by)
    counted = named.groupBy(F.col("week_num").alias("week"), F.col("name").alias("category")).agg(
        F.sum("n_send").alias("n_send"), F.sum("n_click").alias("n_click")
    )
    rate = F.try_divide(F.col("n_click").cast("double"), "n_send")
    return counted.filter(F.col("n_send") >= max(min_sent, 1)).withColumn("rate", rate)


def weekly_rate(
    emails: DataFrame,
    clicks: DataFrame,
    articles: DataFrame,
    categories: DataFrame,
    by: str = "topic_id",
    min_sent: int = MIN_SENT,
) -> DataFrame:
    """``rates_by_week`` where links sent and clicks are tables of their own."""
    facts = facts_by_week(tagged(emails, clicks, "week_num", "article_id"))
    return rates_by_week(facts, articles, categories, by, min_sent)


def slope(y: Column, x: Column) -> Column:
    """Least-squares slope; 0 for a single point."""
    return F.when(F.count(y) < 2, 0.0).otherwise(F.regr_slope(y, x.cast("double")))


def rate_trend(rates: DataFrame) -> DataFrame:
    """Slope over the weeks, mean rate and slope in percent of the mean per category."""
    trend = rates.groupBy("category").agg(
        slope(F.col("rate"), week_number(F.col("week"))).alias("change_rate"),
        F.avg("rate").alias("mean_rate"),
    )
    return trend.withColumn(
        "change_pct", F.try_divide(100 * F.col("change_rate"), F.col("mean_rate"))
    )


def notable_changes(trend: DataFrame, percent: float = 5.0) -> DataFrame:
    """Categories whose rate moves by at least ``percent`` of its mean, falling first."""
    return trend.filter(F.abs("change_pct") >= percent).orderBy("change_pct", "category")


def most_falling(trend: DataFrame, n: int = 5) -> DataFrame:
    moving = trend.filter(F.abs("change_pct") > 0)
    return moving.orderBy("change_pct", "category").limit(n)


def most_rising(trend: DataFrame, n: int = 5) -> DataFrame:
    moving = trend.filter(F.abs("change_pct") > 0)
    return moving.orderBy(F.desc("change_pct"), "category").limit(n)


def category_rates(rates: DataFrame, category: str) -> DataFrame:
    """The weekly rows of one category."""
    return rates.filter(F.col("category") == category).orderBy("week")


def rates_by_email(
    facts: DataFrame,
    articles: DataFrame,
    by: str = "topic_id",
    dedupe_clicks: bool = False,
) -> DataFrame:
    """Sends, clicks and rate per user, email and category.

    ``facts`` comes from ``facts_by_link``. A link clicked several times counts as sent
    that many times, unless ``dedupe_clicks``. Both sides are counted before they meet,
    so repeated rows are multiplied out as numbers rather than as rows.
    """
    sent = facts.filter("kind = 'sent'").select(*KEYS, F.col("n").alias("sends"))
    hits = facts.filter("kind = 'click'").groupBy("user_id", "article_id").agg(
        F.sum("n").alias("hits"), F.sum("good").alias("good")
    )
    hit = F.coalesce("hits", F.lit(0))
    good = F.coalesce("good", F.lit(0))
    if dedupe_clicks:
        copies, good = F.lit(1), F.least(good, F.lit(1))
    else:
        copies = F.greatest(hit, F.lit(1))
    return (
        sent.join(hits, ["user_id", "article_id"], "left")
        .join(articles.select("article_id", F.col(by).alias("category")), "article_id")
        .groupBy("user_id", "email_id", "category")
        .agg(
            F.sum(F.col("sends") * copies).alias("m_send"),
            F.sum(F.col("sends") * good).alias("m_click"),
        )
        .withColumn("rate", F.try_divide(F.col("m_click").cast("double"), "m_send"))
    )


def email_rates(
    emails: DataFrame,
    clicks: DataFrame,
    articles: DataFrame,
    by: str = "topic_id",
    dedupe_clicks: bool = False,
) -> DataFrame:
    """``rates_by_email`` where links sent and clicks are tables of their own."""
    return rates_by_email(facts_by_link(tagged(emails, clicks, *KEYS)), articles, by, dedupe_clicks)


def email_positions(rates: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """0-based position of each email among the emails of its user."""
    emails = rates.select("user_id", "email_id").distinct()
    return positions(emails, ["user_id"], ["email_id"], "idx", hot_rows)


def forward_mean(
    series: DataFrame,
    keys: list[str],
    value: str,
    lengths: DataFrame,
    length_keys: list[str],
    window: int = WINDOW,
    include_last: bool = False,
) -> DataFrame:
    """Mean of the values at positions ``idx .. idx + window - 1``, missing ones skipped.

    ``lengths`` gives the series length ``n`` per ``length_keys``. The last full window
    is left out unless ``include_last``. Every value is handed to the windows it lies
    in, so the means are ordinary partial sums however long a series is.
    """
    spread = series.filter(F.col(value).isNotNull()).withColumn(
        "at", F.explode(F.sequence(F.greatest(F.col("idx") - (window - 1), F.lit(0)), F.col("idx")))
    )
    means = spread.groupBy(*keys, F.col("at").alias("idx")).agg(F.avg(value).alias("mean"))
    room = F.col("n") - window + (1 if include_last else 0)
    return means.join(lengths, length_keys).filter(F.col("idx") < room).drop("n")


def trend_by_user(
    facts: DataFrame,
    articles: DataFrame,
    by: str = "topic_id",
    window: int = WINDOW,
    include_last: bool = False,
    dedupe_clicks: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Slope of the smoothed click rate per user and category, for all users at once;
    null where fewer than two smoothed points exist. ``facts`` comes from ``facts_by_link``."""
    rates = checkpoint(rates_by_email(facts, articles, by, dedupe_clicks))
    places = email_positions(rates, hot_rows)
    lengths = places.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    series = rates.join(places, ["user_id", "email_id"])
    smooth = forward_mean(
        series, ["user_id", "category"], "rate", lengths, ["user_id"], window, include_last
    )
    slopes = smooth.groupBy("user_id", "category").agg(
        F.when(F.count("mean") >= 2, F.regr_slope("mean", F.col("idx").cast("double"))).alias(
            "slope"
        )
    )
    every = rates.select("user_id", "category").distinct()
    return every.join(slopes, ["user_id", "category"], "left")


def user_trend(emails: DataFrame, clicks: DataFrame, articles: DataFrame, **options) -> DataFrame:
    """``trend_by_user`` where links sent and clicks are tables of their own."""
    return trend_by_user(facts_by_link(tagged(emails, clicks, *KEYS)), articles, **options)


def name_user_trend(trend: DataFrame, categories: DataFrame, users: DataFrame, by: str) -> DataFrame:
    """Moving categories of each user with names and the user's address."""
    named = categories.select(F.col(by).alias("category"), "name")
    return (
        trend.filter(F.abs("slope") > 0)
        .join(named, "category")
        .join(users.select("user_id", "email"), "user_id", "left")
        .select("user_id", "email", "name", "slope")
    )


def user_top_changes(named: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` categories of each user that rise most, from ``name_user_trend``: with
    ``place``, 1 the strongest; equal slopes go by name. A user has as many rows as categories."""
    w = Window.partitionBy("user_id").orderBy(F.desc("slope"), "name")
    return named.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def sent_once(emails: DataFrame) -> DataFrame:
    """Most often any article was sent to one user (1 = every link is unique)."""
    pairs = emails.groupBy("user_id", "article_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(F.max("n").alias("max_sent"))


def author_clicks(clicks: DataFrame, articles: DataFrame) -> DataFrame:
    """Clicks made by the author of the clicked article."""
    per_pair = clicks.groupBy("article_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
    own = articles.select("article_id", F.col("author_id").alias("user_id"))
    met = per_pair.join(own, ["article_id", "user_id"])
    return met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("author_clicks"))


def status_counts(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("status").agg(F.count(F.lit(1)).alias("cnt"))


def users_per_week(emails: DataFrame) -> DataFrame:
    """Users with at least one email in each week."""
    per_user = emails.select("user_id", "email_id", "week_num").distinct()
    per_user = per_user.groupBy("user_id", "week_num").agg(F.count(F.lit(1)).alias("n_email"))
    return per_user.groupBy("week_num").agg(F.count(F.lit(1)).alias("users"))


def emails_per_user(emails: DataFrame) -> DataFrame:
    """Count, mean, deviation and quartiles of the number of emails per user."""
    per_user = emails.select("user_id", "email_id").distinct().groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_user.agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("n").alias("mean"),
        F.stddev_samp("n").alias("std"),
        F.min("n").alias("min"),
        F.percentile("n", 0.25).alias("q25"),
        F.percentile("n", 0.5).alias("q50"),
        F.percentile("n", 0.75).alias("q75"),
        F.max("n").alias("max"),
    )
