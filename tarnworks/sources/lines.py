"""Line formats: access logs, learning-to-rank samples, numbered sentences, games."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.calendar import week_label
from tarnworks.functions.text import sentence_tokens
from tarnworks.functions.vectors import bind, once

# Fixed value: the request line of a click in the access log.
CLICK_LINE = (
    r'\[(.*)\] "GET /click\?article_id=(\d*)&user_id=(\d*) HTTP/1.1" (\d*) (\d*)'
)
LOG_TIME = "dd/MMM/yyyy:HH:mm:ss"
GAME_HEAD = r"^(?:\s*\[[^\n]*)*+"
GAME_TAG = r'\[(\w+) "([^"]*)"\]'


def parse_clicks(lines: DataFrame) -> DataFrame:
    """Access-log lines as clicks; lines that are no click, or have no readable time, are
    dropped. Ids and numbers that are empty or too large are null."""
    part = {
        name: F.regexp_extract("value", CLICK_LINE, i)
        for i, name in enumerate(["time", "article_id", "user_id", "status", "bsize"], 1)
    }
    at = F.try_to_timestamp(part["time"], F.lit(LOG_TIME))
    found = lines.filter(F.col("value").rlike("^" + CLICK_LINE) & at.isNotNull())
    return found.select(
        at.alias("click_time"),
        week_label(at).alias("week_num"),
        *[part[c].try_cast("int").alias(c) for c in ("article_id", "user_id", "status", "bsize")],
    )


def read_clicks(spark: SparkSession, path: str) -> DataFrame:
    return parse_clicks(spark.read.text(path))


def save_clicks(clicks: DataFrame, path: str) -> None:
    """Store parsed clicks by week, so that weekly reports read only their weeks."""
    clicks.write.partitionBy("week_num").parquet(path, mode="error")


def add_week(emails: DataFrame, time: str = "send_time") -> DataFrame:
    """Add the week label column to a table with a time column."""
    return emails.withColumn("week_num", week_label(F.col(time)))


def parse_ranking_samples(lines: DataFrame, features: int | None = None) -> DataFrame:
    """``rel qid:Q 1:v ... # comment`` lines as ``qid, rel, fv`` with all features, or the first
    few. Lines without a label or a query are left out; a value that is no number is null."""
    lines = lines.filter(F.col("value").rlike(r"^\s*\d+\s+qid:\S"))
    body = F.split("value", "#", 2)[0]
    values = F.regexp_extract_all(body, F.lit(r"\s\d+:(\S+)"), F.lit(1))
    values = values if features is None else F.slice(values, 1, features)
    return lines.select(
        F.regexp_extract("value", r"qid:(\S+)", 1).alias("qid"),
        F.regexp_extract("value", r"^\s*(\d+)", 1).try_cast("int").alias("rel"),
        F.transform(values, lambda v: v.try_cast("double")).alias("fv"),
    )


def read_ranking_samples(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    return parse_ranking_samples(spark.read.text(path), features)


def parse_numbered_sentences(lines: DataFrame) -> DataFrame:
    """``id: text`` lines as ``id, tokens``; text after a second colon is lost."""
    parts = F.split("value", ":")
    return lines.filter(F.size(parts) > 1).select(
        parts[0].alias("id"), sentence_tokens(parts[1]).alias("tokens")
    )


def read_numbered_sentences(spark: SparkSession, path: str) -> DataFrame:
    return parse_numbered_sentences(spark.read.text(path))


def parse_games(records: DataFrame) -> DataFrame:
    """Game records (``value`` = one game) as ``white, black, tags``. The tags are the lines
    before the first that is none, so moves and their comments hold no tags; of a tag that
    stands there twice the last counts."""
    found = bind(F.regexp_extract("value", GAME_HEAD, 0), lambda head: F.struct(
        F.reverse(F.regexp_extract_all(head, F.lit(GAME_TAG), F.lit(1))).alias("names"),
        F.reverse(F.regexp_extract_all(head, F.lit(GAME_TAG), F.lit(2))).alias("values"),
    ))

    def last_values(tags: Column) -> Column:
        at = lambda name: F.array_position(tags["names"], name).cast("int") - 1
        names = F.reverse(F.array_distinct(tags["names"]))
        return F.map_from_entries(F.transform(names, lambda name: F.struct(name, F.get(tags["values"], at(name)))))

    tags = records.select(*records.columns, once(bind(found, last_values)).alias("all"))
    return tags.filter("all['White'] is not null and all['Black'] is not null").select(
        *[c for c in records.columns if c != "value"],
        F.col("all")["White"].alias("white"),
        F.col("all")["Black"].alias("black"),
        F.map_filter("all", lambda k, _: ~k.isin("White", "Black")).alias("tags"),
    )


def read_games(spark: SparkSession, path: str) -> DataFrame:
    """Game files, plain or compressed; every game starts with its Event tag."""
    raw = spark.read.text(path, lineSep="[Event ")
    return parse_games(
        raw.filter("trim(value) <> ''").select(F.concat(F.lit("[Event "), "value").alias("value"))
    )
