"""Game statistics: orders as games between customers (white) and suppliers (black)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.operators import components as cc
from tarnworks.operators import games as gm
from tarnworks.sources.lines import parse_games
from tarnworks.sources.tables import table


def _lines(spark, d) -> DataFrame:
    lines = table(spark, d, "lineitem")
    orders = table(spark, d, "orders")
    flag = F.col("l_returnflag")
    met = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return met.select(
        F.concat(F.lit("c"), "o_custkey").alias("white"),
        F.concat(F.lit("s"), "l_suppkey").alias("black"),
        F.when(flag == "A", "1-0").when(flag == "N", "1/2-1/2").when(
            F.col("l_linestatus") == "O", "0-1"
        ).otherwise("*").alias("result"),
        F.concat(F.lit("B"), F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")).alias("eco"),
        F.date_format("l_shipdate", "yyyy.MM.dd").alias("date"),
    )


def games(spark, d) -> DataFrame:
    tags = F.create_map(
        F.lit("Result"), "result", F.lit("ECO"), "eco", F.lit("Date"), "date"
    )
    return _lines(spark, d).select("white", "black", tags.alias("tags"))


def game_counts(spark, d):
    return gm.player_counts(games(spark, d))


def opening_count(spark, d):
    return gm.opening_count(games(spark, d))


def opening_games(spark, d):
    picked = gm.games_with(games(spark, d), "ECO", "B37")
    return picked.select("white", "black", F.col("tags")["Date"].alias("date"))


def game_pairs(spark, d):
    return gm.collapse(games(spark, d))


def game_points(spark, d):
    return gm.player_points(games(spark, d))


def game_points_strict(spark, d):
    return gm.player_points(games(spark, d), strict_results=True)


def game_groups(spark, d):
    """Groups of players connected by games."""
    edges = gm.game_edges(games(spark, d)).distinct()
    return cc.component_sizes(cc.connected_components(edges))


def game_parse(spark, d):
    text = F.format_string(
        '[Event "trade"]\n[Date "?"]\n[Date "%s"]\n[White "%s"]\n[Black "%s"]\n[Result "%s"]\n[ECO "%s"]\n'
        '\n1. e4 {[Result "?"]\n[ECO "?"]} e5',
        "date", "white", "black", "result", "eco",
    )
    parsed = parse_games(_lines(spark, d).select(text.alias("value")))
    return parsed.select(
        "white", "black", *[F.col("tags")[t].alias(t.lower()) for t in ("Event", "Date", "Result", "ECO")]
    )


GAMES = """WITH games AS MATERIALIZED (
  SELECT 'c' || o_custkey AS white, 's' || l_suppkey AS black,
    CASE WHEN l_returnflag = 'A' THEN '1-0' WHEN l_returnflag = 'N' THEN '1/2-1/2'
      WHEN l_linestatus = 'O' THEN '0-1' ELSE '*' END AS result,
    'B' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0') AS eco,
    strftime(l_shipdate, '%Y.%m.%d') AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _points_sql(black: str) -> str:
    return f"""{GAMES} SELECT player, sum(points) AS points FROM (
  SELECT white AS player, CASE result WHEN '1-0' THEN 1.0::DOUBLE WHEN '1/2-1/2' THEN 0.5 ELSE 0 END AS points FROM games
  UNION ALL
  SELECT black, CASE WHEN result = '1-0' THEN 0.0::DOUBLE WHEN result = '1/2-1/2' THEN 0.5 {black} END FROM games)
GROUP BY player"""


QUERIES = {
    "game_counts": (
        game_counts,
        f"""{GAMES} SELECT count(*) AS games,
(SELECT count(*) FROM (SELECT white FROM games UNION SELECT black FROM games)) AS players FROM games""",
    ),
    "opening_count": (opening_count, f"{GAMES} SELECT count(DISTINCT eco) AS openings FROM games"),
    "opening_games": (
        opening_games, f"{GAMES} SELECT white, black, date FROM games WHERE eco = 'B37'"
    ),
    "game_pairs": (
        game_pairs,
        f"""{GAMES} SELECT least(white, black) AS a, greatest(white, black) AS b, count(*) AS games
FROM games GROUP BY 1, 2""",
    ),
    "game_points": (game_points, _points_sql("ELSE 1")),
    "game_points_strict": (game_points_strict, _points_sql("WHEN result = '0-1' THEN 1 ELSE 0")),
    "game_groups": (
        game_groups,
        GAMES.replace("WITH", "WITH RECURSIVE", 1) + """,
sym AS MATERIALIZED (SELECT white AS a, black AS b FROM games UNION SELECT black, white FROM games),
walk(step, id, component, changed) AS (
  SELECT 0, a, a, true FROM (SELECT DISTINCT a FROM sym)
  UNION ALL
  SELECT step + 1, id, least(component, low), max(low < component) OVER ()
  FROM (SELECT w.step, w.id, w.component, w.changed, m.low FROM walk w JOIN (
    SELECT s.a AS id, min(o.component) AS low FROM sym s JOIN walk o ON o.id = s.b GROUP BY s.a) m ON m.id = w.id)
  WHERE changed),
comp AS (SELECT id, component FROM walk WHERE step = (SELECT max(step) FROM walk))
SELECT component, count(*) AS nodes FROM comp GROUP BY component""",
    ),
    "game_parse": (
        game_parse, f"{GAMES} SELECT white, black, 'trade' AS event, date, result, eco FROM games"
    ),
}
