"""Statistics of a multigraph of games between players.

``games`` has white, black and a ``tags`` map<string,string>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag(name: str) -> Column:
    return F.col("tags")[name]


def game_edges(games: DataFrame) -> DataFrame:
    return games.select(F.col("white").alias("src"), F.col("black").alias("dst"))


def player_counts(games: DataFrame) -> DataFrame:
    """One row: games and distinct players."""
    seats = games.select(F.explode(F.array("white", "black")).alias("player"))
    players = seats.distinct().agg(F.count(F.lit(1)).alias("players"))
    counted = games.agg(F.count(F.lit(1)).alias("games"))
    return counted.withColumn("players", players.scalar())


def opening_count(games: DataFrame) -> DataFrame:
    """Number of different openings."""
    return games.agg(F.count_distinct(tag("ECO")).alias("openings"))


def games_with(games: DataFrame, name: str, value: str) -> DataFrame:
    """Games whose tag has a given value."""
    return games.filter(tag(name) == value)


def collapse(games: DataFrame) -> DataFrame:
    """One undirected edge per pair of players with the number of their games."""
    return games.groupBy(
        F.least("white", "black").alias("a"), F.greatest("white", "black").alias("b")
    ).agg(F.count(F.lit(1)).alias("games"))


def player_points(games: DataFrame, strict_results: bool = False) -> DataFrame:
    """Points per player: 1 for a win, 1/2 for a draw.

    Any result that is neither a win of white nor a draw goes to black; with
    ``strict_results`` only a real win of black does. Players without points show 0.
    """
    first = F.split(tag("Result"), "-")[0]
    black_wins = F.when(tag("Result") == "0-1", 1.0).otherwise(0.0) if strict_results else F.lit(1.0)
    white = F.when(first == "1", 1.0).when(first == "1/2", 0.5).otherwise(0.0)
    black = F.when(first == "1", 0.0).when(first == "1/2", 0.5).otherwise(black_wins)
    seats = games.select(
        F.explode(
            F.array(
                F.struct(F.col("white").alias("player"), white.alias("points")),
                F.struct(F.col("black").alias("player"), black.alias("points")),
            )
        ).alias("seat")
    ).select("seat.*")
    return seats.groupBy("player").agg(F.sum("points").alias("points"))
