"""Top-k reports over ranks, and their join with names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_ranked(ranked: DataFrame, k: int = 100) -> DataFrame:
    """The k best rows by rank; ties go to the smaller id."""
    return ranked.orderBy(F.desc("rank"), "id").limit(k)


def top_mass(ranked: DataFrame, k: int = 100) -> DataFrame:
    """One row: the share of all rank held by the k best nodes."""
    return top_ranked(ranked, k).agg(F.sum("score").alias("top_k_mass"))


def best_values(vectors: DataFrame, k: int) -> DataFrame:
    """The k best distinct ranks of each vector with their place (1 = best) and the
    smallest id holding them. Equal ranks fold together before the window."""
    values = vectors.groupBy("vec", "rank").agg(
        F.min(F.struct("id", "topic")).alias("first")
    )
    w = Window.partitionBy("vec").orderBy(F.desc("rank"))
    return values.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def top_per_vector(vectors: DataFrame, k: int = 10) -> DataFrame:
    """Per vector, one row for each of the k best distinct ranks."""
    return best_values(vectors, k).select("vec", "place", "rank", "first.id", "first.topic")


def top_per_vector_with_ties(vectors: DataFrame, k: int = 10) -> DataFrame:
    """Per vector, every row that holds one of the k best distinct ranks."""
    # k rows per vector, and the number of vectors is a parameter of the run
    best = F.broadcast(best_values(vectors, k).select("vec", "rank", "place"))
    return vectors.join(best, ["vec", "rank"]).select("vec", "place", "rank", "id", "topic")


def name_top(top: DataFrame, index: DataFrame) -> DataFrame:
    """Attach names to a top-k report: ``rank, label``, best first.

    ``top`` is the k-row report, so it is broadcast. Ids missing from the index
    drop out.
    """
    return (
        index.join(F.broadcast(top), "id")
        .select("rank", F.format_string("%s - %s", "id", "name").alias("label"))
        .orderBy(F.desc("rank"), "label")
    )
