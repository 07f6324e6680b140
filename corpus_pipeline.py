"""A training-data pipeline of four stages over the documents.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read again as
the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.llm import mixture, pieces, simhash, toxicity
from tarnworks.session import checkpoint, fresh_folder
from tarnworks.sources.tables import table

# Of the SimHash operator's contract: words of a shingle, most differing bits of a link.
WORDS, BITS = 3, 3


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, docs.columns).filter("predicted = 0").select("row.*")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id (null last), of rows with
    one id that with the smallest hash. Only texts count: rows that share an id or have none,
    but have other texts, stay."""
    return simhash.one_of_each(docs, WORDS, BITS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of training, each as often as the mix takes it, in whole or
    (at the end of its source's share) in part. A document that is taken in part is kept whole,
    as no stage cuts texts. Rows alike in all columns stand for one another: there are as many
    as the mix takes of them together."""
    every = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    told = every.select(
        "row.doc_id", "row.text", "row.source", "row",
        F.xxhash64("row").alias("h1"), F.xxhash64(F.lit(1), "row").alias("h2"),
    )
    taken = mixture.mix(told, keep=("h1", "h2")).select("h1", "h2", F.explode("passes").alias("take"))
    once = told.select("row", "h1", "h2").dropDuplicates(["h1", "h2"])
    placed = once.join(taken.select("h1", "h2", F.col("take.position").alias("position")), ["h1", "h2"])
    return mixture.in_order(placed, "position", "h1").select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document."""
    return pieces.encoded(docs, pieces.Vocabulary.load(), ["source", "lang"])


STAGES = [
    ("toxicity", keep_clean),
    ("simhash", keep_one),
    ("mixture", mixed),
    ("pieces", encoded),
]

# Fitted scores and piece ids are beyond SQL; tests hold the run against a plain Python one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = fresh_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
