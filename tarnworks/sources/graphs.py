"""Adjacency lines, page indexes, topic maps and rank files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.vectors import once

INDEX_SCHEMA = "name string, id string, in_degree int, out_degree int"
TOPIC_SCHEMA = "id string, topic int"


def unquote(text: Column) -> Column:
    """Strip white space, then double quotes, from both ends."""
    return F.btrim(F.trim(text), F.lit('"'))


def _columns(lines: DataFrame, limit: int = -1) -> DataFrame:
    return lines.select(F.split(F.trim("value"), "\t", limit).alias("c"))


def parse_adjacency(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id <tab> {'dst': weight, ...}`` lines as links (src, dst, weight) and the ids
    that have a line of their own (which may list no links). Other lines are left out."""
    row = F.struct(
        unquote(F.get("c", F.lit(0))).alias("src"),
        F.from_json(F.get("c", F.lit(1)), "map<string,double>").alias("adj"),
    )
    rows = _columns(lines, 2).select(once(row).alias("row")).select("row.*")
    rows = rows.filter("src <> '' and adj is not null")
    links = rows.select("src", F.explode("adj").alias("dst", "weight"))
    return links, rows.select(F.col("src").alias("id"))


def read_adjacency(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_adjacency(spark.read.text(path))


def parse_index(lines: DataFrame) -> DataFrame:
    """``name, id, in_degree, out_degree`` lines; degrees that are no numbers are null, lines
    without an id are left out."""
    rows = _columns(lines).select(
        F.get("c", F.lit(0)).alias("name"),
        unquote(F.get("c", F.lit(1))).alias("id"),
        F.get("c", F.lit(2)).try_cast("int").alias("in_degree"),
        F.get("c", F.lit(3)).try_cast("int").alias("out_degree"),
    )
    return rows.filter("id <> ''")


def parse_mixed(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Adjacency and index lines in one input, told apart by their column count:
    links, ids with an adjacency line, index."""
    line = F.struct("value", F.size(F.split(F.trim("value"), "\t")).alias("wide"))
    told = lines.select(once(line).alias("line")).select("line.*")
    links, ids = parse_adjacency(told.filter("wide = 2"))
    return links, ids, parse_index(told.filter("wide > 2"))


def read_mixed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return parse_mixed(spark.read.text(path))


def _tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", quote="", schema=schema)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, INDEX_SCHEMA)


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, TOPIC_SCHEMA)


def parse_ranks(lines: DataFrame) -> DataFrame:
    """``"id" <tab> rank`` lines; the trailer with the total is dropped, and so are lines
    without an id or a number."""
    rows = _columns(lines).select(
        unquote(F.get("c", F.lit(0))).alias("id"), F.get("c", F.lit(1)).try_cast("double").alias("rank")
    )
    return rows.filter("id not in ('', 'total mass: ') and rank is not null")


def count_rejects(lines: DataFrame, parsed: DataFrame) -> DataFrame:
    """One row: how many lines there are and how many of them a parser left out. ``parsed``
    has one row for each line that was kept."""
    kept = parsed.agg(F.count(F.lit(1)).alias("kept"))
    rows = lines.agg(F.count(F.lit(1)).alias("lines")).join(F.broadcast(kept))
    return rows.select("lines", (F.col("lines") - F.col("kept")).alias("rejects"))


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    return parse_ranks(spark.read.text(path))


def write_ranks(ranked: DataFrame, path: str) -> None:
    """``id <tab> rank`` text files."""
    ranked.select("id", "rank").write.csv(path, sep="\t", mode="error")


def save_state(ranked: DataFrame, path: str) -> None:
    """Keep ranks for a later run to resume from."""
    ranked.write.parquet(path, mode="error")


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
