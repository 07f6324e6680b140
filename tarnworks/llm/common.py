"""Small helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.session import checkpoint, shuffle_width

# A lookup of at most so many rows is broadcast; a larger one is joined with salted keys.
BROADCAST_ROWS = 100_000
SALTS = 32

# The bytes that separate words.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs without white space, 0 for null. Counts in place: no list of words is made."""
    marks = F.regexp_replace(text, WORD, "x")
    return F.coalesce(F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def meet(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Inner join with a checkpointed lookup of one row per (null-safe) key, whatever the
    share of one key: a small lookup is broadcast, a large one repeated for each salt."""
    one = lookup.withColumnRenamed(key, "_key")
    if lookup.count() <= BROADCAST_ROWS:
        return facts.join(F.broadcast(one), facts[key].eqNullSafe(one["_key"])).drop("_key")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    one = one.withColumn("_salt", salts)
    dealt = facts.withColumn("_deal", F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int"))
    same = dealt[key].eqNullSafe(one["_key"]) & (dealt["_deal"] == one["_salt"])
    return dealt.join(one, same).drop("_key", "_salt", "_deal")


__all__ = ["BROADCAST_ROWS", "LOWER", "SALTS", "WHITE", "WORD", "checkpoint", "meet", "shuffle_width", "word_count"]
