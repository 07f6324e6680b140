"""Kendall rank correlation without pairs.

tau-b needs the number of concordant minus discordant pairs. Give every label its
place among the block's labels. Two labels that differ have exactly one highest
binary digit in which their places differ; for each digit, group the items by the
digits above it, walk them by score, and count the items with digit 0 passed before
each item with digit 1. That is one running sum over ``items x digits`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.operators.scale import HOT_ROWS, join_lookup, positions, running
from tarnworks.session import checkpoint


def _pairs(n: Column) -> Column:
    n = n.cast("double")
    return n * (n - 1) / 2


def _tied(cells: DataFrame, column: str) -> DataFrame:
    """Pairs of items with equal ``column`` per block."""
    per_value = cells.groupBy("block", column).agg(F.sum("c").alias("c"))
    return per_value.groupBy("block").agg(F.sum(_pairs(F.col("c"))).alias(f"tied_{column}"))


def _balance(cells: DataFrame, hot_rows: int) -> DataFrame:
    """Concordant minus discordant pairs per block."""
    labels = cells.groupBy("block", "label").agg(F.count(F.lit(1)).alias("size"))
    places = checkpoint(positions(labels, ["block"], ["label"], "place", hot_rows))
    top = places.agg(F.max("place")).first()[0] or 0
    digits = max(top.bit_length(), 1)
    met = join_lookup(cells, places, ["block", "label"], "size", hot_rows)
    by_digit = met.withColumn("digit", F.explode(F.sequence(F.lit(0), F.lit(digits - 1))))
    one = F.expr("shiftright(place, digit) & 1") == 1
    group = ["block", "digit", "above"]
    steps = (
        by_digit.withColumn("above", F.expr("shiftright(place, digit + 1)"))
        .groupBy(*group, "score")
        .agg(
            F.sum(F.when(one, 0).otherwise(F.col("c"))).alias("c0"),
            F.sum(F.when(one, F.col("c")).otherwise(0)).alias("c1"),
        )
    )
    walked = running(steps, group, ["score"], {"upto": ("sum", F.col("c0"))}, hot_rows)
    c0, c1, upto = (F.col(c).cast("double") for c in ("c0", "c1", "upto"))
    # items below minus items above, for every item with digit 1
    won = F.sum(c1 * (2 * upto - c0)) - F.sum(c0) * F.sum(c1)
    per_group = walked.groupBy(*group).agg(won.alias("won"))
    return per_group.groupBy("block").agg(F.sum("won").alias("balance"))


def kendall_tau(samples: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """tau-b of ``score`` against ``label`` per ``block``: ``block, tau``; null where all
    scores or all labels of a block are equal."""
    cells = samples.groupBy("block", "score", "label").agg(F.count(F.lit(1)).alias("c"))
    cells = checkpoint(cells)
    totals = cells.groupBy("block").agg(_pairs(F.sum("c")).alias("all"))
    free = F.sqrt(
        (F.col("all") - F.col("tied_score")) * (F.col("all") - F.col("tied_label"))
    )
    return (
        totals.join(_tied(cells, "score"), "block")
        .join(_tied(cells, "label"), "block")
        .join(_balance(cells, hot_rows), "block")
        .select("block", F.try_divide(F.col("balance"), free).alias("tau"))
    )
