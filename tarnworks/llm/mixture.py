"""Mix sources to target weights along a curriculum, with DataFrame functions only.

Every source has a weight schedule over the training time 0..1, here linear from ``rise`` times
its mean at the start to ``2 - rise`` times at the end. Its integral, scaled to the words that
the source is to give, is the source's cumulative demand. The documents of a source lie one
after another in the order of a hash; the position of one is the time at which the demand
reaches the middle of its words, the inverse of that integral. The documents are then sorted by
position, by range, so every executor writes a stretch of the training run.

A source's order is cut into slices by the leading digits of the hash, so no task holds a
whole source: each slice has a running sum of its own, on top of that of the slices before it.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.llm.common import checkpoint, meet, shuffle_width, word_count
from tarnworks.operators.scale import positions, running

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3  # times that a source is passed through
SLICE_ROWS = 2_000  # of one source in a slice, about


def sized(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source, size, place`` and the columns in ``keep``: place is the order within the
    source, a hash of id and text, so rows without an id are spread too."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        doc_id.alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text)).alias("place"),
        *keep,
    )


def source_targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target, rise``: a share of all sizes by weight, at most ``most``
    times the source's own size. What is above goes to the others by weight.

    The excess is dealt at one level: a source is full if the level times its weight reaches its
    limit. With the sources in the order of limit / weight, those before the level are full.
    """
    sources = checkpoint(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = sources.withColumn("_last", F.col("source").isNull())
    placed = positions(sources, [], ["_last", "source"], "at")
    turn = F.pmod(F.col("at"), F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), turn + 1)
    limits = checkpoint(placed.select(
        "source", "source_size", "at", weight.alias("weight"),
        (F.col("source_size") * most).cast("double").alias("limit"),
        (F.lit(1.0) - 0.5 * F.pmod(F.col("at"), F.lit(3)) + 0.5).alias("rise"),
    ).withColumn("full_at", F.col("limit") / F.col("weight")))
    order = ["full_at", "at"]
    sums = running(limits, [], order, {
        "full": ("sum", F.col("limit")), "before": ("sum", F.col("weight")),
    })
    total = limits.agg(F.sum("source_size").cast("double").alias("total")).scalar()
    all_weight = limits.agg(F.sum("weight").alias("all_weight")).scalar()
    # The level if this source and all after it were not full.
    left = total - (F.col("full") - F.col("limit"))
    level = left / (all_weight - (F.col("before") - F.col("weight")))
    marked = sums.withColumn("level", level).filter(F.col("level") <= F.col("full_at"))
    dealt = marked.agg(F.min(F.struct(*order, "level"))["level"].alias("dealt")).scalar()
    target = F.least("limit", F.coalesce(dealt, F.lit(float("inf"))) * F.col("weight"))
    return checkpoint(limits.select("source", "source_size", target.alias("target"), "rise"))


def sliced_offsets(rows: DataFrame, total: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``before``: words of the source's documents ahead in its order."""
    digits = max(1, ceil((max(1, ceil(total / slice_rows)) - 1).bit_length() / 4))
    cut = rows.withColumn("_slice", F.substring("place", 1, digits))
    sums = cut.groupBy("source", "_slice").agg(F.sum("size").alias("_words"))
    ahead = running(checkpoint(sums), ["source"], ["_slice"], {"_to": ("sum", F.col("_words"))})
    ahead = ahead.select("source", "_slice", (F.col("_to") - F.col("_words")).alias("_ahead"))
    w = Window.partitionBy("source", "_slice").orderBy("place", "doc_id", "size")
    within = F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = cut.withColumn("_within", within - F.col("size"))
    other = ahead.select(F.col("source").alias("_s"), F.col("_slice").alias("_t"), "_ahead")
    met = inner.join(other, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_t")))
    return met.withColumn("before", F.col("_ahead") + F.col("_within")).drop(
        "_slice", "_within", "_ahead", "_s", "_t"
    )


def time_of(words: Column, target: Column, rise: Column) -> Column:
    """Time at which a demand of ``words`` is reached: the schedule's weight is linear in the
    time, its integral target * (rise * t + (1 - rise) * t * t), solved for t."""
    share = F.least(F.lit(1.0), words / target)
    root = F.sqrt(F.greatest(F.lit(0.0), rise * rise + 4 * (1 - rise) * share))
    return F.when(target > 0, 2 * share / (rise + root))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, passes`` for each document, and the
    columns of ``docs`` in ``keep``.

    ``taken``: the words the mix takes, repeats counted. A source is passed through as often as
    its target holds it in full; the last pass ends at the target, where a document may be
    taken in part. ``passes``: ``pass, position, words`` for each time the document is taken;
    position is the training time, 0 to 1. ``source_size`` and ``target`` are its source's.

    Sources count in code point order, null last. Null and empty texts have size 0 and are
    taken for 0 words. Rows with one id and text are alike, so it doesn't matter which comes
    first. Repeated rows stay repeated. An empty table gives an
    empty result; other columns aren't read. The result is the same in each run.
    """
    rows = checkpoint(sized(docs, keep))
    targets = source_targets(rows, weights, most)
    met = meet(sliced_offsets(rows, rows.count()), targets, "source")
    goal = F.floor("target").cast("double")
    size = F.col("source_size").cast("double")

    def passed(k):
        start = k * size + F.col("before")
        words = F.greatest(F.lit(0.0), F.least(F.col("size").cast("double"), goal - start))
        return F.struct(
            k.cast("int").alias("pass"),
            time_of(start + words / 2, F.col("target"), F.col("rise")).alias("position"),
            words.cast("long").alias("words"),
        )

    numbers = F.array(*[F.lit(float(k)) for k in range(most)])
    passes = F.filter(F.transform(numbers, passed), lambda p: p["words"] > 0)
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda s, p: s + p["words"])
    return met.withColumn("passes", passes).select(
        "doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"),
        "target", taken.alias("taken"), "passes", *keep,
    )


def in_order(rows: DataFrame, position: str, then: str = "doc_id") -> DataFrame:
    """Rows sorted by position over all partitions."""
    width = shuffle_width(rows.sparkSession)
    return rows.repartitionByRange(width, position, then).sortWithinPartitions(position, then)
