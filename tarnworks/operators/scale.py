"""Shared tools for keys that hold a large part of all rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.session import checkpoint, shuffle_width

# A key with more rows than this does not fit comfortably into one task.
HOT_ROWS = 1_000_000
# Most rows that are ever broadcast by hand.
BROADCAST_ROWS = 100_000
# Groups of keys that are split alike in a salted join.
SALT_BUCKETS = 65_536


# Partitions per shuffle partition where single rows may be costly.
SPREAD = 4


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows over many partitions before work that costs far more than reading
    them, for which the splits of the input files are too coarse."""
    return df.repartition(SPREAD * shuffle_width(df.sparkSession), *keys)


def dealt(df: DataFrame, width: int, *keys: str) -> DataFrame:
    """Rows in ``width`` partitions by a hash of ``keys``, with ``slot``, a number that tells the
    partition. What is added up for each word of a slot is shuffled once for the slot, not once for
    each row, and comes back to its rows by the slot."""
    spark = df.sparkSession
    numbers = spark.range(64 * width).select(F.col("id").cast("int").alias("slot"))
    # One number for each partition that its hash leads to; a missing one costs evenness only.
    parts = numbers.groupBy(F.pmod(F.hash("slot"), F.lit(width)).alias("part")).agg(F.min("slot").alias("slot"))
    slots = F.array(*[F.lit(r["slot"]) for r in parts.orderBy("part").collect()])
    slot = F.get(slots, F.pmod(F.xxhash64(*keys), F.size(slots)).cast("int"))
    return df.withColumn("slot", slot).repartition(width, "slot")


def hot_entries(lookup: DataFrame, size: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Entries of ``lookup`` whose key holds more than ``hot_rows`` rows, None if there
    are none.

    At most ``BROADCAST_ROWS`` entries, the largest, so the result may be broadcast.
    ``lookup`` should be checkpointed.
    """
    hot = lookup.filter(F.col(size) > hot_rows)
    if hot.isEmpty():
        return None
    return checkpoint(hot.orderBy(F.desc(size)).limit(BROADCAST_ROWS))


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    size: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of ``facts`` with a lookup that has one row per key.

    ``lookup[size]`` is the number of fact rows of the key. Rows of the largest hot keys meet
    a broadcast of their few entries where they lie. Hot keys beyond ``BROADCAST_ROWS`` are
    split by a salted join; all other rows are shuffled by key.
    ``facts`` and ``lookup`` may be used more than once: have them checkpointed.
    """
    hot = hot_entries(lookup, size, hot_rows)
    rest = lookup.drop(size)
    if hot is None:
        return facts.join(rest, keys)
    hot_keys = F.broadcast(hot.select(*keys))
    cold = facts.join(hot_keys, keys, "left_anti")
    if hot.count() < BROADCAST_ROWS:
        met = cold.join(rest, keys)
    else:
        met = salted_join(cold, lookup.join(hot_keys, keys, "left_anti"), keys, size, hot_rows)
    return facts.join(F.broadcast(hot.drop(size)), keys).unionByName(met)


def salted_join(
    facts: DataFrame, lookup: DataFrame, keys: list[str], size: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``join_lookup`` for any number of hot keys.

    Keys are hashed into ``SALT_BUCKETS`` buckets. A bucket has as many salts as its largest key
    has ``hot_rows`` rows, rounded up; that table is small however many keys are hot, so both
    sides get it by broadcast. A fact's salt follows from its own columns, a lookup row is copied
    once for each salt. Keys are compared by their text form: use whole numbers or strings.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(SALT_BUCKETS))
    salts = F.ceil(F.max(size) / hot_rows).cast("int")
    many = checkpoint(lookup.groupBy(bucket.alias("_bucket")).agg(salts.alias("_salts")).filter("_salts > 1"))

    def told(df: DataFrame) -> DataFrame:
        met = df.withColumn("_bucket", bucket).join(F.broadcast(many), "_bucket", "left").drop("_bucket")
        return met.withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    salt = F.pmod(F.xxhash64(*facts.columns), F.col("_salts")).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    left = told(facts).withColumn("_salt", salt).drop("_salts")
    right = told(lookup.drop(size)).withColumn("_salt", copies).drop("_salts")
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def _same_key(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[prefix + k])
    return cond


def largest_group(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the largest group and rows in all."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max("n").alias("top"), F.sum("n").alias("n")).first()
    return row["top"] or 0, row["n"] or 0


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, tuple[str, Column]],
    hot_rows: int = HOT_ROWS,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """Add running ``sum``s and ``max``es over the rows of each key in order.

    ``columns`` maps a new name to ``("sum" | "max", expression)``. The order must
    be total within a key. Groups that fit a task use one window. When some group
    does not, the rows are range-partitioned on key and order, every slice runs its
    own window, and totals of earlier slices (one small row per key and slice) are
    carried in. ``sizes`` is the result of ``largest_group`` where already known.
    """
    kinds = {"sum": F.sum, "max": F.max}
    top, total = sizes or largest_group(df, keys)
    if top <= hot_rows:
        w = Window.partitionBy(*keys).orderBy(*order)
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select("*", *[kinds[k](e).over(w).alias(n) for n, (k, e) in columns.items()])

    width = max(shuffle_width(df.sparkSession), ceil(total / hot_rows))
    sliced = checkpoint(
        df.withColumns({f"_in_{n}": e for n, (_, e) in columns.items()})
        .repartitionByRange(width, *keys, *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    before = Window.partitionBy(*keys).orderBy("_slice")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(*keys, "_slice").agg(
        *[kinds[k](f"_in_{n}").alias(n) for n, (k, _) in columns.items()]
    )
    carry = totals.select(
        *[F.col(k).alias(f"_c_{k}") for k in [*keys, "_slice"]],
        *[kinds[k](n).over(before).alias(f"_carry_{n}") for n, (k, _) in columns.items()],
    )
    joined = sliced.join(carry, _same_key(sliced, carry, [*keys, "_slice"], "_c_"))
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def combined(name: str, kind: str) -> Column:
        here = kinds[kind](f"_in_{name}").over(w)
        earlier = F.col(f"_carry_{name}")
        if kind == "max":
            return F.greatest(earlier, here)
        return F.when(here.isNull(), earlier).otherwise(F.coalesce(earlier, F.lit(0)) + here)

    return joined.select(
        *[sliced[c] for c in df.columns],
        *[combined(n, k).alias(n) for n, (k, _) in columns.items()],
    )


def positions(
    df: DataFrame, keys: list[str], order: list[str], name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """0-based position of each row within its key; ``order`` must be total."""
    counted = running(df, keys, order, {name: ("sum", F.lit(1).cast("long"))}, hot_rows)
    return counted.withColumn(name, F.col(name) - 1)
