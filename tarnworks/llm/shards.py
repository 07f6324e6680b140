"""Shards by virtual slots.

Rows are hashed into a fixed number of slots; a small versioned table says which shard holds
which slot. Rebalancing edits that table only: it moves or swaps whole slots between the fullest
and the emptiest shards until their bytes are near equal, and writes the changed slots under the
next version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnworks.llm.common import checkpoint, shuffle_width

SLOTS = 8192
SHARDS = 40
ROW_BYTES = 16  # that a row takes besides its text
COPY_BLOCK = 1 << 16  # equal rows made by one task


def slot_of(doc_id: Column, crc: Column, copy: Column, slots: int = SLOTS) -> Column:
    """Copies of a text have other ids, or else numbers, and so spread over the slots."""
    return F.pmod(F.xxhash64(doc_id, crc, copy), F.lit(slots)).cast("int")


def numbered(rows: DataFrame) -> DataFrame:
    """The rows, with equal ones numbered by ``copy`` from 0.

    Equal rows are counted and made anew, as nothing tells them apart; a large number is cut
    into blocks that several tasks make.
    """
    counted = checkpoint(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")))
    single = counted.filter("_n = 1").withColumn("copy", F.lit(0).cast("long")).drop("_n")
    last_block = F.floor((F.col("_n") - 1) / F.lit(COPY_BLOCK)).cast("long")
    blocks = counted.filter("_n > 1").withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    blocks = blocks.repartition(shuffle_width(rows.sparkSession), *rows.columns, "_block")
    start = F.col("_block") * COPY_BLOCK
    end = F.least(start + (COPY_BLOCK - 1), F.col("_n") - 1)
    copies = blocks.withColumn("copy", F.explode(F.sequence(start, end))).drop("_n", "_block")
    return single.unionByName(copies)


def measured(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, copy, vslot``."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = numbered(rows)
    return rows.withColumn("vslot", slot_of(F.col("doc_id"), F.col("text_crc32"), F.col("copy"), slots))


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds each slot, as of a version."""

    version: int
    shards: tuple[int, ...]

    @staticmethod
    def first(slots: int = SLOTS, shards: int = SHARDS) -> SlotMap:
        return SlotMap(1, tuple(s % shards for s in range(slots)))

    def edited(self, sizes: dict[int, int], shards: int, smallest_gap: float = 0.0005) -> SlotMap:
        """The next version: slots move, or change places, from the fullest shard to the
        emptiest as long as that brings the two nearer. ``shards`` may be more than before.

        The table is as long as there are slots, whatever the data.
        """
        where = list(self.shards)
        held: list[set[int]] = [set() for _ in range(shards)]
        total = [0] * shards
        for slot, shard in enumerate(where):
            if shard >= shards:
                shard = where[slot] = slot % shards
            held[shard].add(slot)
            total[shard] += sizes.get(slot, 0)
        aim = sum(total) / shards * smallest_gap
        stuck: set[tuple[int, int]] = set()
        while True:
            order = sorted(range(shards), key=lambda s: (-total[s], s))
            pairs = ((a, b) for a in order for b in reversed(order))
            pair = next(
                ((a, b) for a, b in pairs if total[a] - total[b] > max(1, aim) and (a, b) not in stuck), None
            )
            if pair is None:
                return SlotMap(self.version + 1, tuple(where))
            full, empty = pair
            change = _best(held[full], held[empty], sizes, (total[full] - total[empty]) / 2)
            if change is None:
                stuck.add(pair)
                continue
            stuck = {p for p in stuck if full not in p and empty not in p}
            out, back = change
            for slot, a, b in ((out, full, empty), (back, empty, full)):
                if slot is not None:
                    held[a].discard(slot)
                    held[b].add(slot)
                    where[slot] = b
                    total[a] -= sizes.get(slot, 0)
                    total[b] += sizes.get(slot, 0)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, slot, shard) for slot, shard in enumerate(self.shards)]
        return spark.createDataFrame(rows, "version int, slot int, shard int")


def _best(full: set[int], empty: set[int], sizes: dict[int, int], half: float):
    """The slot to move, or the two to swap, whose difference comes nearest to ``half``."""
    from bisect import bisect_left

    there = sorted((sizes.get(s, 0), s) for s in empty)
    there = [(0, None), *there]
    keys = [n for n, _ in there]
    best, change = 2 * half, None
    for slot in sorted(full):
        size = sizes.get(slot, 0)
        at = bisect_left(keys, size - half)
        for n, other in there[max(0, at - 1) : at + 1]:
            moved = size - n
            if 0 < moved < 2 * half and abs(moved - half) < abs(best - half):
                best, change = moved, (slot, other)
    return change


def write_map(spark: SparkSession, slot_map: SlotMap, folder: str) -> None:
    """Store a version beside the earlier ones."""
    slot_map.table(spark).drop("version").coalesce(1).write.parquet(f"{folder}/version={slot_map.version}")


def read_map(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
    """The last version stored, or a given one."""
    rows = spark.read.parquet(folder)
    last = version or rows.agg(F.max("version")).first()[0]
    found = rows.filter(F.col("version") == last).orderBy("slot").collect()  # as many as slots
    return SlotMap(int(last), tuple(r["shard"] for r in found))


def slot_sizes(rows: DataFrame) -> dict[int, int]:
    """Bytes by slot: at most as many rows as slots."""
    sums = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"))
    return {r["vslot"]: r["bytes"] for r in sums.collect()}


def sharded(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, before: SlotMap | None = None,
    folder: str | None = None,
):
    """The rows with their places, and the map that places them.

    Rows: ``doc_id, size, text_crc32, vslot, version, shard, slot``; ``slot`` numbers the rows
    of a shard from 0 without gaps, by virtual slot, then hash and id. ``size``: UTF-8 bytes of
    the text (null: none) plus 16. A null text has the checksum of the empty one. Equal rows,
    with or without id, are numbered and so spread over the virtual slots. With ``before``, its
    map is edited; else a plain one is. With ``folder``, the versions are stored there, and the
    rows are placed by the last one that is read back. Empty tables give no rows; other columns
    aren't read.
    """
    rows = checkpoint(measured(docs, slots))
    spark = docs.sparkSession
    first = before or SlotMap.first(slots, shards)
    slot_map = first.edited(slot_sizes(rows), shards)
    if folder:
        for version in [slot_map] if before else [first, slot_map]:
            write_map(spark, version, folder)
        slot_map = read_map(spark, folder)
    table = slot_map.table(spark).withColumnRenamed("slot", "vslot")
    counts = rows.groupBy("vslot").agg(F.count(F.lit(1)).alias("n"))
    counts = table.join(counts, "vslot", "left")  # as long as there are slots
    ahead = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    within = Window.partitionBy("vslot").orderBy("text_crc32", "doc_id", "size")
    placed = rows.withColumn("_at", F.row_number().over(within) - 1)
    met = placed.join(F.broadcast(starts), "vslot")
    return met.select(
        "doc_id", "size", "text_crc32", "vslot", "version", "shard",
        (F.col("_start") + F.col("_at")).cast("long").alias("slot"),
    ), slot_map
