"""The prefix trie of conversations, by a skeleton of range-partition splitters.

A conversation is the row of its turns' digests, 16 bytes each; sorted by these, the members
of a node of the trie lie next to one another. The rows are dealt by range to sorted shards. A
node that lies in more than one shard is a prefix of the first row of a shard, of the splitter:
the prefixes that a splitter shares with the row before it are the skeleton, a small trie that
is broadcast. Every other node lies in one shard and is finished there in one pass over the
sorted rows, with a stack of the open nodes. For nodes of the skeleton the shards give partial
sums, which are added up by node and then up the skeleton.

Equal conversations are ordered by id and may fill many shards. A digest of ids is by its nature
read in order, so that of a node of the skeleton is made from packed stretches of ids, which
stream through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.llm.common import checkpoint, shuffle_width, word_count

# Bytes of a turn's digest.
WIDE = 16
# Turns of a shard, about.
SHARD_TURNS = 200_000
# Bytes that splitters, and so the skeleton, may take. It bounds how many turns of a row tell
# its shard: at least DEEP, and more where there are few shards.
SKELETON_BYTES, DEEP = 16 << 20, 64
# Ids that are packed into one row for a digest.
PACKED = 4096
# Rows of one batch of results.
EMITTED = 8192

# Fixed values of the query: conversations of a family and how many turns they may share.
FAMILY, SHARED = 20, 4

NODES = "kind int, at long, conv_id long, depth long, parent_conv_id long, parent_at long, " \
        "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ids string"
EMPTY = hashlib.sha256(b"").hexdigest()
# Kinds of rows that shards give.
NODE, PARTIAL, IDS = 0, 1, 2


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of every conversation in order, each with ``key`` (the digest
    of role and text), ``words``. Null roles and texts are empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.substring(F.unhex(F.sha2(told, 256)), 1, WIDE).alias("key"),
            word_count(text).alias("words"),
        ).alias("t"),
    ).filter("conv_id is not null")
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words"))).alias("turns"))


def rebuilt(rows: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """The conversations with their first turns replaced by those of the first of their family:
    h = crc32(conv_id) % ``shared`` turns of conversation conv_id - conv_id % ``family`` (towards
    zero, also below it)."""
    first = F.col("conv_id") - F.col("conv_id") % family
    heads = rows.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("_first"), F.slice("turns", 1, shared - 1).alias("_head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    met = rows.withColumn("_of", first).join(heads, F.col("_of") == F.col("_first"), "left")
    none = F.array().cast(rows.schema["turns"].dataType)
    head = F.slice(F.coalesce("_head", none), F.lit(1), h)
    # Of a row shorter than h nothing is left; slice wants a start within what it may be.
    own = F.slice("turns", h + 1, F.size("turns") + 1)
    return met.select("conv_id", F.concat(head, own).alias("turns"))


def paths(rows: DataFrame) -> DataFrame:
    """``conv_id, path, words`` from ``conv_id, turns``: path is all keys in one value."""
    keys = F.transform("turns", lambda t: F.hex(t["key"]))
    return rows.select(
        "conv_id", F.unhex(F.concat_ws("", keys)).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with alike."""
    top = min(len(a), len(b)) // WIDE
    if a[: top * WIDE] == b[: top * WIDE]:
        return top
    low = 0
    while low < top:  # prefixes of that many turns are equal, of top more aren't
        middle = (low + top + 1) // 2
        if a[: middle * WIDE] == b[: middle * WIDE]:
            low = middle
        else:
            top = middle - 1
    return low


class Skeleton:
    """Trie of the prefixes that lie in several shards. Node 0 is the root."""

    def __init__(self, ends: list[tuple[bytes, bytes]]):
        """``ends``: the first and the last path of every shard that has rows, in order."""
        self.next: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for (_, before), (splitter, _) in zip(ends, ends[1:]):
            at = 0
            for k in range(_shared(before, splitter)):
                key = (at, splitter[k * WIDE : (k + 1) * WIDE])
                if key not in self.next:
                    self.next[key] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = self.next[key]


class _Open:
    """A node whose members are being read."""

    __slots__ = ("at", "low", "n", "children", "leaves", "saved", "words", "ends", "some", "waiting")

    def __init__(self, at: int, words: int):
        self.at, self.words, self.low = at, words, None
        self.n = self.children = self.leaves = self.saved = 0
        self.ends, self.some, self.waiting = None, [], []


class _Walk:
    """One pass over a sorted shard. Finished rows are gathered in ``rows``."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.rows = skeleton, []
        self.stack, self.path = [_Open(0, 0)], b""

    def _ids(self, node: _Open) -> None:
        """Hand on the ids that end at a node: to its digest, or packed, in the skeleton."""
        text = ",".join(map(str, node.some))
        if node.at >= 0:
            self.rows.append((IDS, node.at, node.some[0], None, None, None, None, None, None, None, None, text))
        elif node.ends is None:
            node.ends = hashlib.sha256(text.encode())
        else:
            node.ends.update(b"," + text.encode())
        node.some = []

    def _close(self) -> None:
        node = self.stack.pop()
        depth = len(self.stack)
        if node.some:
            self._ids(node)
        if node.at >= 0:
            self.rows.append((
                PARTIAL, node.at, node.low, depth, None, None, node.n, node.children, node.leaves,
                node.saved, None, str(node.words),
            ))
            if self.stack:
                above = self.stack[-1]
                above.n += node.n
                above.low = node.low if above.low is None else min(above.low, node.low)
            return
        if not node.children:
            node.leaves = 1
        saved = node.saved + (node.n - 1) * node.words
        digest = EMPTY if node.ends is None else node.ends.hexdigest()
        row = (depth, node.n, node.children, node.leaves, saved, digest)
        above = self.stack[-1]
        above.n += node.n
        above.low = node.low if above.low is None else min(above.low, node.low)
        above.children += 1
        above.leaves += node.leaves
        above.saved += saved
        for low, (d, n, children, leaves, s, ends) in node.waiting:
            self.rows.append((NODE, None, low, d, node.low, None, n, children, leaves, s, ends, None))
        if above.at < 0:
            above.waiting.append((node.low, row))
        else:
            self.rows.append((NODE, None, node.low, depth, None, above.at, *row[1:], None))

    def add(self, conv_id: int, path: bytes, words: list[int]) -> None:
        common = _shared(self.path, path)
        while len(self.stack) > common + 1:
            self._close()
        for k in range(common, len(path) // WIDE):
            top = self.stack[-1].at
            at = self.skeleton.next.get((top, path[k * WIDE : (k + 1) * WIDE]), -1) if top >= 0 else -1
            self.stack.append(_Open(at, words[k]))
        self.path = path
        node = self.stack[-1]
        node.n += 1
        node.low = conv_id if node.low is None else min(node.low, conv_id)
        node.some.append(conv_id)
        if len(node.some) >= PACKED:
            self._ids(node)

    def finish(self) -> None:
        while self.stack:
            self._close()


def _local(skeleton) -> callable:
    schema = pa.schema([
        ("kind", pa.int32()), ("at", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()), ("parent_at", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()), ("ids", pa.string()),
    ])

    def taken(walk: _Walk) -> pa.RecordBatch:
        columns = zip(*walk.rows)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        walk.rows = []
        return batch

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, any_row = _Walk(skeleton.value), False
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(3))):
                any_row = True
                walk.add(*row)
                if len(walk.rows) >= EMITTED:
                    yield taken(walk)
        if any_row:
            walk.finish()
            yield taken(walk)

    return work


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each node of the skeleton, whose stretches come in order."""
    at, digest = None, None

    def row():
        return pa.RecordBatch.from_pydict({"at": [at], "ends": [digest.hexdigest()]})

    for batch in batches:
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != at:
                if at is not None:
                    yield row()
                at, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if at is not None:
        yield row()


def _rolled(skeleton: Skeleton, sums: dict[int, tuple]) -> list[tuple]:
    """Rows of the skeleton's nodes: what lies below is added from the deepest up."""
    count = len(skeleton.parent)
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    for at in range(count - 1, -1, -1):  # a node comes after its parent
        low, n, own, below, gain, words, _ = sums[at]
        children[at] += own
        leaves[at] = leaves[at] + below if children[at] else 1
        saved[at] += gain + (n - 1) * words
        above = skeleton.parent[at]
        if above >= 0:
            children[above] += 1
            leaves[above] += leaves[at]
            saved[above] += saved[at]
    return [
        (at, sums[at][0], skeleton.depth[at],
         sums[skeleton.parent[at]][0] if at else None,
         sums[at][1], children[at], leaves[at], saved[at], sums[at][6])
        for at in range(count)
    ]


SKELETON_ROWS = "at long, conv_id long, depth long, parent_conv_id long, n_convs long, " \
                "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def trie(rows: DataFrame, n_turns: int, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie of ``rows`` (``conv_id, path, words``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256`` as in ``prefix_trie``. ``n_turns``: turns in
    all, about. What the driver and the broadcasts hold is bounded by ``SKELETON_BYTES``.
    """
    spark = rows.sparkSession
    shards = max(shuffle_width(spark), ceil(n_turns / shard_turns))
    deep = WIDE * max(DEEP, SKELETON_BYTES // (2 * WIDE * shards))
    # Rows that go on beyond what deals them come after those that end there.
    longer = F.length("path") > deep
    dealt = rows.withColumns({
        "_head": F.substring("path", 1, deep), "_longer": longer,
        "_tie": F.when(~longer, F.col("conv_id")),
    }).repartitionByRange(shards, "_head", "_longer", "_tie")
    cut = checkpoint(dealt.sortWithinPartitions("path", "conv_id").select(
        "conv_id", "path", "words", F.spark_partition_id().alias("shard")
    ))
    ends = cut.groupBy("shard").agg(
        F.min(F.substring("path", 1, deep)).alias("first"), F.max(F.substring("path", 1, deep)).alias("last")
    ).orderBy("shard").collect()
    skeleton = Skeleton([(bytes(r["first"]), bytes(r["last"])) for r in ends])
    sent = spark.sparkContext.broadcast(skeleton)
    local = checkpoint(cut.select("conv_id", "path", "words").mapInArrow(_local(sent), NODES).withColumn(
        "shard", F.spark_partition_id()
    ))

    width = shuffle_width(spark)
    ids = local.filter(F.col("kind") == IDS).repartition(width, "at")
    ids = ids.sortWithinPartitions("at", "shard", "conv_id").select("at", "ids")
    digests = ids.mapInArrow(_ends, "at long, ends string").withColumnRenamed("at", "_at")
    partial = local.filter(F.col("kind") == PARTIAL).groupBy("at").agg(
        F.min("conv_id").alias("low"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max(F.col("ids").cast("long")).alias("words"),
    )
    sums = {
        r["at"]: (r["low"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["words"], r["ends"] or EMPTY)
        for r in partial.join(digests, partial["at"] == digests["_at"], "left").toLocalIterator()
    }
    schema = T._parse_datatype_string(SKELETON_ROWS)
    upper = spark.createDataFrame(_rolled(skeleton, sums) if sums else [], schema)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    lows = upper.select(F.col("at").alias("parent_at"), F.col("conv_id").alias("_above"))
    nodes = local.filter(F.col("kind") == NODE).join(F.broadcast(lows), "parent_at", "left")
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return nodes.select(*columns).unionByName(upper.select(*columns))


def prefix_trie(
    conversations: DataFrame, family: int = FAMILY, shared: int = SHARED, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations (``rebuilt``).

    A node is a different sequence of first ``depth`` turns (role, text); the root has depth 0.
    ``conv_id``: its smallest member, ``parent_conv_id`` that of its parent (root: null),
    ``n_convs`` members, ``n_children``, ``n_leaves`` childless nodes in its subtree, itself
    included, ``saved_tokens`` over its subtree words of a node's last text times its members
    but one, ``ends_sha256`` of the ids of members that end there, in order.

    Turns lie in the order of ``turn``, null first; turns of one number in that of their digests,
    so repeated rows are turns of their own. Null role and text are empty. Rows without a
    conv_id belong to no conversation and are left out. An empty table gives no node, not
    even a root. Other columns are not read. Very long texts are only hashed; one
    conversation's digests, 16 bytes a turn, have to fit in a row.
    """
    rows = paths(rebuilt(turns(conversations), family, shared))
    return trie(rows, conversations.count(), shard_turns)
