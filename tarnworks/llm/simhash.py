"""SimHash near-duplicates by the generalised pigeonhole.

A fingerprint of 64 bits is cut into partitions. If two fingerprints differ in at most
``radius`` bits and the partitions have thresholds t_i with sum(t_i + 1) = radius + 1, then
some partition differs in at most t_i bits. The thresholds are dealt unequally, for every
fingerprint anew, by dynamic programming on the estimated number of candidates, so crowded
values of a partition are avoided (threshold -1: not probed at all).

Only different fingerprints are worked on. Pairs are compared inside tasks and leave them as
spanning forests, so a crowd of like fingerprints gives links in proportion to its size. In a
crowded value no pairs are compared at all: fingerprints that share a neighbour (one bit off)
are linked through it, and only those outside of the largest group so found look for others
further off, by looking up their own changes among these neighbours.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.common import BROADCAST_ROWS, LOWER, checkpoint, meet, shuffle_width
from tarnworks.operators.components import connected_components
from tarnworks.operators.scale import join_lookup

BITS = 64
SEED = 42
# Fingerprints of one probed value that one task links; more are cut in blocks.
BLOCK = 65_536
# More rows than this at one value are linked through neighbours first. What that leaves is
# compared with all; where it is more than FEW of a crowd's rows, or of more rows than MANY, it
# is looked up.
CROWD, FEW, MANY = 64, 32, 16_384
# Rows of one fingerprint that are joined by a broadcast.
HOT_CLASS = 100_000
# So many links (16 MB) are joined to groups by one task.
FEW_LINKS = 1 << 20
# Pairs that are compared in one vectorised step.
STEP = 2_000_000
# A probe costs about as much as so many compared pairs.
PROBE_COST = 500.0
# Widest group of bits whose values are counted exactly.
PIECE = 16


def shingle_hashes(text: str | None, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``words`` words (the whole sequence where there are fewer)."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = memoryview(b" ".join(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(words, len(parts))
    cut = zip(starts[: len(parts) - span + 1].tolist(), ends[span - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in cut], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, 0 for none."""
    n, ones = len(hashes), np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        rows = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, words: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp`` and the columns in ``keep``: the fingerprints as signed 64-bit numbers."""

    def work(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [_signed(majority(shingle_hashes(t, words))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64()), *batch.columns[2:]],
                ["doc_id", "fp", *keep],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"), *keep)
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:]]
    return rows.mapInArrow(work, ", ".join(["doc_id long", "fp long", *kept]))


def bits_of(values: np.ndarray) -> np.ndarray:
    """0/1 matrix, column b is bit b (0: lowest)."""
    rows = np.ascontiguousarray(values).astype("<i8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1, bitorder="little")


def correlation(distinct: DataFrame) -> np.ndarray:
    """Absolute correlation of each two bits over all fingerprints."""

    def work(batches):
        n, total = 0, np.zeros((BITS, BITS))
        for batch in batches:
            m = bits_of(batch.column(0).to_numpy()).astype(np.float32)
            n, total = n + len(m), total + (m.T @ m)
        yield pa.RecordBatch.from_pydict(
            {"n": pa.array([n], pa.int64()), "sums": pa.array([total.ravel().tolist()])}
        )

    parts = distinct.select("fp").mapInArrow(work, "n long, sums array<double>")
    each = parts.select("n", F.posexplode("sums").alias("at", "s"))
    rows = each.groupBy("at").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    both, n = np.zeros(BITS * BITS), 1
    for r in rows:
        both[r["at"]], n = r["s"], max(1, r["n"])
    both = both.reshape(BITS, BITS) / n
    p = np.diag(both)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs((both - np.outer(p, p)) / np.outer(spread, spread))


def grouped_bits(near: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size; correlated bits come together, so the
    groups among themselves are as independent as can be."""
    free, groups = set(range(BITS)), []
    for left in range(parts, 0, -1):
        width = ceil(len(free) / left)
        rest = sorted(free)
        sums = near[np.ix_(rest, rest)].sum(axis=1) - near[rest, rest]
        group = [rest[int(np.argmax(sums))]]
        free.discard(group[0])
        while len(group) < width:
            rest = sorted(free)
            best = rest[int(np.argmax(near[np.ix_(rest, group)].sum(axis=1)))]
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def part_value(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of a group, packed into one number."""
    v = values.astype(np.uint64)
    out = np.zeros(len(v), np.uint64)
    for k, b in enumerate(bits):
        out |= ((v >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out.astype(np.int64)


def pieces_of(bits: list[int]) -> list[list[int]]:
    n = ceil(len(bits) / PIECE)
    return [bits[len(bits) * k // n : len(bits) * (k + 1) // n] for k in range(n)]


def piece_counts(distinct: DataFrame, groups: list[list[int]]) -> list[list[np.ndarray]]:
    """Fingerprints by value of each piece (at most 2^16 values each)."""
    flat = [piece for g in groups for piece in pieces_of(g)]

    def work(batches):
        counts = [np.zeros(1 << len(piece), np.int64) for piece in flat]
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for c, piece in zip(counts, flat):
                c += np.bincount(part_value(fp, piece), minlength=len(c))
        for k, c in enumerate(counts):
            (at,) = np.nonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(c[at])],
                ["piece", "value", "n"],
            )

    rows = distinct.select("fp").mapInArrow(work, "piece int, value int, n long")
    found = rows.groupBy("piece", "value").agg(F.sum("n").alias("n")).toPandas()
    tables = [np.zeros(1 << len(piece)) for piece in flat]
    for k, table in enumerate(tables):
        mine = found[found["piece"] == k]
        table[mine["value"].to_numpy()] = mine["n"].to_numpy()
    out, at = [], 0
    for g in groups:
        out.append(tables[at : at + len(pieces_of(g))])
        at += len(pieces_of(g))
    return out


def ball_counts(table: np.ndarray, radius: int) -> np.ndarray:
    """Row e: how many fingerprints differ from a value in exactly e bits, e = 0..radius."""
    width = int(np.log2(len(table)))
    rings = np.zeros((radius + 1, len(table)))
    rings[0] = table
    at = np.arange(len(table))
    for b in range(width):  # after bit b, the bits up to b may differ
        flipped = rings[:, at ^ (1 << b)]
        rings[1:] += flipped[:-1]
    return rings


def ring_sizes(width: int, radius: int) -> np.ndarray:
    sizes = np.ones(radius + 1)
    for e in range(1, radius + 1):
        sizes[e] = sizes[e - 1] * max(0, width - e + 1) / e
    return sizes


class Plan:
    """Groups of bits and what is known of how crowded their values are."""

    def __init__(self, groups, counts, total, radius):
        self.groups, self.radius, self.total = groups, radius, max(1.0, float(total))
        self.rings = [[ball_counts(t, radius) for t in tables] for tables in counts]

    def costs(self, fp: np.ndarray) -> np.ndarray:
        """costs[i, t + 1]: work for partition i at threshold t, -1..radius, by fingerprint."""
        out = np.zeros((len(self.groups), self.radius + 2, len(fp)))
        for i, (bits, rings) in enumerate(zip(self.groups, self.rings)):
            shares = None
            for piece, ring in zip(pieces_of(bits), rings):  # pieces count as independent
                own = ring[:, part_value(fp, piece)] / self.total
                shares = own if shares is None else np.stack(
                    [sum(shares[a] * own[e - a] for a in range(e + 1)) for e in range(self.radius + 1)]
                )
            candidates = np.cumsum(shares, axis=0) * self.total
            probes = np.cumsum(ring_sizes(len(bits), self.radius))
            out[i, 1:] = candidates + PROBE_COST * probes[:, None]
        return out

    def thresholds(self, fp: np.ndarray) -> np.ndarray:
        """t_i of every fingerprint with the least cost among those that lose nothing."""
        costs, budget = self.costs(fp), self.radius + 1
        parts, n = len(self.groups), len(fp)
        best = np.full((parts + 1, budget + 1, n), np.inf)
        best[0, 0] = 0
        taken = np.zeros((parts + 1, budget + 1, n), np.int8)
        for i in range(parts):
            for used in range(budget + 1):
                for more in range(budget - used + 1):
                    cost = best[i, used] + costs[i, more]
                    lower = cost < best[i + 1, used + more]
                    best[i + 1, used + more][lower] = cost[lower]
                    taken[i + 1, used + more][lower] = more
        out, left, each = np.zeros((parts, n), np.int8), np.full(n, budget), np.arange(n)
        for i in range(parts, 0, -1):
            step = taken[i, left, each]
            out[i - 1] = step - 1
            left = left - step
        self.least = best[parts, budget]
        return out


def planned(distinct: DataFrame, total: int, radius: int) -> Plan:
    """The cheapest of 2, 3 or 4 partitions for the average fingerprint."""
    near, plans = correlation(distinct), []
    probe = np.array([r["fp"] for r in distinct.limit(2000).collect()], np.int64)
    for parts in (4, 3, 2):
        groups = grouped_bits(near, parts)
        plan = Plan(groups, piece_counts(distinct, groups), total, radius)
        plan.thresholds(probe)
        plans.append((float(plan.least.mean()) if len(probe) else 0.0, plan))
        if total <= 1 << 20:  # buckets of 16 bits stay small
            break
    return min(plans, key=lambda p: p[0])[1]


def masks(width: int, threshold: int) -> np.ndarray:
    """All changes of at most ``threshold`` bits."""
    found, last = [0], [0]
    for _ in range(max(0, threshold)):
        last = sorted({m | (1 << b) for m in last for b in range(width) if not m >> b & 1})
        found += last
    return np.array(found, np.int64)


def signatures(distinct: DataFrame, plan: Plan) -> DataFrame:
    """``part, value, fp, probe``: each fingerprint lies at its own values and is probed at all
    values within its thresholds."""
    sent = distinct.sparkSession.sparkContext.broadcast(plan)

    def work(batches):
        plan = sent.value
        changes = {(i, t): masks(len(g), t) for i, g in enumerate(plan.groups) for t in range(plan.radius + 1)
                   if ring_sizes(len(g), t).sum() <= 1e6}
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(at, 4096).to_numpy()
                dealt = plan.thresholds(fp)
                for i, bits in enumerate(plan.groups):
                    value = part_value(fp, bits)
                    for t in np.unique(dealt[i]):
                        (rows,) = np.nonzero(dealt[i] == t)
                        yield _rows(i, value[rows], fp[rows], False)
                        if t >= 0:
                            change = changes[i, int(t)]
                            for part in np.array_split(rows, max(1, len(rows) * len(change) >> 16)):
                                spread = (value[part][:, None] ^ change[None, :]).ravel()
                                each = np.repeat(part, len(change))
                                yield _rows(i, spread, fp[each], True)

    return distinct.select("fp").mapInArrow(work, "part int, value long, fp long, probe boolean")


def _rows(part, value, fp, probe):
    n = len(value)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, part, np.int32)), pa.array(value), pa.array(fp), pa.array(np.full(n, probe))],
        ["part", "value", "fp", "probe"],
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node to the smallest one it is joined with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, low[x], least)
        np.minimum.at(new, low[y], least)
        new = new[new]
        if (new == low).all():
            break
        low = new
    (moved,) = np.nonzero(low != np.arange(len(nodes)))
    return nodes[moved], nodes[low[moved]]


def changes(bits: int) -> np.ndarray:
    """All numbers with just so many of the bits set, up to two."""
    one = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    if bits < 2:
        return one if bits else np.zeros(1, np.uint64)
    a, b = np.triu_indices(BITS, 1)
    return one[a] | one[b]


def crowd_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs at ``radius`` bits or fewer connect, among different
    fingerprints, with work in proportion to their number for a radius up to three."""
    n, none = len(fps), np.zeros(0, np.int64)
    if n < 2 or radius == 0:
        return none, none
    own = fps.view(np.uint64)
    if radius == 1:
        order = np.argsort(own)
        return _looked_up(own, changes(1), own[order], fps[order], fps)
    near = np.concatenate([changes(0), changes(1)])
    spots = (own[:, None] ^ near).ravel()
    order = np.argsort(spots, kind="stable")
    spots, owner = spots[order], fps[order // len(near)]
    heads = np.concatenate([[True], spots[1:] != spots[:-1]])
    first = np.maximum.accumulate(np.where(heads, np.arange(len(spots)), 0))
    a, b = forest(owner[~heads], owner[first[~heads]]) if not heads.all() else (none, none)
    if radius == 2:
        return a, b
    # Those in the largest group need no more links with one another.
    groups, sizes = np.unique(b, return_counts=True)
    rest = np.ones(n, bool)
    if len(groups):
        most = groups[np.argmax(sizes)]
        rest = ~np.isin(fps, np.append(a[b == most], most))
    found = int(rest.sum())
    if radius == 3 and (n > MANY or FEW < found <= n // 2):
        c, d = _looked_up(own[rest], changes(2), spots, owner, fps[rest])
    else:
        c, d = _compared(fps[rest], fps, radius)
    return forest(np.concatenate([a, c]), np.concatenate([b, d])) if len(a) + len(c) else (none, none)


def _looked_up(asked, change, spots, owner, node):
    """Links of nodes with the owner of a spot that is one change away. Spots are sorted."""
    left, right = [], []
    for at in range(0, len(asked), part := max(1, STEP // len(change))):
        wanted = asked[at : at + part, None] ^ change
        place = np.minimum(np.searchsorted(spots, wanted), len(spots) - 1)
        row, column = np.nonzero(spots[place] == wanted)
        left.append(node[at + row])
        right.append(owner[place[row, column]])
    left, right = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    other = left != right
    return forest(left[other], right[other]) if other.any() else (left[:0], right[:0])


def _compared(some: np.ndarray, fps: np.ndarray, radius: int):
    """Links of all pairs at ``radius`` bits or fewer."""
    left, right = [], []
    for at in range(0, len(some), part := max(1, STEP // len(fps))):
        cut = some[at : at + part]
        row, column = np.nonzero(np.bitwise_count((cut[:, None] ^ fps).view(np.uint64)) <= radius)
        other = cut[row] != fps[column]
        left.append(cut[row[other]])
        right.append(fps[column[other]])
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))


def verified(key, fp, probe, radius):
    """Links among the rows of each key, as forests. Rows are sorted by key."""
    starts = np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1, [len(key)]])
    order = np.lexsort((probe, key))  # those that lie there first
    fp, probe = fp[order], probe[order]
    sizes = np.diff(starts)
    lying = np.add.reduceat((~probe).astype(np.int64), starts[:-1])
    crowds = (sizes > CROWD) & (lying > 0)
    left, right = [], []
    for k in np.nonzero(crowds)[0]:
        p, q = crowd_links(np.unique(fp[starts[k] : starts[k + 1]]), radius)
        left.append(p)
        right.append(q)
    lying[crowds] = 0
    first, count = np.repeat(starts[:-1], sizes), np.repeat(lying, sizes)
    (asks,) = np.nonzero(probe & (count > 0))
    ends = np.cumsum(count[asks])
    at = 0
    while at < len(asks):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + STEP)))
        some = asks[at:to]
        n = count[some]
        a = np.repeat(some, n)
        b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[some], n)
        good = (np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)) <= radius) & (fp[a] != fp[b])
        if good.any():
            p, q = forest(fp[a[good]], fp[b[good]])
            left.append(p)
            right.append(q)
        at = to
    if not any(map(len, left)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(np.concatenate(left), np.concatenate(right))


def links(distinct: DataFrame, total: int, radius: int) -> DataFrame:
    """``src, dst``: links between fingerprints that connect just what a chain of pairs at
    ``radius`` bits or fewer connects. ``distinct``: ``fp``, a row for each.

    Every probed value is worked on in one task, or in blocks of ``BLOCK`` rows, each pair of
    blocks in a task of its own, where more rows lie there.
    """
    spark = distinct.sparkSession
    rows = checkpoint(signatures(distinct, planned(distinct, total, radius)))
    sizes = rows.groupBy("part", "value").agg(
        F.count_if("probe").alias("asks"), F.count_if(~F.col("probe")).alias("lies")
    )
    crowded = checkpoint(sizes.filter((F.col("asks") > BLOCK) | (F.col("lies") > BLOCK)).select(
        "part", "value",
        F.ceil(F.col("asks") / BLOCK).cast("int").alias("ask_blocks"),
        F.ceil(F.col("lies") / BLOCK).cast("int").alias("lie_blocks"),
    ))
    # A crowded value has over BLOCK rows: this table has less than a 60,000th of the rows.
    few = crowded.count() <= BROADCAST_ROWS
    met = rows.join(F.broadcast(crowded) if few else crowded, ["part", "value"], "left")
    ask, lie = F.greatest(F.coalesce("ask_blocks", F.lit(1)), F.lit(1)), F.greatest(
        F.coalesce("lie_blocks", F.lit(1)), F.lit(1)
    )
    mine = F.pmod(F.xxhash64("fp"), F.when(F.col("probe"), ask).otherwise(lie)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("probe"), lie).otherwise(ask) - 1))
    dealt = met.withColumn("mine", mine).withColumn("other", other)
    keyed = dealt.select(
        F.xxhash64(
            "part", "value",
            F.when(F.col("probe"), F.col("mine")).otherwise(F.col("other")),
            F.when(F.col("probe"), F.col("other")).otherwise(F.col("mine")),
        ).alias("key"),
        "fp", "probe",
    )

    def work(batches):
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            key = now.column("key").to_numpy()
            end = int(np.searchsorted(key, key[-1]))  # the last key may go on
            held = now.slice(end).combine_chunks().to_batches()[0]
            if end:
                yield from out(now.slice(0, end))
        if held is not None and held.num_rows:
            yield from out(held)

    def out(t):
        t = pa.Table.from_batches([t]) if isinstance(t, pa.RecordBatch) else t
        a, b = verified(*(t.column(c).to_numpy() for c in ("key", "fp", "probe")), radius)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

    width = shuffle_width(spark)
    sorted_rows = keyed.repartition(width, "key").sortWithinPartitions("key")
    return sorted_rows.mapInArrow(work, "src long, dst long")


def components(joined: DataFrame) -> DataFrame:
    """``fp, component`` of linked fingerprints, ``component`` the smallest of its own. Few links
    are joined by one task, more in rounds over all."""
    if joined.count() > FEW_LINKS:
        return connected_components(joined).withColumnRenamed("id", "fp")

    def work(batches):
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            a, b = forest(*(np.concatenate(x) for x in zip(*parts)))
            lows = np.unique(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([a, lows])), pa.array(np.concatenate([b, lows]))], ["fp", "component"]
            )

    return joined.coalesce(1).mapInArrow(work, "fp long, component long")


def grouped(marked: DataFrame, radius: int, best: Column) -> DataFrame:
    """``fp, size, best``: how many rows of ``marked`` have each fingerprint, and the smallest
    ``best`` of all rows that links of at most ``radius`` bits reach from it."""
    classes = checkpoint(marked.groupBy("fp").agg(F.count(F.lit(1)).alias("size"), F.min(best).alias("best")))
    found = checkpoint(components(checkpoint(links(classes, classes.count(), radius))))
    # Most fingerprints stand alone; only those of groups look for another's best.
    linked = checkpoint(classes.join(found, "fp").select("fp", "component", "best"))
    lows = checkpoint(linked.groupBy("component").agg(F.min("best").alias("low")))
    led = checkpoint(meet(linked.select("fp", "component"), lows, "component").select("fp", "low"))
    every = classes.join(F.broadcast(led) if led.count() <= BROADCAST_ROWS else led, "fp", "left")
    return checkpoint(every.select("fp", "size", F.coalesce("low", "best").alias("best")))


def near_groups(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: 16 lowercase hex digits, and the
    smallest doc_id that links of at most ``radius`` differing bits reach.

    Null and empty texts have fingerprint zero. A null doc_id keeps its row and never names a
    group that has another id; repeated rows stay repeated. An empty table gives an empty
    result; other columns are not read.
    """
    marked = checkpoint(fingerprints(docs, words))
    groups = grouped(marked, radius, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))
    return join_lookup(marked, groups, ["fp"], "size", HOT_CLASS).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` with one of each group of ``near_groups`` left: that with the smallest
    doc_id, null last; of rows with one id that with the smallest hash of all columns. All
    columns stay as they are, whatever their names. Rows alike in all columns are one."""
    every = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    told = every.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "row",
        F.xxhash64("row").alias("h1"), F.xxhash64(F.lit(1), "row").alias("h2"),
    )
    marked = checkpoint(fingerprints(told.drop("row"), words, ("h1", "h2")))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    kept = grouped(marked, radius, first).select("best.h1", "best.h2").distinct()
    left = told.select("row", "h1", "h2").join(kept, ["h1", "h2"], "left_semi")
    return left.dropDuplicates(["h1", "h2"]).select("row.*")
