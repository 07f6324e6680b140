"""Nearest vectors by collision counting over sorted projections.

Every vector is projected on a few dozen random lines. Around a query a window opens on each
line; a vector that lies in the windows of enough lines is a candidate, and its cosine is
measured. The windows widen by virtual rehashing (the width doubles by a fixed factor; nothing
is hashed anew) until the k best found are nearer than the radius that the windows stand for.

The index is cut into blocks of bounded size, each with sorted arrays of its own, and every
block meets every block of queries in one task. A task returns k rows for each query.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.llm.common import checkpoint

LINES = 40  # projections
SHARE = 0.6  # of the lines on which a candidate collides
HALF = 1.15  # half a window, in radii: 75 % of the vectors at the radius collide on a line
FIRST, GROWTH = 0.4, 1.3  # the first radius, and its growth
BLOCK = 8192  # vectors of a block
ASKS = 4096  # queries of a block
SEED = 7


def scaled_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times a power of two that brings the largest component near 1, so that nothing
    overflows and no digit changes, and their lengths."""
    scaled = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return scaled, np.sqrt((scaled * scaled).sum(axis=1))


class Block:
    """Sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lines: int = LINES):
        self.ids = ids
        self.scaled, self.lengths = scaled_rows(vectors)
        self.normal = np.random.default_rng(SEED).standard_normal((vectors.shape[1], lines))
        projected = (self.scaled / self.lengths[:, None]) @ self.normal
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(projected.T, self.order, axis=1).copy()

    def search(self, own: int, q: np.ndarray, k: int) -> list[tuple[int, float]]:
        """The k nearest found, by (largest cosine, smallest id), without rows of id ``own``."""
        n, need = len(self.ids), ceil(SHARE * len(self.order))
        (asked,), (length,) = scaled_rows(q[None, :])
        at = (asked / length) @ self.normal

        def cosines(rows):  # the same for equal vectors, wherever they stand
            dots = (self.scaled[rows] * asked).sum(axis=1)
            return np.clip(dots / (self.lengths[rows] * length), -1.0, 1.0)

        hits = np.zeros(n, np.int64)
        seen = self.ids == own
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        low = np.array([np.searchsorted(s, a) for s, a in zip(self.sorted, at)])
        high, radius = low.copy(), FIRST
        while True:
            reach = HALF * radius
            new_low = np.array([np.searchsorted(s, a - reach) for s, a in zip(self.sorted, at)])
            new_high = np.array([np.searchsorted(s, a + reach, "right") for s, a in zip(self.sorted, at)])
            flanks = [o[b:c] for o, a, b, c, d in zip(self.order, low, new_low, low, high)]
            flanks += [o[d:c] for o, c, d in zip(self.order, new_high, high)]
            hits += np.bincount(np.concatenate(flanks), minlength=n)
            low, high = new_low, new_high
            (fresh,) = np.nonzero((hits >= need) & ~seen)
            if len(fresh):
                seen[fresh] = True
                best_ids = np.concatenate([best_ids, self.ids[fresh]])
                best = np.concatenate([best, cosines(fresh)])
                keep = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[keep], best[keep]
            # On the unit sphere a distance r is a cosine of 1 - r * r / 2.
            if len(best) == k and best[-1] >= 1 - radius * radius / 2 or radius > 2:
                break
            radius *= GROWTH
        if radius > 2 and len(best) < k:  # few vectors: the rest is measured
            (fresh,) = np.nonzero(~seen)
            best_ids = np.concatenate([best_ids, self.ids[fresh]])
            best = np.concatenate([best, cosines(fresh)])
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
        return list(zip(best_ids.tolist(), best.tolist()))


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """``vec_id, v, dim`` of the vectors that can be compared."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), bad.alias("bad"))
    rows = rows.filter(~F.col("bad") & F.col("vec_id").isNotNull())
    return rows.filter(F.exists("v", lambda x: x != 0)).select("vec_id", "v", F.size("v").alias("dim"))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, column: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of each query among the other rows.

    Score: cosine in double precision; ties go to the smaller id. Vectors that are null, zero,
    or hold null or non-finite components take no part, nor do rows without id; vectors of
    another length than the query's aren't compared with it. A query without candidates has no
    row. Repeated ids are rows like any other, but for the query's own id. Other columns aren't
    read.
    """
    data = checkpoint(usable(vectors, column))
    asked = checkpoint(usable(queries, column).distinct())
    blocks = max(1, ceil(data.count() / block))
    chunks = max(1, ceil(asked.count() / ASKS))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    placed = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    lying = data.withColumn("block", placed(blocks)).withColumn("chunk", each(chunks))
    asking = asked.withColumn("chunk", placed(chunks)).withColumn("block", each(blocks))
    keys = ["dim", "block", "chunk"]

    def work(some: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(some) and len(asks):
            index = Block(some["vec_id"].to_numpy(), np.stack(some["v"].to_numpy()))
            for own, q in zip(asks["vec_id"], asks["v"]):
                found += [(own, *f) for f in index.search(own, np.asarray(q), k)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    met = lying.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(
        work, "query_id long, vec_id long, score double"
    )
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
