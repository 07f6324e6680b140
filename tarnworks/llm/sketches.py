"""Document fingerprints as invertible Bloom lookup sketches.

A text is cut by its content into short pieces: at ends of paragraphs and sentences, at some
words and at some characters, which depends on the few code points before, so a change spoils
little and texts of any length are cut alike. Each piece has a digest of 64 bits (with the number
of its occurrence, so repeats count) that goes into one cell of each of three tables: a cell
keeps how many digests it holds, their sum and the sum of a second hash of them. The difference
of two sketches holds only the digests that the texts don't share; peeling takes them out one
by one from cells that hold a single one. Where peeling fails the sketches are too small, and
larger ones are made.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.common import shuffle_width

CELLS = 12  # of the stored fingerprint, in three tables
ROOM = 1.6  # times as many cells as digests are to be peeled
TABLES = 3
# Code points of a piece, about; none is longer than four times that. Words have about six.
PIECE_CHARS, WORD_CHARS = 16, 6
# Code points that are cut at once, and those that tell whether a piece ends.
CHUNK, BEFORE = 1 << 20, 3
# Ends of sentences in Latin, Greek, Arabic, Devanagari, Ethiopic, Burmese, Khmer, Tibetan,
# Armenian and East Asian scripts.
ENDS = np.array(sorted(map(ord, ".!?\u037e\u0589\u061f\u06d4\u0964\u0965\u0f0d\u104a\u104b\u1362\u1367\u1368\u17d4\u17d5\u2026\u203c\u2047\u2048\u2049\u3002\ufe52\uff01\uff0e\uff1f\uff61")), np.uint32)
# Spaces between words, with those of other scripts.
SPACES = np.array(sorted(map(ord, "\t\x0b\x0c\r \x85\xa0\u1361\u1680\u2028\u2029\u202f\u205f\u3000")), np.uint32)
U = np.uint64


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser over integers."""
    z = x + U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> U(30))) * U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> U(27))) * U(0x94D049BB133111EB)
    return z ^ (z >> U(31))


def cut_marks(points: np.ndarray) -> np.ndarray:
    """Whether a piece ends after each code point. That of a word or character depends on the
    last four code points."""
    wide = points.astype(U)
    window = wide * U(0x9E3779B97F4A7C15)
    for k in range(1, BEFORE + 1):
        window[k:] ^= wide[:-k] << U(21 * k - 13) if k < 3 else wide[:-k] * U(0xC2B2AE3D27D4EB4F)
    window = (window ^ (window >> U(29))) * U(0xBF58476D1CE4E5B9)
    chance = (window >> U(40)).astype(np.int64)  # of 2^24
    marks = _any_of(points, ENDS)
    marks[:-1] &= ~marks[1:]
    marks |= points == 10
    marks |= _any_of(points, SPACES) & (chance * PIECE_CHARS < WORD_CHARS << 24)
    return marks | (chance * 4 * PIECE_CHARS >= (4 * PIECE_CHARS - 1) << 24)


def _any_of(points: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Whether each code point is one of a few; by a table, as most are small."""
    small = np.zeros(256, bool)
    small[few[few < 256]] = True
    out = small[np.minimum(points, 255)]
    (large,) = np.nonzero(points >= 255)
    out[large] = np.isin(points[large], few)
    return out


def _cut(parts: list[tuple[str, str, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts, all at once: first code point, end, digest and which text.

    Each text comes as the ``BEFORE`` code points before it (NUL where there are none), itself
    and whether it ends there. Of one that goes on the last piece is left out.
    """
    points = np.frombuffer("".join(c + t for c, t, _ in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t) + BEFORE for _, t, _ in parts), np.int64, len(parts))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marks = cut_marks(points)
    for k in range(BEFORE):
        marks[starts + k] = k == BEFORE - 1  # what comes before is a piece of its own
    marks[ends - 1] = True
    (last,) = np.nonzero(marks)
    lengths = np.diff(last, prepend=-1)
    most = 4 * PIECE_CHARS
    if (lengths > most).any():
        offset = np.arange(len(points)) - np.repeat(last - lengths + 1, lengths)
        marks |= offset % most == most - 1
        (last,) = np.nonzero(marks)
        lengths = np.diff(last, prepend=-1)
    first = last - lengths + 1
    place = np.arange(len(points)) - np.repeat(first, lengths)
    values = _mixed(points.astype(U) | (place.astype(U) << U(21)), 5)
    values[points == 10] = 0  # line ends don't count
    digest = _mixed(np.add.reduceat(values, first) if len(first) else np.zeros(0, U), 0)
    empty = (points[first] == 10) & (lengths == 1)
    owner = np.searchsorted(ends, first, side="right")
    whole = np.array([done for _, _, done in parts])[owner] | (last < ends[owner] - 1)
    kept = (first >= starts[owner] + BEFORE) & whole & ~empty
    base = starts[owner] + BEFORE
    return (first - base)[kept], (last + 1 - base)[kept], digest[kept], owner[kept]


def _pieces(texts: list[str]):
    """Start, end and digest of all pieces, and the text of each; long texts go in chunks."""
    at = dict.fromkeys((i for i, t in enumerate(texts) if t), 0)
    found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, U), np.zeros(0, np.int64))]
    while at:
        numbers = np.array(list(at))
        parts = []
        for i, a in at.items():
            before = texts[i][max(0, a - BEFORE) : a].rjust(BEFORE, "\0")
            parts.append((before, texts[i][a : a + CHUNK], a + CHUNK >= len(texts[i])))
        first, last, digest, owner = _cut(parts)
        base = np.array(list(at.values()))[owner] if len(owner) else owner
        found.append((first + base, last + base, digest, numbers[owner]))
        done = np.zeros(len(parts), np.int64)
        np.maximum.at(done, owner, last)
        # Ends of lines alone leave no piece, but are read.
        at = {i: a + (int(d) or CHUNK - 1) for (i, a), d, p in zip(at.items(), done, parts) if not p[2]}
    return [np.concatenate(x) for x in zip(*found)]


def pieces(text: str) -> list[str]:
    """Runs of the text, cut by content, without line ends."""
    first, last, _, _ = _pieces([text])
    own = (text[a:b].strip("\n") for a, b in zip(first.tolist(), last.tolist()))
    return [p for p in own if p]


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all texts' pieces, one after another, and the text of each."""
    _, _, keys, owner = _pieces(texts)
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    if len(keys):
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
        keys = _mixed(keys, 0) ^ _mixed((np.arange(len(keys)) - first).astype(U), 1)
    return keys, owner


def picked(keys: np.ndarray, owner: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the texts with these numbers, in that order; owners are sorted."""
    a, b = (np.searchsorted(owner, texts, side=s) for s in ("left", "right"))
    n = b - a
    return keys[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())], np.repeat(np.arange(len(texts)), n)


class Sketches:
    """Sketches of many texts; text i has ``cells[i]`` cells, a multiple of three."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.start = np.concatenate([[0], np.cumsum(cells)])
        n = int(self.start[-1])
        self.count = np.zeros(n, np.int64)
        self.keys, self.checks = np.zeros(n, U), np.zeros(n, U)

    def places(self, keys: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
        width = (self.cells[owner] // TABLES).astype(U)
        base = self.start[owner]
        return [
            base + (_mixed(keys, 2 + t) % width).astype(np.int64) + t * width.astype(np.int64)
            for t in range(TABLES)
        ]

    def add(self, keys: np.ndarray, owner: np.ndarray, sign) -> list[np.ndarray]:
        """Put digests into their cells, or take them out; returns the cells."""
        check = _mixed(keys, 7)
        factor = np.asarray(sign, np.int64).astype(U)  # 1 or its opposite, modulo 2^64
        keys_in, checks_in = keys * factor, check * factor
        cells = self.places(keys, owner)
        for at in cells:
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, keys_in)
            np.add.at(self.checks, at, checks_in)
        return cells

    def of(self, texts: np.ndarray) -> Sketches:
        """The sketches of some texts, where all have as many cells."""
        out = Sketches(self.cells[texts])
        for name in ("count", "keys", "checks"):
            setattr(out, name, getattr(self, name).reshape(len(self.cells), -1)[texts].ravel())
        return out

    def spread(self) -> np.ndarray:
        """An estimate of how many digests each difference holds, from the squares of the counts:
        of digests dealt at random with a sign each, n + (sum * sum - n) / width are expected."""
        if not len(self.count):
            return np.zeros(len(self.cells))
        squares = np.add.reduceat(self.count.astype(float) ** 2, self.start[:-1]) / TABLES
        total = np.add.reduceat(self.count, self.start[:-1]) / TABLES
        width = self.cells / TABLES
        return np.maximum(squares - total * total / width, 0) / (1 - 1 / width) + np.abs(total)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.cells)
        out.count = self.count - other.count
        out.keys, out.checks = self.keys - other.keys, self.checks - other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Digests with text and sign (1: only in the first), and whether each text's are all."""
        owner_of = np.repeat(np.arange(len(self.cells)), self.cells)
        found = [], [], []
        active = np.arange(len(self.count))
        while len(active):
            one = np.abs(self.count[active]) == 1
            cells = active[one]
            factor = self.count[cells].astype(U)
            pure = cells[self.checks[cells] * factor == _mixed(self.keys[cells] * factor, 7)]
            if not len(pure):
                break
            owner, sign = owner_of[pure], self.count[pure]
            keys = self.keys[pure] * sign.astype(U)
            both = keys + owner.astype(U) * U(0x9E3779B97F4A7C15)  # a digest in several cells
            order = np.argsort(both)
            both = both[order]
            new = order[np.concatenate([[True], both[1:] != both[:-1]])]
            keys, owner, sign = keys[new], owner[new], sign[new]
            for kept, part in zip(found, (keys, owner, sign)):
                kept.append(part)
            active = np.concatenate(self.add(keys, owner, -sign))
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        failed = np.zeros(len(self.cells), bool)
        failed[owner_of[left]] = True
        join = [np.concatenate(f) if f else np.zeros(0, U if i == 0 else np.int64) for i, f in enumerate(found)]
        return join[0], join[1], join[2], ~failed

    def text(self, i: int) -> str:
        """Cells of one sketch as a string: count, key and check of each."""
        a, b = self.start[i], self.start[i + 1]
        rows = np.stack([self.count[a:b].astype(U), self.keys[a:b], self.checks[a:b]], axis=1)
        return base64.b85encode(rows.astype("<u8").tobytes()).decode()


def sketched(keys, owner, n: int, cells: np.ndarray | int) -> Sketches:
    s = Sketches(np.full(n, cells) if np.isscalar(cells) else cells)
    s.add(keys, owner, 1)
    return s


def differences(a, b, n: int, first: Sketches | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many digests each two texts don't share, and how many tries that took.

    ``a``, ``b``: digests and owners; ``first``: differences of their stored sketches. Texts whose
    sketches don't peel are tried again with cells for twice as many digests as the failed
    difference seems to hold, and at least twice as many cells as before, so tries end.
    """
    out, tries = np.zeros(n, np.int64), np.zeros(n, np.int64)
    open_ones = np.arange(n)
    if first is None:
        first = sketched(*a, n, CELLS).minus(sketched(*b, n, CELLS))
    while len(open_ones):
        wanted = np.maximum(2 * first.cells, 1.4 * ROOM * first.spread())
        _, owner, _, good = first.peel()
        differing = np.bincount(owner, minlength=len(open_ones))
        tries[open_ones] += 1
        out[open_ones[good]] = differing[good]
        open_ones = open_ones[~good]
        cells = (TABLES * np.ceil(wanted[~good] / TABLES)).astype(np.int64)
        pa_, pb = picked(*a, open_ones), picked(*b, open_ones)
        first = sketched(*pa_, len(open_ones), cells).minus(sketched(*pb, len(open_ones), cells))
    return out, tries


def likeness(a, b, n: int, first: Sketches | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Shared digests over all digests of each two texts, 1 for two without any."""
    differ, tries = differences(a, b, n, first)
    both = np.bincount(a[1], minlength=n) + np.bincount(b[1], minlength=n)
    shared = (both - differ) / 2
    every = both - shared
    return np.where(every > 0, shared / np.maximum(every, 1), 1.0), tries


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _part_of(cuts: list[int], heavy: dict[int, int], nulls: int):
    """A function that numbers the part of a row by its id and text hash.

    Parts hold the ids from one cut up to the next, downwards; the last one holds null ids too.
    An id that fills several parts alone, and null if it does, is cut again by the hash."""
    low_first = np.array(sorted(set(cuts)), np.int64)
    each = max([nulls, *heavy.values()], default=0) + 1

    @F.pandas_udf("long")
    def part(doc_id: pd.Series, own: pd.Series) -> pd.Series:
        none = doc_id.isna().to_numpy()
        ids = doc_id.fillna(0).to_numpy().astype(np.int64)
        at = np.where(none, len(low_first), len(low_first) - np.searchsorted(low_first, ids, side="right"))
        share = (own.to_numpy().astype(np.float64) + 2.0**63) / 2.0**64
        times = np.where(none, nulls, 0)
        for i, n in heavy.items():
            times[(ids == i) & ~none] = n
        inner = np.where(times > 0, 1 + np.minimum(times - 1, (share * times).astype(np.int64)), 0)
        return pd.Series(at * each + inner)

    return part


def with_next(docs: DataFrame) -> DataFrame:
    """``part, guest, doc_id, text`` in partitions, each sorted so that the row after a row is
    its next document by descending doc_id (null last; one id: by text hash).

    The order is cut in some times as many parts as there are partitions. The first row of each
    part goes to the part before too, as its guest, and the very first as guest to the last one.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("own", F.xxhash64("text"))
    shares = [k / (4 * width) for k in range(1, 4 * width)]
    said = rows.agg(
        F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), F.lit(10_000)).alias("cuts"),
        F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.count(F.lit(1)).alias("n"),
    ).first()
    cuts = said["cuts"] or []  # bounded by the number of partitions
    heavy = {i: n for i, n in Counter(cuts).items() if n > 1}
    nulls = ceil(said["nulls"] * 4 * width / max(1, said["n"]))
    part = _part_of(cuts, heavy, nulls if nulls > 1 else 0)
    keyed = rows.withColumn("part", part("doc_id", "own"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("down"), "own"))
    firsts = keyed.select("doc_id", "own", "part").groupBy("part").agg(first.alias("f")).collect()
    used = sorted(r["part"] for r in firsts)
    before = {p: used[i - 1] for i, p in enumerate(used)}  # the first's: the last
    tops = [
        (None if r["f"]["none"] else -r["f"]["down"], r["f"]["own"], r["part"], before[r["part"]]) for r in firsts
    ]
    top = spark.createDataFrame(tops, "top long, hash long, of long, to long")  # a row for each part
    same = keyed["doc_id"].eqNullSafe(top["top"]) & (keyed["own"] == top["hash"])
    guests = keyed.join(F.broadcast(top), same & (keyed["part"] == top["of"]))
    # One guest: of rows with one id and hash, the first text.
    guests = guests.groupBy(F.col("to").alias("part")).agg(F.min(F.struct("text", "doc_id", "own")).alias("first"))
    guests = guests.select("part", F.lit(True).alias("guest"), "first.doc_id", "first.text", "first.own")
    own = keyed.select("part", F.lit(False).alias("guest"), "doc_id", "text", "own")
    dealt = own.unionByName(guests).repartition(2 * width, "part")
    in_order = dealt.sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "own", "text")
    return in_order.select("part", "guest", "doc_id", "text")


def _pairs(batches, at_once: int = 2000, chars: int = 1 << 17):
    """Lists of (doc_id, text, next text)."""
    out, size, last = [], 0, None
    for batch in batches:
        for part, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            if last is not None and last[0] == part:
                out.append((last[1], last[2], text))
                size += len(text)
                if len(out) >= at_once or size > chars:
                    yield out
                    out, size = [], 0
            last = None if guest else (part, doc_id, text)
    if out:
        yield out


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    tries_edited, tries_next``.

    The edited text is the document with its last third replaced by the beginning of the next
    one by descending id. ``near_*``: shared pieces over all pieces, from peeled differences;
    1 for two texts without any. ``tries_*``: how often a sketch was made for that. Null texts
    are empty ones. A null id comes last; rows with one id follow each other by text hash. The
    only row of a table is its own next. Equal texts have equal fingerprints. Empty tables give
    no rows; other columns aren't read.
    """

    def work(batches):
        for rows in _pairs(batches):
            n = len(rows)
            texts, following = [r[1] for r in rows], [r[2] for r in rows]
            edited = [edited_text(a, b) for a, b in zip(texts, following)]
            own_all = digests(texts + [t for k, t in enumerate(following) if k + 1 == n or t is not texts[k + 1]])
            later = iter(range(n, 2 * n))
            places = [k + 1 if k + 1 < n and t is texts[k + 1] else next(later) for k, t in enumerate(following)]
            own, after = picked(*own_all, np.arange(n)), picked(*own_all, np.array(places))
            changed = digests(edited)
            every = sketched(*own_all, len(set(places) | set(range(n))), CELLS)
            plain, other = every.of(np.arange(n)), sketched(*changed, n, CELLS)
            near_edited, tries = likeness(own, changed, n, plain.minus(other))
            near_next, more = likeness(own, after, n, plain.minus(every.of(np.array(places))))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
                    pa.array([plain.text(i) for i in range(n)]),
                    pa.array([other.text(i) for i in range(n)]),
                    pa.array(near_edited), pa.array(near_next), pa.array(tries), pa.array(more),
                ],
                [
                    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    "near_edited", "near_next", "tries_edited", "tries_next",
                ],
            )

    return with_next(docs).mapInArrow(
        work,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, tries_edited long, tries_next long",
    )
