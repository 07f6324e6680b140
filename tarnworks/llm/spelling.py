"""Spelling variants by search schemes over suffix ranks.

Two words that differ by one inserted, deleted or replaced character share the first half of
either one, or its second half. So each word is searched twice: the one half is matched exactly
and the rest letter by letter with one error allowed. A search keeps an interval of the sorted
suffixes of the vocabulary, written one word after another between delimiters; a step to the
next letter is two rank queries. The index is bidirectional: suffix ranks of the vocabulary
extend a match to the left, those of the reversed vocabulary to the right. A scheme starts at
a delimiter and goes one way only, so each task holds the direction that it needs.

The vocabulary is never in one place. A word is sent to the shards of the halves that a
neighbour could share with it, and asks in the shards of its own two halves. A shard that has
more words than a block holds is cut in blocks, each with an index of its own, and its
questions go to all of them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.common import checkpoint

# Fixed values of the query: shortest word, fewest occurrences, how often a letter is lost.
LETTERS, OCCURRENCES, LOSS = 5, 3, 97
# A form occurs at least so many times as often as its variant.
RATIO = 2
# Words of one index, about. A shard has no more than twice as many, or is cut.
BLOCK = 50_000
# Different words that a task counts before it hands them on.
HELD = 400_000
# Questions, and letters of questions, that are searched in one step.
ASKED, ASKED_LETTERS = 4096, 1 << 20

# Latin-1 bytes: letters as they are, A-Z in lower case, all else as a space.
_RUNS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)


def word_counts(docs: DataFrame, letters: int = LETTERS, loss: int = LOSS) -> DataFrame:
    """``word, n``: occurrences of every word of at least ``letters`` letters over all texts.

    Words are the longest runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. Where
    ``loss`` divides the crc32 of ``<doc_id>:<run>``, the run loses its letter at that number
    modulo its length. A null doc_id is written as nothing; a null text has no words.
    """

    def flushed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([w.decode("latin-1") for w in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            ["word", "n"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                base = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                runs = text.encode("latin-1", "replace").translate(_RUNS).split()
                for run, n in Counter(runs).items():
                    size = len(run)
                    if size < letters:
                        continue
                    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), base)
                    if h % loss:
                        counts[run] += n
                    elif size > letters:
                        at = h % size
                        counts[run[:at] + run[at + 1 :]] += n
                if len(counts) >= HELD:
                    yield flushed(counts)
                    counts = Counter()
        if counts:
            yield flushed(counts)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class SuffixIndex:
    """Suffix ranks of words (Latin-1 bytes) written one after another between delimiters.

    ``step`` narrows intervals of the sorted suffixes to those before which a letter stands, so
    matches grow to the left. With reversed words they grow to the right.
    """

    def __init__(self, words: list[bytes]):
        raw = np.frombuffer(b"\x00" + b"\x00".join(words) + b"\x00", np.uint8)
        used = np.unique(raw)  # 0 is the delimiter
        self.code = np.full(256, -1, np.int64)
        self.code[used] = np.arange(len(used))
        self.symbols = len(used)
        self.text = self.code[raw].astype(np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])  # of the delimiter before
        self.order = self._sorted(self.text.astype(np.int64))
        self.before = self.text[self.order - 1]
        n = len(self.text)
        words_of_bits = n // 64 + 1
        self.bits = np.zeros((self.symbols, words_of_bits), np.uint64)
        for c in range(self.symbols):
            packed = np.packbits(self.before == c, bitorder="little")
            self.bits[c].view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.bits).astype(np.int64)
        self.ahead = (np.cumsum(ones, axis=1) - ones).astype(np.int32)
        sizes = np.bincount(self.text, minlength=self.symbols)
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]])

    @staticmethod
    def _sorted(codes: np.ndarray) -> np.ndarray:
        """Start of every suffix in their order, by doubling what is compared."""
        n, wide = len(codes), 8  # a code has 7 bits
        padded = np.concatenate([codes + 1, np.zeros(wide, np.int64)])
        key = np.zeros(n, np.int64)
        for k in range(wide):
            key = (key << 7) | padded[k : k + n]
        while True:
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
            if rank[order[-1]] == n - 1:
                return order
            later = np.zeros(n, np.int64)
            if wide < n:
                later[: n - wide] = rank[wide:] + 1
            key = rank * (n + 1) + later
            wide *= 2

    def _rank(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.ahead[code, word] + np.bitwise_count(self.bits[code, word] & below)

    def step(self, code, low, high):
        """Interval of each match with a letter more; empty where the letter doesn't occur."""
        known = np.where(code < 0, 0, code)
        a = self.first[known] + self._rank(known, low)
        b = self.first[known] + self._rank(known, high)
        return a, np.where(code < 0, a, b)

    def steps(self, low, high):
        """All letters that stand before each match: which match, letter, interval."""
        size = high - low
        (wide,) = np.nonzero(size > 2 * self.symbols)
        (slim,) = np.nonzero(size <= 2 * self.symbols)
        n = size[slim]
        each = np.repeat(slim, n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[each]
        pairs = np.unique(each * self.symbols + self.before[place])
        all_wide = (wide[:, None] * self.symbols + np.arange(self.symbols)).ravel()
        pairs = np.concatenate([pairs, all_wide])
        which, code = np.divmod(pairs, self.symbols)
        which, code = which[code > 0], code[code > 0]
        a, b = self.step(code, low[which], high[which])
        alive = b > a
        return which[alive], code[alive], a[alive], b[alive]

    def near(self, asked: np.ndarray, exact: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``asked``, word) one error apart, the error after the first ``exact``
        letters. ``asked`` holds words of one length as codes (-1: not in this index), in the
        order in which they are matched.

        Of equal ways to the same word only the last is gone: a letter is not inserted before
        an equal one, nor the first of two equal ones deleted.
        """
        rows, length = asked.shape
        which = np.arange(rows)
        low, high = self.step(np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.full(rows, len(self.text)))
        waiting = [[] for _ in range(length + 2)]  # matches with an error, by letters matched
        for t in range(length + 1):
            if t >= exact:
                own = asked[which, t] if t < length else np.full(len(which), -2)
                at, code, a, b = self.steps(low, high)
                other = code != own[at]
                found = (which[at[other]], a[other], b[other])
                waiting[t].append(found)  # inserted
                if t < length:
                    waiting[t + 1].append(found)  # replaced
                    last = np.ones(len(which), bool) if t + 1 == length else own != asked[which, t + 1]
                    waiting[t + 1].append((which[last], low[last], high[last]))  # deleted
                late, a, b = (np.concatenate(x) for x in zip(*waiting[t]))
                end = asked[late, t] if t < length else np.zeros(len(late), np.int64)
                a, b = self.step(end, a, b)
                alive = b > a
                waiting[t] = []
                waiting[t + 1].append((late[alive], a[alive], b[alive]))
            if t < length:
                low, high = self.step(asked[which, t], low, high)
                alive = high > low
                which, low, high = which[alive], low[alive], high[alive]
        late, a, b = (np.concatenate(x) for x in zip(*waiting[length + 1]))
        # A match between two delimiters is one word.
        return late, np.searchsorted(self.starts, self.order[a])


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def placed(words: DataFrame, shards: int) -> DataFrame:
    """``shard, asks, word, n``: each word in the shards where neighbours may ask for it, and as
    a question in those of its own halves. Shards below ``shards`` are of first halves."""
    size = F.length("word")

    def shard(side: int, part: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(side), part), F.lit(shards)).cast("int") + side * shards

    firsts = [shard(0, F.left("word", _half(size + d))) for d in (-1, 0, 1)]
    seconds = [shard(1, F.right("word", size + d - _half(size + d))) for d in (-1, 0, 1)]
    own = [shard(0, F.left("word", _half(size))), shard(1, F.right("word", size - _half(size)))]
    lies = F.transform(F.array_distinct(F.array(*firsts, *seconds)), lambda s: F.struct(s.alias("shard"), F.lit(False).alias("asks")))
    asks = F.array(*[F.struct(s.alias("shard"), F.lit(True).alias("asks")) for s in own])
    return words.select(F.explode(F.concat(lies, asks)).alias("to"), "word", "n").select("to.*", "word", "n")


def _answers(index: SuffixIndex, words: list[bytes], counts: np.ndarray, first_half: bool, asked: list[bytes]):
    """Rows ``word, n_near, best_n, best`` of one batch of questions."""
    lengths = np.fromiter(map(len, asked), np.int64, len(asked))
    alphabet = index.code
    for m in np.unique(lengths).tolist():
        (rows,) = np.nonzero(lengths == m)
        for at in range(0, len(rows), part := max(1, min(ASKED, ASKED_LETTERS // m))):
            some = rows[at : at + part]
            raw = np.frombuffer(b"".join(asked[i] for i in some), np.uint8).reshape(len(some), m)
            codes = alphabet[raw]
            half = m // 2
            if first_half:
                late, found = index.near(codes, half)
            else:
                late, found = index.near(codes[:, ::-1], m - half)
                # Words that share the first half too are found there.
                differs = np.zeros(len(late), bool)
                starts = index.starts[found] + 1
                for k in range(half):  # a found word is one letter shorter at most
                    differs |= index.text[starts + k] != codes[late, k]
                late, found = late[differs], found[differs]
            if not len(late):
                continue
            order = np.lexsort((found, -counts[found], late))
            late, found = late[order], found[order]
            heads = np.concatenate([[True], late[1:] != late[:-1]])
            (first,) = np.nonzero(heads)
            sizes = np.diff(np.concatenate([first, [len(late)]]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([asked[i].decode("latin-1") for i in some[late[first]]], pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts[found[first]], pa.int64()),
                    pa.array([words[i].decode("latin-1") for i in found[first]], pa.string()),
                ],
                ["word", "n_near", "best_n", "best"],
            )


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best`` of every word that has a near one: how many there are and
    the most frequent of them (of equal ones the smallest). ``words``: ``word, n``, checkpointed,
    one row for each word."""
    spark = words.sparkSession
    shards = max(1, ceil(2 * words.count() / block))
    rows = placed(words, shards)
    # Two rows for each shard, a 50,000th of the words.
    sizes = checkpoint(rows.filter(~F.col("asks")).groupBy("shard").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / (2 * block))).cast("int").alias("blocks")
    ))
    cut = sizes.filter("blocks > 1")
    met = rows.join(F.broadcast(cut), "shard", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    every = F.when(F.col("asks"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
    dealt = met.select("shard", F.explode(every).alias("block"), "asks", "word", "n")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, counts, index = None, [], [], None
        for batch in batches:
            shard, part, asks, word, n = (batch.column(c) for c in range(5))
            marks = shard.to_numpy().astype(np.int64) * (1 << 31) + part.to_numpy()
            kinds = asks.to_numpy(zero_copy_only=False)
            ends = np.nonzero((marks[1:] != marks[:-1]) | (kinds[1:] != kinds[:-1]))[0] + 1
            for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(marks)]):
                if marks[a] != key:
                    key, held, counts, index = marks[a], [], [], None
                some = [w.encode("latin-1") for w in word.slice(a, b - a).to_pylist()]
                if not kinds[a]:
                    held += some
                    counts += n.slice(a, b - a).to_pylist()
                    continue
                if not held:
                    continue
                first_half = int(shard[a].as_py()) < shards
                if index is None:  # words come sorted, so places are in code point order
                    index = SuffixIndex([w[::-1] for w in held] if first_half else held)
                    counts = np.array(counts, np.int64)
                yield from _answers(index, held, counts, first_half, some)

    width = max(1, 2 * shards)
    sorted_rows = dealt.repartition(width, "shard", "block").sortWithinPartitions("shard", "block", "asks", "word")
    found = sorted_rows.mapInArrow(work, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("order"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.order")).alias("best_n"), F.col("top.best").alias("best")
    )


def followed(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last word that forms lead to. Each round doubles
    the way that is known; counts at least double along it, so there are few rounds."""
    links = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = checkpoint(links.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ))
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (``word, n``).

    Two words are near if they differ by exactly one inserted, deleted or replaced letter. The
    form of a word is its near word of largest n (ties: the smallest in code point order) if
    that has at least ``ratio`` (2 or more) times the word's n, else null; the root is the last
    word that forms lead to, the word itself without a form. Words are of Latin-1 letters, each
    at least 2 long; repeated words are added up, null words left out. An empty table gives
    an empty result; further columns are not read.
    """
    rows = words.select(F.col("word").cast("string"), F.col("n").cast("long")).filter("word is not null")
    rows = checkpoint(rows.groupBy("word").agg(F.sum("n").alias("n")))
    near = checkpoint(near_words(rows, block))
    all_rows = checkpoint(rows.join(near, "word", "left").withColumn(
        "form", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    ))
    roots = followed(all_rows.filter("form is not null"))
    return all_rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )


def spelling_groups(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of at least ``LETTERS`` letters and ``OCCURRENCES`` occurrences
    in whole texts (``doc_id, text``; other columns are not read). Repeated rows count as often
    as they occur. Null and empty texts have no words; no words give an empty result."""
    return variants(word_counts(docs).filter(F.col("n") >= OCCURRENCES))
