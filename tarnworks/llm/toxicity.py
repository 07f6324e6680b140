"""Toxic passages as maximum-scoring segments over token log-odds.

Fit: for every feature of a word (the word, and its beginnings of three to six letters, hashed
into a fixed number of bins) the log-odds of standing in a toxic document against a clean one,
under a Dirichlet prior in proportion to its overall frequency, less some standard errors. A
word scores its best feature, less a drift that makes ordinary text score below zero. How many
standard errors and how much drift is chosen by the loss on rows that the weights were not
counted on: the training rows are dealt in folds, and each is scored by the counts of the others.

Score: one pass over a text finds every maximal segment (Ruzzo and Tompa). Under the clean
documents' word scores the best of n chance segments follows an extreme-value law whose rate
solves E[exp(rate * score)] = 1; a segment counts by how far it lies above what chance gives in
a text of that length. A logistic curve, fitted on the training rows, turns the sum into a score.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log, log1p
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.llm.common import checkpoint

BINS = 1 << 18
STEMS = (3, 4, 5, 6)
# Labelled rows that the classifier is fitted on at most, taken by hash.
FIT_ROWS = 32_768
FOLDS, HELD_OUT = 5, 0
PRIOR, PRIOR_SHARE = 0.1, 0.01
PARTS = 4  # parts of the training rows, each scored by the counts of the others
# Standard errors that are taken off and drift: the candidates.
CHOICES = ((0.7, 1.0), (1.0, 0.75), (2.0, 0.5), (3.0, 0.25))
TOP = 6.0  # most that a word can score
K = 0.3  # the extreme-value law's factor for the number of starting points
MEMO = 1 << 19  # words that a worker remembers
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


def bins_of(word: bytes) -> tuple[int, ...]:
    stems = {word[:n] for n in STEMS if len(word) > n}
    return tuple(crc32(s) % BINS for s in (*sorted(stems), word + b"$"))


def held_out(doc_id: Column) -> Column:
    folded = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(folded == HELD_OUT, F.lit(False))


def fit_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``text, toxic``: labelled rows outside the held-out fold, each text once, at most ``rows``.

    A document labelled both ways is toxic. The rows are those with the smallest hashes, of their
    ids and then, where ids are shared by several texts, of the texts.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    met = texts.join(F.broadcast(checkpoint(some)), "doc_id")  # bounded by ``rows``
    each = met.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    each = each.agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    part = F.pmod(F.crc32(F.col("h").cast("binary")), F.lit(PARTS)).cast("int").alias("part")
    found = checkpoint(each.select("h", "text", "toxic", part))
    if found.count() > rows:
        last = found.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
        found = checkpoint(found.filter(F.col("h") <= last))
    return found.drop("h")


def feature_counts(fit: DataFrame) -> np.ndarray:
    """[part, toxic, bin]: documents of each part and kind that hold a feature of the bin."""
    names = [f"n{k}" for k in range(2 * PARTS)]

    def work(batches):
        counts, memo = np.zeros((2 * PARTS, BINS), np.int64), {}
        for batch in batches:
            for text, toxic, part in zip(*(c.to_pylist() for c in batch.columns)):
                seen: set[int] = set()
                for w in set(words_of(text)):
                    found = memo.get(w)
                    if found is None:
                        found = bins_of(w)
                        if len(memo) < MEMO:
                            memo[w] = found
                    seen.update(found)
                if seen:
                    counts[2 * part + toxic, np.fromiter(seen, np.int64, len(seen))] += 1
        (at,) = np.nonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(c[at]) for c in counts]], ["bin", *names])

    rows = fit.select("text", "toxic", "part").mapInArrow(
        work, "bin long, " + ", ".join(f"{n} long" for n in names)
    )
    found = rows.groupBy("bin").agg(*[F.sum(n).alias(n) for n in names]).toPandas()  # at most BINS rows
    out = np.zeros((2 * PARTS, BINS))
    out[:, found["bin"].to_numpy()] = found[names].to_numpy().T
    return out.reshape(PARTS, 2, BINS)


def log_odds(clean: np.ndarray, toxic: np.ndarray, errors: float) -> np.ndarray:
    """Log-odds of each bin less the standard errors, where that is above zero."""
    prior = PRIOR + PRIOR_SHARE * (clean + toxic)
    side = lambda n: np.log((n + prior) / (n.sum() + 1 - n + prior))
    error = np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    return np.where(clean + toxic > 0, np.maximum(0, side(toxic) - side(clean) - errors * error), 0)


class Words:
    """Scores of words, one for each column of the weights, remembered while there is room."""

    def __init__(self, weights: np.ndarray, drifts: list[float]):
        self.weights, self.drifts, self.known = weights, np.array(drifts), {}

    def score(self, word: bytes) -> tuple[float, ...]:
        best = self.weights[list(bins_of(word))].max(axis=0)
        s = tuple((np.minimum(TOP, best) - self.drifts).tolist())
        if len(self.known) >= MEMO:
            self.known.clear()
        self.known[word] = s
        return s

    def scores(self, text: str | None) -> np.ndarray:
        """[word, column]."""
        words = words_of(text)
        get, score = self.known.get, self.score
        found = list(map(get, words))
        if None in found:
            found = [get(w) or score(w) if s is None else s for w, s in zip(words, found)]
        return np.array(found, float).reshape(len(words), len(self.drifts))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), in one pass.

    Words below zero only shift the running sum, so the pass goes from one positive word to the
    next. Each candidate holds the sums before and after it and the place of the last earlier
    one that began lower; a new one is joined with its own for as long as that one ended lower
    too. The search goes from place to place, past all that can't be lower.
    """
    (gains,) = np.nonzero(scores > 0)
    if not len(gains):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[tuple] = []  # first, end, sum before, sum after, place
    for at in gains.tolist():
        first, low, high = at, float(sums[at]), float(sums[at + 1])
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                kept.append((first, at + 1, low, high, j))
                break
            first, _, low, _, before = kept[j]
            del kept[j:]
            j = before
    return [(a, b, y - x) for a, b, x, y, _ in kept]


def rate_of(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive solution of E[exp(rate * score)] = 1 over clean words."""
    share = counts / counts.sum()
    low, high = 1e-6, 1.0
    mean = lambda r: float((share * np.exp(r * values)).sum())
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 1 else (low, mid)
    return high


@dataclass
class Model:
    weights: np.ndarray
    drift: float
    rate: float
    slope: float
    base: float

    def words(self) -> Words:
        return Words(self.weights[:, None], [self.drift])

    def passages(self, scores: np.ndarray) -> list[tuple[int, int, float]]:
        """Significant passages: first word, end, strength above chance."""
        return significant(scores[:, 0], self.rate)


def significant(scores: np.ndarray, rate: float) -> list[tuple[int, int, float]]:
    chance = log1p(K * len(scores))
    found = [(a, b, rate * s - chance) for a, b, s in segments(scores)]
    return [f for f in found if f[2] > 0]


DRIFTS = [drift for _, drift in CHOICES]
LEVELS = 1024  # of word scores in hundredths


def clean_levels(fit: DataFrame, weights) -> np.ndarray:
    """[choice, level]: how often the clean documents' words have a score, in hundredths."""

    def work(batches):
        words = [Words(w, DRIFTS) for w in weights.value]
        counts = np.zeros((len(CHOICES), LEVELS), np.int64)
        for batch in batches:
            for text, part in zip(*(c.to_pylist() for c in batch.columns)):
                level = np.rint((words[part].scores(text) + DRIFTS) * 100).astype(int)
                for c in range(len(CHOICES)):
                    counts[c] += np.bincount(level[:, c], minlength=LEVELS)
        choice, at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(choice), pa.array(at), pa.array(counts[choice, at])], ["choice", "at", "n"]
        )

    rows = fit.filter("toxic = 0").select("text", "part").mapInArrow(work, "choice long, at long, n long")
    out = np.zeros((len(CHOICES), LEVELS))
    for r in rows.groupBy("choice", "at").agg(F.sum("n").alias("n")).collect():  # bounded by the levels
        out[r["choice"], r["at"]] = r["n"]
    return out


def strengths(fit: DataFrame, weights, rates: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """[row, choice] strengths of the training rows, and their labels."""

    def work(batches):
        words = [Words(w, DRIFTS) for w in weights.value]
        for batch in batches:
            rows = []
            for text, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                own = words[part].scores(text)
                rows.append([sum(s for *_, s in significant(own[:, c], r)) for c, r in enumerate(rates)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "strength"]
            )

    rows = fit.select("text", "toxic", "part").mapInArrow(work, "toxic int, strength array<double>")
    found = rows.toPandas()  # at most as many rows as the classifier is fitted on
    x = np.stack(found["strength"].to_numpy()) if len(found) else np.zeros((0, len(rates)))
    return x, found["toxic"].to_numpy(float)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base by Newton's method, with a weak pull to zero."""
    m, w = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        grad = m.T @ (y - p) - 0.01 * w
        step = np.linalg.solve((m * (p * (1 - p))[:, None]).T @ m + 0.01 * np.eye(2), grad)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def fitted(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """A model from the labels. Without labels of both kinds every text scores below one half."""
    spark = docs.sparkSession
    fit = fit_rows(docs, labels, rows)
    counts = feature_counts(fit)
    whole = counts.sum(axis=0)
    others = [whole - own for own in counts]
    weights = np.array([
        np.stack([log_odds(*other, errors) for errors, _ in CHOICES], axis=1) for other in others
    ], np.float32)
    sent = spark.sparkContext.broadcast(weights)
    levels = clean_levels(fit, sent)
    rates = []
    for n, drift in zip(levels, DRIFTS):
        values = np.append(np.arange(LEVELS) / 100, TOP) - drift
        rates.append(rate_of(values, np.append(n + (np.arange(LEVELS) == 0), 0.5)))
    x, y = strengths(fit, sent, rates)
    best = None
    if 0 < y.sum() < len(y):
        for c, (errors, drift) in enumerate(CHOICES):
            z = np.log1p(x[:, c])
            slope, base = logistic(z, y)
            loss = np.logaddexp(0, np.where(y > 0, -1, 1) * (base + slope * z)).mean()
            if best is None or loss < best[0]:
                best = loss, Model(log_odds(*whole, errors), drift, rates[c], slope, base)
    return best[1] if best else Model(np.zeros(BINS), DRIFTS[0], 1.0, 0.0, -log(len(y) + 2))


def passages_of(docs: DataFrame, model: Model, keep: list[str] = ()) -> DataFrame:
    """``doc_id, strength, passages`` of every row, and ``row``, the columns to ``keep``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[docs[c] for c in keep] or [F.lit(None).cast("int").alias("none")]).alias("row")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row
    )
    span = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("strength", pa.float64())])

    def work(batches):
        model = sent.value
        words = model.words()
        for batch in batches:
            strength, spans = [], []
            for text in batch.column(1).to_pylist():
                own = model.passages(words.scores(text))
                strength.append(float(sum(s for *_, s in own)))
                spans.append([{"first": a, "last": b - 1, "strength": s} for a, b, s in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(strength, pa.float64()), pa.array(spans, pa.list_(span)), batch.column(2)],
                ["doc_id", "strength", "passages", "row"],
            )

    schema = T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("strength", T.DoubleType()),
        *T.StructType.fromDDL("passages array<struct<first: long, last: long, strength: double>>").fields,
        rows.schema["row"],
    ])
    return rows.mapInArrow(work, schema)


def scored(docs: DataFrame, model: Model, keep: list[str] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` of every row, and with ``keep`` those
    columns in ``row``.

    Only the text counts. Null and empty texts have no passage and score as low as any text.
    Null ids are not held out; repeated rows stay repeated; an empty table gives an empty
    result. Passages count words (runs of letters) from 0.
    """
    z = F.lit(model.base) + F.lit(model.slope) * F.log1p("strength")
    score = 1 / (1 + F.exp(-z))
    rows = passages_of(docs, model, keep).withColumn("score", score)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    answer = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, "passages", "row")
    return answer if keep else answer.drop("row")
