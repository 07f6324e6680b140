"""Spelling variants against plain comparisons of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import documents, empty, frame

from tarnworks.llm import spelling


def plain_counts(rows, letters=5, loss=97):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % loss == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                counts[run] += 1
    return counts


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def plain_variants(counts, ratio=2):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows, key=str)


def got(df):
    return sorted([tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()], key=str)


def crowd(rng, n, letters="abé", least=2, most=9):
    return {"".join(rng.choices(letters, k=rng.randint(least, most))): rng.randint(1, 60) for _ in range(n)}


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_all_one_apart(seed):
    """Both schemes together give each near word once, few letters and many repeats included."""
    words = sorted(w.encode("latin-1") for w in crowd(random.Random(seed), 400))
    counts = np.ones(len(words), np.int64)
    found = Counter()
    for first_half in (True, False):
        index = spelling.SuffixIndex([w[::-1] for w in words] if first_half else words)
        for batch in spelling._answers(index, words, counts, first_half, words):
            for row in batch.to_pylist():
                found[row["word"]] += row["n_near"]
    for w in words:
        text = w.decode("latin-1")
        assert found[text] == sum(one_apart(text, v.decode("latin-1")) for v in words), text


@pytest.mark.parametrize("block", [50_000, 40])
def test_variants_against_all_pairs(spark, block):
    """Also with shards that are cut in blocks."""
    counts = crowd(random.Random(9), 300)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling.variants(df, block=block)) == plain_variants(counts)


def test_hot_half(spark):
    """Most words share their first letters, so one shard has to be cut."""
    rng = random.Random(2)
    counts = {"comm" + w: n for w, n in crowd(rng, 250, "abc", 1, 5).items()}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling.variants(df, block=20)) == plain_variants(counts)


def test_repeated_null_and_long_words(spark):
    long = "ab" * 20_000
    rows = [("apple", 3), ("apple", 4), (None, 9), ("apples", 14), (long, 2), (long + "a", 5)]
    df = spark.createDataFrame(rows, "word string, n long").withColumn("shard", spelling.F.lit(1))
    counts = {"apple": 7, "apples": 14, long: 2, long + "a": 5}
    assert got(spelling.variants(df)) == plain_variants(counts)


def test_chains_of_forms(spark):
    counts = {"a" * k: 3 ** (k - 5) for k in range(5, 15)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling.variants(df)) == plain_variants(counts)


def test_counts_of_texts(spark, monkeypatch):
    rows = documents(spark) + [(77, "cafés 你好 cafésx×yz퟿abcde AbCdEF", "fr", "a")] * 3
    monkeypatch.setattr(spelling, "HELD", 50)
    have = {r.word: r.n for r in spelling.word_counts(frame(spark, rows)).collect()}
    assert have == dict(plain_counts(rows))
    assert got(spelling.spelling_groups(frame(spark, rows))) == plain_variants(
        {w: n for w, n in plain_counts(rows).items() if n >= 3}
    )
    assert spelling.spelling_groups(empty(spark)).collect() == []
