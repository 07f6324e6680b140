"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

from __future__ import annotations

import random

SYLLABLES = "an the re ing tion ou ha éa ß ü co".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, words):
    out = []
    for i in range(words):
        out.append(word(rng) + rng.choice(["", "", "", ",", "."]))
        out.append(rng.choice([" ", " ", " ", " ", "\n"]))
    return "".join(out[:-1])


def documents(spark, n=60, seed=3, long_words=3000):
    """Rows with doc_id, text, lang, source and columns named as results are."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((i, prose(rng, rng.randint(0, 60)), "en", rng.choice(["a", "b", "c", "é", None])))
    rows[3] = (3, None, None, None)
    rows[4] = (4, "", "en", "b")
    rows[5] = (5, " \n\t ", "en", "b")
    rows[6] = (6, prose(rng, long_words), "en", "a")
    for k in (7, 8, 9):
        rows[k] = (k, rows[6][1], "en", "a")
    base = rows[6][1].split(" ")
    for k in (10, 11, 12):
        base[len(base) * k // 14] = "changed"
        rows[k] = (k, " ".join(base), "en", "c")
    rows += [rows[0], rows[0], (None, "no id here", "en", "a")]
    return rows


def frame(spark, rows):
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(rows, schema)
    extra = {c: df["doc_id"] for c in ("size", "score", "fp", "value", "part", "position", "words", "row", "ids")}
    return df.withColumns(extra).repartition(3)


def empty(spark):
    return frame(spark, [])
