"""Benchmark passages against a plain search of every window."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from fixtures import documents, empty, frame, prose
from pyspark.sql import functions as F

from tarnworks.llm import contamination

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items"]


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(rows, bench, window=10, slack=4, tenths=8):
    texts = {text or "": words(text) for _, text, *_ in rows}
    owners = defaultdict(set)
    for item_id, text in bench:
        if words(text):
            owners[tuple(words(text))].add("" if item_id is None else str(item_id))
    counts = Counter(w for _, text, *_ in rows for w in texts[text or ""])
    out = []
    for doc_id, text, *_ in rows:
        have = texts[text or ""]
        places = defaultdict(set)
        for i, w in enumerate(have):
            places[w].add(i)
        hit, items, close = set(), set(), set()
        for item, ids in owners.items():
            wide = min(window, len(item))
            for s in range(len(item) - wide + 1):
                for at in range(len(have) - wide + 1):
                    if tuple(have[at : at + wide]) == item[s : s + wide]:
                        hit |= set(range(at, at + wide))
                        items |= ids
                known = sorted((counts[item[q]], q) for q in range(s, s + wide) if counts[item[q]])[:2]
                for base in {p - known[0][1] for p in places[item[known[0][1]]]} if known else ():
                    there = [q for q in range(s, s + wide) if any(abs(p - q - base) <= slack for p in places[item[q]])]
                    if len(there) * 10 >= wide * tenths and all(q in there for _, q in known):
                        close |= ids
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((doc_id, len(have), len(hit), len(items), digest, bool(hit), len(close)))
    return sorted(out, key=str)


def bench_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumns(
        {c: F.lit(1) for c in ("unit", "term", "size", "words", "k1")}
    )


def got(df):
    assert df.columns == COLUMNS
    return sorted([tuple(r) for r in df.collect()], key=str)


def planted(rng):
    rows = documents(None)
    items = [(i, prose(rng, rng.choice([3, 9, 10, 11, 30, 60]))) for i in range(12)]
    items += [(20, "THE THE the the the the the the the the the the"), (21, "one"), (22, ""), (23, None)]
    items += [(24, "..."), (5, items[5][1]), (5, "a second text of item five that is put in a document as it is"), (None, "an item without a number that is eleven words long")]
    items += [(31, "Éé çà. Über-all 42 straße!"), (32, items[1][1])]
    for k in range(14, 40):
        part = words(rng.choice(items)[1])
        a = rng.randint(0, max(0, len(part) - 10))
        part = part[a : a + rng.randint(8, 25)]
        if k % 4 == 0 and len(part) > 4:  # near ones
            part.insert(4, "strange")
        text = " ".join([*words(rows[k][1])[:20], *part]) + "; " + (rows[k][1] or "")
        rows[k] = (k, text, "en", "a")
    rows += [(90, items[5][1], "en", "a")] * 2 + [(91, items[5][1], "en", "b"), (92, "the " * 400, "en", "b")]
    rows += [(93, "x one y", "en", "b"), (94, "ÉÉ ÇÀ über all 42 straße", "en", "b"), (95, "Éé ÇÀ Éé çà ÜBER all 42 straße Über all 42 straße", "en", "b")]
    rows += [(96, "an item without a number that is eleven words long", "en", "b")]
    return rows, items


@pytest.mark.parametrize("window, slack, tenths, broadcast", [(10, 4, 8, 100_000), (10, 0, 10, 100_000), (4, 1, 5, 5)])
def test_against_every_window(spark, monkeypatch, window, slack, tenths, broadcast):
    """Also with lookups that are too large to be sent whole."""
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", broadcast)
    rows, items = planted(random.Random(window))
    df = contamination.contaminated(frame(spark, rows), bench_frame(spark, items), window, slack, tenths)
    assert got(df) == plain(rows, items, window, slack, tenths)


def test_phrases_and_near_ones(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = [
        (1, "so alpha beta gamma delta epsilon zeta eta theta iota kappa, lambda ends", "en", "a"),
        (2, "alpha beta gamma delta and epsilon zeta eta theta iota kappa lambda mu", "en", "a"),
        (3, "mu lambda kappa iota theta eta zeta epsilon delta gamma beta alpha", "en", "a"),
    ]
    exact, near, _ = contamination.matches(frame(spark, docs), bench_frame(spark, [(7, item)]), slack=1)
    assert [(r.item_start, r.start, r.end) for r in exact.collect()] == [(0, 1, 11)]
    keys = {r.k1: r.doc_id for r in contamination.with_key(frame(spark, docs)).collect()}
    # The first text lacks the rarest word of the one window that is in no phrase.
    assert {keys[r.k1] for r in near.collect()} == {2}


def test_empty_tables(spark):
    rows, items = planted(random.Random(1))
    assert contamination.contaminated(empty(spark), bench_frame(spark, items)).collect() == []
    for none in ([], [(1, None), (2, " .")]):
        assert got(contamination.contaminated(frame(spark, rows), bench_frame(spark, none))) == plain(rows, none)


def test_no_python_workers(spark):
    rows, items = planted(random.Random(3))
    df = contamination.contaminated(frame(spark, rows), bench_frame(spark, items))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
