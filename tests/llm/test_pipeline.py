"""The stages against plain Python, each on its own input, and the run from end to end."""

import random
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from fixtures import documents, empty, frame, prose, word
from test_counts import plain_targets, size_of
from pyspark.sql import functions as F
from test_pairs import groups_of, plain_fingerprint

from tarnworks.llm import mixture, pieces, toxicity
from tarnworks.sources.tables import table

FOLDER = "/root/testdata/sf0.001"


def test_stages_have_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "mixture", "pieces"]


def plain_classes(texts):
    """Smallest id of each document's group, by the contract's rule on all pairs."""
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    links = [(a, b) for a in texts for b in texts if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    return groups_of(texts, links)


def test_one_of_each_group_stays(spark):
    rows = [r for r in documents(spark) if r[0] is not None]
    got = corpus_pipeline.keep_one(spark, frame(spark, rows), "")
    assert got.columns == frame(spark, rows).columns
    ids = sorted(r.doc_id for r in got.collect())
    assert ids == sorted(set(plain_classes({r[0]: r[1] for r in rows}).values()))
    assert corpus_pipeline.keep_one(spark, empty(spark), "").collect() == []


def test_near_copies_against_all_pairs(spark):
    rng, texts = random.Random(4), []
    for k in range(60):
        words = prose(rng, 400).split()
        texts.append(" ".join(words))
        for i in rng.sample(range(len(words)), 1 + k % 6):
            words[i] = word(rng)
        texts.append(" ".join(words))
    texts += ["", " ", "a b", "A  b", "a b c"]
    want = sorted(set(plain_classes(dict(enumerate(texts))).values()))
    assert 60 < len(want) < 115  # some of the edited texts are near their own, some aren't
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    got = corpus_pipeline.keep_one(spark, frame(spark, rows), "").collect()
    assert sorted(r.doc_id for r in got) == want


def test_columns_with_any_name_stay(spark):
    rows = [r for r in documents(spark, n=40)]
    names = ["_node", "_place", "_key", "_low", "_kept", "row", "h1", "h2", "fp", "component", "position", "take", "a.b"]
    df = frame(spark, rows).drop("row", "fp", "position").withColumns({n: F.lit(f"mine {n}") for n in names})
    for stage in (corpus_pipeline.keep_one, corpus_pipeline.mixed):
        got = stage(spark, df, "")
        assert got.columns == df.columns
        assert all(r[n] == f"mine {n}" for r in got.collect() for n in names)


def test_rows_with_one_id_are_one_document(spark):
    rows = [(1, "a b c d", None, None), (1, "a b c d", None, None), (None, "e f g h", None, None)]
    got = corpus_pipeline.keep_one(spark, frame(spark, rows), "").collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "None"]


def test_rows_without_or_with_one_id_stay_by_their_texts(spark):
    rng = random.Random(6)
    texts = [prose(rng, 40) for _ in range(12)]
    near = "".join(c.upper() if c.isascii() else c for c in texts[2])
    rows = [(None, t, "en", "a") for t in texts[:5]] + [(7, t, "en", "a") for t in texts[5:]]
    rows += [(None, texts[0], "en", "a"), (3, texts[1], "en", "a"), (9, near, "en", "b"), (None, "", "en", "a")]
    got = [corpus_pipeline.keep_one(spark, frame(spark, r), "").collect() for r in (rows, rows[::-1])]
    places = [sorted((str(r.doc_id), r.text) for r in g) for g in got]
    want = [(None, t) for t in (texts[0], *texts[3:5], "")] + [(3, texts[1]), (9, near)]
    want += [(7, t) for t in texts[5:]]
    assert places[0] == places[1] == sorted((str(d), t) for d, t in want)


def test_mixed_places_each_text_without_id(spark):
    rows = [(None, f"a b c{k}", None, "x") for k in range(20)] + [(1, f"d e{k}", None, "x") for k in range(5)]
    got = Counter(r.text for r in corpus_pipeline.mixed(spark, frame(spark, rows), "").collect())
    assert got == {t: 1 for _, t, *_ in rows}


def test_mixed_rows_follow_the_targets(spark):
    rows = [r for r in documents(spark, n=200) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    got = corpus_pipeline.mixed(spark, frame(spark, rows), "")
    assert got.columns == frame(spark, rows).columns
    times = Counter(r.doc_id for r in got.collect())
    sizes, words = {d: size_of(t) for d, t, *_ in rows}, Counter()
    source = {d: s for d, _, _, s in rows}
    for d, n in times.items():
        assert n <= 3
        words[source[d]] += n * sizes[d]
    per_source = Counter()
    for d in sizes:
        per_source[source[d]] += sizes[d]
    for s, target in plain_targets(dict(per_source)).items():
        largest = max(n for d, n in sizes.items() if source[d] == s)
        assert 0 <= words[s] - int(target + 1e-9) <= largest
    assert corpus_pipeline.mixed(spark, empty(spark), "").collect() == []


def test_mixed_places_repeated_and_unnamed_rows(spark):
    rows = [(1, "a b", None, "x"), (1, "a b", None, "x"), (None, "c d", None, "x"), (2, "", None, "y")]
    got = Counter(r.doc_id for r in corpus_pipeline.mixed(spark, frame(spark, rows), "").collect())
    assert got == {1: 2, None: 1}


def test_repeated_rows_are_placed_as_often_as_all_of_them_are_taken(spark):
    """Six words of x and 100 of y, of which 5/7 go to x up to three times its size."""
    rows = [(1, "a b c", None, "x")] * 2 + [(10 + k, "d " * 10, None, "y") for k in range(10)]
    got = Counter(r.doc_id for r in corpus_pipeline.mixed(spark, frame(spark, rows), "").collect())
    taken = Counter()
    for r in mixture.mix(frame(spark, rows)).collect():
        taken[r.doc_id] += len(r.passes)
    assert got == +taken and got[1] == 6


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_run_from_end_to_end(spark):
    docs = table(spark, FOLDER, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.fitted(docs, table(spark, FOLDER, "labels"))
    clean = {r.doc_id for r in toxicity.scored(docs, model).filter("predicted = 0").collect()}
    unique = set(plain_classes({d: texts[d] for d in sorted(clean)}).values())
    v = pieces.Vocabulary.load()
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} <= unique
    assert all(r.round_trip and pieces.decode(r.ids, v) == texts[r.doc_id] for r in got)
    # every source with a target gives words, and all that have room for it
    assert len({r.source for r in got}) == docs.filter(docs.doc_id.isin(list(unique))).select("source").distinct().count()
