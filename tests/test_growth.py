"""Work that grew faster than its input: each test looks at what a mended step does."""

import random

import numpy as np
from pyspark.sql import functions as F

from tarnworks.functions import distances
from tarnworks.functions.distances import matrices, pair_blocks
from tarnworks.operators import components as cc
from tarnworks.operators import graph as g
from tarnworks.operators import sentences as sr
from tarnworks.operators import summaries as sm
from tarnworks.operators import units as un
from tarnworks.operators.scale import dealt
from tarnworks.functions.text import first_words
from tarnworks.plans import features, graphs, texts
from tarnworks.sources import tables
from tarnworks.sources.graphs import parse_adjacency, parse_mixed
from tarnworks.sources.lines import parse_games


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_games_are_parsed_once(spark):
    """Each record's head is searched once for names and once for values, whatever is asked of the tags."""
    text = '[White "a"]\n[Date "?"]\n[Black "b"]\n[Date "1"]\n[White "c"]\n\n1. e4 {[Date "2"]}'
    games = parse_games(spark.createDataFrame([(text,), ("[White \"a\"]\n",), (None,), ("",)], "value string"))
    assert [(r.white, r.black, r.tags) for r in games.collect()] == [("c", "b", {"Date": "1"})]
    assert _plan(games.select("white", F.col("tags")["Date"])).count("regexp_extract_all(") == 2


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_distances_of_all_lengths():
    sizes = [0, 1, 3, 8, 60, 63, 64, 65, 127, 128, 129, 200, 300]
    units = ["".join("abcdé漢😀 "[(i * i + k * 7 + i // (k + 1)) % 8] for i in range(n)) for k, n in enumerate(sizes * 2)]
    want = np.array([[_edits(a, b) for b in units] for a in units])
    assert (matrices([units, units[:1], units[3:5]])[0] == want).all()
    assert (pair_blocks([(units[:9], units[5:]), (units[2:3], units[:4])])[0] == want[:9, 5:]).all()
    few = ["ab" * 3000, "ba" * 2500 + "c", ""]  # one whole number each
    assert matrices([few])[0].tolist() == [[0, 1000, 6000], [1000, 0, 5001], [6000, 5001, 0]]


def test_pairs_of_all_lengths_go_side_by_side(monkeypatch):
    """Not in a group for each number of words, nor one by one."""
    letter = random.Random(3)
    units = ["".join(letter.choice("abcde ") for _ in range(n)) for n in [*range(1, 400, 23), 63, 64, 65, 128]]
    left, right = np.triu_indices(len(units), 1)
    want = [distances._whole_number(units[a], units[b]) for a, b in zip(left, right)]
    calls = []
    measure = distances._measure
    monkeypatch.setattr(distances, "_measure", lambda *args: calls.append(len(args[6])) or measure(*args))
    monkeypatch.setattr(distances, "_whole_number", lambda *_: 1 / 0)
    assert distances.pair_distances(units, left, right).tolist() == want
    assert len(calls) <= 2 and sum(calls) == len(want)  # single words and all others


def test_distances_are_measured_in_batches(spark):
    """Not by one expression for each pair; ranks of a document are asked for once."""
    docs = spark.createDataFrame([(1, ["ab", "cd", "abc"])], "doc_id int, units array<string>")
    for df in (un.unit_rank(docs), un.unit_strengths(docs)):
        plan = _executed(df)
        assert "MapInArrow" in plan and "levenshtein" not in plan.lower()
    lexicon = spark.createDataFrame([("Apple", "NN"), ("tree", "NN")], "token string, tag string")
    found = sm.keyphrases(spark.createDataFrame([(1, "An Apple tree")], "doc_id int, text string"), lexicon)
    assert "MapInArrow" not in _executed(found)
    assert [tuple(r) for r in found.collect()] == [(1, "Apple")]


def test_phrases_shuffle_texts_not_words(spark, monkeypatch):
    """Words stay with their text while they are tagged and meet the keywords."""
    plans = []
    for module in (sm, un):
        keep = module.stored
        monkeypatch.setattr(module, "stored", lambda df, keep=keep: plans.append(_executed(df)) or keep(df))
    docs = spark.createDataFrame([(1, "An Apple tree, Apple pie"), (2, "No Pear tree")], "doc_id int, text string")
    lexicon = spark.createDataFrame([(w, "NN") for w in ("Apple", "Pear", "tree")], "token string, tag string")
    found = sorted(tuple(r) for r in sm.keyphrases(docs, lexicon).collect())
    assert found == [(1, "Apple"), (2, "Pear")]
    shuffled = [[x for x in p.splitlines() if "- Exchange hashpartitioning(" in x] for p in (plans[0], plans[-1])]
    assert sum("hashpartitioning(slot" in x for x in shuffled[0]) == 2  # texts and tags
    assert len(shuffled[1]) == 2 and all("hashpartitioning(doc_id" in x for x in shuffled[1])  # texts and keywords
    assert "SortMergeJoin" not in plans[-1] and plans[-1].count("ShuffledHashJoin") == 3


def test_adjacency_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([("a\t{'b': 1}",), ("c\t{}",), ("n\tc\t1\t2",), ("x",), (None,)], "value string")
    links, ids = parse_adjacency(lines)
    assert [tuple(r) for r in links.collect()] == [("a", "b", 1.0)]
    assert sorted(r.id for r in ids.collect()) == ["a", "c"]
    assert _plan(links).count("from_json(") == 1
    links, ids, index = parse_mixed(lines)
    assert ([tuple(r) for r in links.collect()], index.first().id) == ([("a", "b", 1.0)], "c")
    below = [x for x in _plan(links).split("Generate explode")[-1].splitlines() if "Filter" in x]
    assert not below  # the kinds of lines are told above one reading, which both may share


def test_resumed_ranks_keep_the_links_once(spark, tmp_path, monkeypatch):
    """In the layout that both halves use, not beside it too."""
    spark.createDataFrame([(1, 1), (2, 2)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        [(1, 5, 3, "N"), (1, 6, 4, "R"), (2, 5, 4, "N"), (2, 7, 3, "A")],
        "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(graphs, "PASSES", 2)
    whole = graphs.pagerank_trade(spark, str(tmp_path)).collect()
    monkeypatch.setattr(graphs, "checkpoint", lambda _: 1 / 0)
    assert sorted(graphs.pagerank_resumed(spark, str(tmp_path)).collect()) == sorted(whole)


def test_sweep_sends_one_number_along_a_link(spark):
    """Whatever the number of factors; each has the ranks of a run of its own."""
    links = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c"), ("b", "e")]
    edges = spark.createDataFrame(links, "src string, dst string")
    alphas = [1.0, 0.15]
    got = {(r.alpha, r.id): (r["rank"], r.score) for r in g.damping_sweep(edges, alphas, 3).collect()}
    assert len(got) == 10
    for a in alphas:
        for r in g.pagerank(edges, 3, a).collect():
            assert np.allclose(got[a, r.id], (r["rank"], r.score), rtol=1e-13)
    layout = g.lay_out(edges)
    kept = layout.nodes.withColumns({"rank": F.lit(1.0), "p": F.array(F.lit(7.0), F.lit(8.0))})
    moved = g.pagerank_pass(layout, kept, 0.0)
    assert {tuple(r.p) for r in moved.collect()} == {(7.0, 8.0)}
    exchanged = [x for x in _executed(moved).splitlines() if "Exchange" in x]
    assert exchanged and not any("p#" in x for x in exchanged)


def test_first_places_move_no_words(spark, tmp_path):
    """Texts are dealt by document before they are cut into words."""
    rows = [(1, "b a b"), (1, "a c"), (None, "x"), (2, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = texts.first_occurrence(spark, str(tmp_path))
    assert {tuple(r) for r in found.collect()} == {(1, "b", 0), (1, "a", 0), (1, "c", 1), (None, "x", 0)}
    plan = _executed(found)
    plan = plan.split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and "[token" not in plan.split("Exchange")[-1].splitlines()[0]


def test_document_files_are_written_in_place(spark, tmp_path):
    """By the tasks, one file a document, none renamed or listed; ids need not be fit for names."""
    rows = [("a/b", "x\r\ny"), ("é 1", ""), (None, "n"), ("two", "1"), ("two", "2"), ("%null", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    folder = f"file:{tmp_path}/d d"
    manifest = {r.doc_id: (r.path, r.bytes) for r in tables.write_document_files(docs, folder, folders=2).collect()}
    files = [f for f in (tmp_path / "d d" / "files").rglob("*") if f.is_file()]
    assert len(files) == len(manifest) == 5
    assert {f"file:{f}" for f in files} == {p for p, _ in manifest.values()}
    found = tables.read_document_files(spark, folder)
    assert "MapInArrow" in _executed(found) and "binaryFile" not in _executed(found)
    got = {r.doc_id: r.text for r in found.collect()}
    assert got.pop("two") in ("1\n2", "2\n1")
    assert got == {"a/b": "x\r\ny", "é 1": "", None: "n", "%null": ""}
    assert all(manifest[k][1] == len(v.encode()) for k, v in got.items())


def test_passes_but_the_last_leave_out_nodes_without_links(spark, monkeypatch):
    """What these hold is known as one sum; ranks are those of passes over all links."""
    rng = np.random.default_rng(2)
    links = sorted({(f"n{a}", f"n{b}") for a, b in rng.integers(0, [12, 40], (150, 2))} | {("n1", "end")})
    edges = spark.createDataFrame(links, "src string, dst string")
    extra = spark.createDataFrame([("x",), ("n1",), (None,)], "id string")
    moved, one = [], g._sent
    monkeypatch.setattr(g, "_sent", lambda layout, *a: moved.append(layout.links.count()) or one(layout, *a))
    begun = spark.createDataFrame([("n1", 3.0), ("end", 2.0), ("end", 2.0)], "id string, rank double")
    for hot_rows, normalize, initial in ((5, True, None), (1000, False, begun)):
        layout = g.lay_out(edges, extra, hot_rows)
        flat = g.lay_out(edges, extra, hot_rows, inner=False)
        runs = [
            {r.id: r["rank"] for r in g.pagerank(edges, 3, initial=initial, normalize=normalize, layout=x).collect()}
            for x in (layout, flat)
        ]
        assert runs[0].keys() == runs[1].keys() and {"x", "end"} < runs[0].keys()
        assert all(np.isclose(v, runs[1][k], rtol=1e-13) for k, v in runs[0].items())
        assert layout.inner.nodes.agg(F.sum("closing")).first()[0] == sum(b not in {a for a, _ in links} for _, b in links)
    moved.clear()
    g.pagerank(edges, 3)
    inside = sum(b in {a for a, _ in links} for _, b in links)
    assert moved == [inside, inside, len(links)]
    moved.clear()
    topics = spark.createDataFrame([("n1", 1), ("end", 2), ("n30", 2), ("x", 1)], "id string, topic int")
    ranked = g.topic_pagerank(edges, topics, 2, 3, extra_nodes=extra).collect()
    assert moved == [inside, inside, len(links)]
    assert len(ranked) == 40 + 1 + 1 - sum(f"n{i}" not in {x for e in links for x in e} for i in range(40))
    assert all(np.isclose(sum(r.p[i] for r in ranked), len(ranked)) for i in range(3))


def test_joined_features_are_made_once(spark, tmp_path, monkeypatch):
    calls = []
    joined = spark.createDataFrame([(1, "d", "n", 2.0, 3.0, "A"), (2, "d", None, 1.0, 4.0, "R")],
                                   "plan_id long, drug string, nation string, balance double, quantity double, flag string")
    monkeypatch.setattr(features, "feature_join", lambda *a: calls.append(a) or joined)
    found = features.feature_vectors(spark, str(tmp_path))
    assert len(calls) == 1 and "LocalTableScan" not in _executed(found)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "d", 2.0, 3.0, 0, 1.0, 4), (2, "d", 1.0, 4.0, 1, 1.0, 4)]


def test_texts_are_cut_once_for_phrases(spark, tmp_path):
    rows = [(1, "a keyword1 keyword2 b keyword2 keyword3"), (None, "keyword1 keyword2 b keyword2 c"), (2, None), (3, "keyword1")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = texts.keyphrase_merge(spark, str(tmp_path))
    plan = _executed(found).split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == plan.count("Scan") == 1
    assert sorted((r.doc_id or 0, r.phrase) for r in found.collect()) == [
        (0, "keyword1 keyword2"), (0, "keyword2"), (1, "keyword1 keyword2"), (1, "keyword2 keyword3"),
    ]


def test_rounds_of_components_see_few_pairs(spark, monkeypatch):
    """Ties of nodes to their smallest neighbour, and pairs between their trees; not all pairs."""
    rng = np.random.default_rng(4)
    links = {(f"b{i % 3}x{a}", f"b{i % 3}y{b}") for i, (a, b) in enumerate(rng.integers(0, 30, (1500, 2)))}
    links |= {(f"p{i}", f"p{i + 1}") for i in range(20)} | {("l", "l"), (None, "o"), ("q", None)}
    seen, one = [], cc._tie_larger
    monkeypatch.setattr(cc, "_tie_larger", lambda pairs, hot: seen.append(pairs.count()) or one(pairs, hot))
    edges = spark.createDataFrame(sorted(links, key=str), "src string, dst string")
    for hot_rows in (10, 100_000):
        got = {r.id: r.component for r in cc.connected_components(edges, edges.select(F.lit("z").alias("id")), hot_rows).collect()}
        for i in got:
            near = f"b{i[1]}x" if i and i[0] == "b" else "p" if i and i[0] == "p" else i
            assert got[i] == (min(x for x in got if x and x.startswith(near)) if near else None)
        assert len(got) == len({x for e in links for x in e} | {"z"})
    assert max(seen) <= len(got)


def test_first_words_cut_no_more(spark):
    text = F.concat(F.lit(" "), F.repeat(F.lit("a  b\n"), 60))
    row = spark.range(1).select(*[first_words(text, n).alias(f"n{n}") for n in (1, 101, 120, 500)]).first()
    words = ["a", "b"] * 60
    assert [*row] == [" ".join(words[:n]) for n in (1, 101, 120, 500)]
    assert ", 103)" in _plan(spark.range(1).select(F.col("id").cast("string").alias("t")).select(first_words(F.col("t"))))


def test_rows_are_dealt_evenly_by_slot(spark):
    rows = dealt(spark.range(3000), 24, "id").withColumn("part", F.spark_partition_id())
    parts = rows.groupBy("slot").agg(F.count_distinct("part").alias("n"), F.first("part").alias("part")).collect()
    assert {r.n for r in parts} == {1} and {r.part for r in parts} == set(range(24))


def test_tags_move_no_rows_of_documents(spark, monkeypatch):
    """Words of documents are joined where they lie; what moves has no document."""
    plans, one = [], sm.stored
    monkeypatch.setattr(sm, "stored", lambda df: plans.append(_executed(df)) or one(df))
    docs = spark.createDataFrame([(d, ["the", "cat", "the"]) for d in range(9)] + [(None, ["cat"])], "doc_id int, tokens array<string>")
    lexicon = spark.createDataFrame([("cat", "NN"), ("dog", "NN")], "token string, tag string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sm.tag_words(docs, lexicon).select("doc_id", "token", "tag", "pos").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {tuple(r) for r in got} == {(d, "cat", "NN", 1) for d in range(9)} | {(None, "cat", "NN", 0)}
    moved = [x for x in plans[0].splitlines() if "Exchange hashpartitioning(" in x]
    assert moved and not any("doc_id" in x for x in moved), plans[0]


def test_overlap_ranks_of_usual_documents_take_one_job(spark, monkeypatch):
    """No pass over all documents for them; ranks are those of the passes, which others still take."""
    rng = np.random.default_rng(6)
    rows = [(d, i, [f"w{x}" for x in rng.integers(0, 12, n)]) for d in range(5) for i, n in enumerate(rng.integers(1, 7, 9))]
    rows += [(3, 0, ["w1", "w2"]), (None, 0, ["w1"]), (1, 20, []), (1, 21, None), (1, 22, [None])]
    df = spark.createDataFrame(rows, "doc_id int, id int, tokens array<string>")
    monkeypatch.setattr(sr, "TABLE_CELLS", 30)
    passes, one = [], sr._overlap_passes
    monkeypatch.setattr(sr, "_overlap_passes", lambda some, *a: passes.append({r.doc_id for r in some.collect()}) or one(some, *a))
    got = {(r.doc_id, r.id): r["rank"] for r in sr.overlap_rank(df).collect()}
    assert passes == [{3, None}]
    wanted = {(r.doc_id, r.id): r["rank"] for r in one(df, 0.85, 1e-6, 100, 10**6).collect()}
    assert got.keys() == wanted.keys() and all(np.isclose(v, wanted[k], rtol=1e-9) for k, v in got.items())
