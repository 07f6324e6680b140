"""Nulls, gaps, doubled keys and broken lines."""

import pytest
from pyspark.sql import functions as F

from tarnworks.functions.unit_weights import row_rank
from tarnworks.operators import features as ft
from tarnworks.operators import graph as g
from tarnworks.operators import ranking as rk
from tarnworks.session import checkpoint_folder
from tarnworks.sources import graphs, lines


def _lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_links_with_a_null_end_make_no_node(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", None), (None, "a")], "src string, dst string")
    ranked = g.pagerank(edges, 3).collect()
    assert {r.id for r in ranked} == {"a", "b"}
    assert sum(r["rank"] for r in ranked) == pytest.approx(2)


def test_doubled_rows_keep_the_mass(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    begun = g.pagerank(edges, 2).select("id", "rank")
    again = g.pagerank(edges, 2, initial=begun.unionByName(begun)).collect()
    assert len(again) == 3
    topics = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "id string, topic int")
    ranked = g.topic_pagerank(edges, topics, 2, 3).collect()
    assert len(ranked) == 3
    assert sum(r.p[1] for r in ranked) == pytest.approx(3)


def test_pages_of_the_index_are_nodes(spark):
    edges = spark.createDataFrame([("a", "b")], "src string, dst string")
    index = spark.createDataFrame([("a", "Alpha"), ("z", "Zeta")], "id string, name string")
    more = spark.createDataFrame([("m",)], "id string")
    start = g.topic_nodes(edges, index, 3, more)
    assert {(r.id, r.topic, r.degree) for r in start.collect()} == {("a", 6, 1), ("b", 0, 0), ("z", 5, 0), ("m", 0, 0)}
    ranked = g.topic_pagerank(edges, start, 3, 2, extra_nodes=start).collect()
    assert {r.id for r in ranked} == {"a", "b", "m", "z"}
    assert sum(r.p[0] for r in ranked) == pytest.approx(4)


def test_sweep_equals_single_runs(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "d")], "src string, dst string")
    swept = {(r.alpha, r.id): r["rank"] for r in g.damping_sweep(edges, [0.15, 0.5], 4).collect()}
    for a in (0.15, 0.5):
        for r in g.pagerank(edges, 4, a).collect():
            assert swept[a, r.id] == pytest.approx(r["rank"])


def test_pairs_over_gaps(spark):
    rows = [(1, 0, 2, [1.0]), (1, 5, 1, [2.0]), (1, 1024, 0, [3.0])]
    df = spark.createDataFrame(rows, "qid int, pos int, rel int, fv array<double>")
    got = rk.pair_samples(df).collect()
    assert sorted((r.i, r.j, r.k) for r in got) == [(0, 1, 0), (0, 2, 1), (1, 2, 2)]


def test_null_is_a_category(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "a")], "id int, c string")
    index = ft.value_index(ft.distinct_values(df, ["c"]))
    assert {(r.value, r.idx) for r in index.collect()} == {("a", 0), ("x", 1), (None, 2)}
    coded = ft.encode(df, "id", {"c": "string"}, index)
    assert {(r.id, r.value) for r in coded.collect()} == {(1, 1.0), (2, 2.0), (3, 0.0)}


def test_broken_lines_are_left_out(spark):
    links, ids = graphs.parse_adjacency(_lines(spark, "", "a\t{'b': 1}", "alone", "x\tnothing"))
    assert [tuple(r) for r in links.collect()] == [("a", "b", 1.0)]
    assert [r.id for r in ids.collect()] == ["a"]
    ranks = _lines(spark, "", '"a"\t0.5', '"b"\tnone', "c", '"total mass: "\t1')
    kept = graphs.parse_ranks(ranks)
    assert [tuple(r) for r in kept.collect()] == [("a", 0.5)]
    assert tuple(graphs.count_rejects(ranks, kept).first()) == (5, 4)
    click = '[{}] "GET /click?article_id={}&user_id=2 HTTP/1.1" 200 7'
    found = lines.parse_clicks(_lines(
        spark, "", click.format("03/Feb/2012:10:00:00", ""), click.format("someday", "1"),
        click.format("03/Feb/2012:10:00:00", "99999999999"),
    ))
    assert [(r.article_id, r.user_id) for r in found.collect()] == [(None, 2), (None, 2)]
    samples = lines.parse_ranking_samples(_lines(spark, "", "x qid:1 1:2", "2 qid:7 1:0.5 2:bad #c"))
    assert [(r.qid, r.rel, r.fv) for r in samples.collect()] == [("7", 2, [0.5, None])]


def test_tags_stand_before_the_moves(spark):
    game = '[White "w"]\n[Black "b"]\n[Result "?"]\n[Result "1-0"]\n\n1. e4 {[Result "0-1"]\n[ECO "B00"]} e5'
    (got,) = lines.parse_games(_lines(spark, game)).collect()
    assert (got.white, got.black, got.tags) == ("w", "b", {"Result": "1-0"})


def test_unsettled_ranks_are_an_error(spark):
    df = spark.createDataFrame([(["a", "b", "a long one"],)], "units array<string>")
    with pytest.raises(Exception, match="did not settle"):
        df.select(row_rank(F.col("units"), max_passes=1)).collect()


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_folder(Session())
