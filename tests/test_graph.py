import random

import pytest
from pyspark.sql import functions as F

from tarnworks.operators import components as cc
from tarnworks.operators import graph as g
from tarnworks.operators import topk

# An 11-node graph with one node without out-links, and known ranks.
TOY = {
    "B": "C", "C": "B", "D": "AB", "E": "DBF", "F": "BE", "G": "BE", "H": "BE", "I": "BE",
    "J": "E", "K": "E",
}
AFTER_TWO = {
    "C": 0.2875607312792286, "B": 0.2606908965684848, "D": 0.11164819684396692,
    "E": 0.09941334835911843, "A": 0.03794640621035812, "H": 0.01821844477785124,
    "I": 0.01821844477785124, "G": 0.01821844477785124,
}
AFTER_TEN = {
    0.25: {"B": 0.3230900857829701, "C": 0.27778246239868043, "E": 0.11430069353589788},
    0.75: {"B": 0.15573086573558703, "E": 0.14148423356090453, "C": 0.10893799019402585},
    1.0: {"J": 0.09090909090909091},
}


@pytest.fixture(scope="module")
def toy(spark):
    rows = [(s, d) for s, ds in TOY.items() for d in ds]
    return spark.createDataFrame(rows, "src string, dst string")


def _scores(df):
    return {r.id: r.score for r in df.collect()}


def test_two_passes_give_the_known_ranks(toy):
    got = _scores(g.pagerank(toy, 2))
    assert len(got) == 11
    for node, score in AFTER_TWO.items():
        assert got[node] == pytest.approx(score, abs=1e-9)


def test_hub_sources_do_not_change_ranks(toy):
    plain = _scores(g.pagerank(toy, 3))
    hubs = _scores(g.pagerank(toy, 3, layout=g.lay_out(toy, hot_rows=1)))
    assert hubs == pytest.approx(plain, abs=1e-12)


def test_sweep(toy):
    rows = g.damping_sweep(toy, list(AFTER_TEN), 10).collect()
    for alpha, wanted in AFTER_TEN.items():
        got = {r.id: r.score for r in rows if r.alpha == alpha}
        for node, score in wanted.items():
            assert got[node] == pytest.approx(score, abs=1e-9)


def test_rank_sum_is_kept_every_pass(toy):
    for passes in (1, 2, 3):
        total = g.pagerank(toy, passes).agg(F.sum("rank")).first()[0]
        assert total == pytest.approx(11.0, abs=1e-9)


def test_resume_and_extra_nodes(spark, toy):
    begun = g.pagerank(toy, 2)
    assert _scores(g.pagerank(toy, 3, initial=begun)) == pytest.approx(_scores(g.pagerank(toy, 5)))
    extra = spark.createDataFrame([("Z",), ("A",)], "id string")
    ranked = g.pagerank(toy, 2, extra_nodes=extra)
    assert ranked.count() == 12
    assert ranked.agg(F.sum("rank")).first()[0] == pytest.approx(12.0)


def test_counts(toy):
    assert tuple(g.node_counts(toy).first()) == (11, 1, 17)
    assert [r.id for r in g.dangling_nodes(toy).collect()] == ["A"]


def test_one_shuffle_per_pass(toy):
    """The links stay where they are; only the partly summed inflow moves."""
    from tarnworks.session import pinned_layout

    spark = toy.sparkSession
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        layout = g.lay_out(toy)
        with pinned_layout(spark):
            state = layout.nodes.withColumn("rank", F.lit(1.0))
            plan = g.pagerank_pass(layout, state, 0.15)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 1


def _topic_brute_force(edges, topic, n_topics, passes, alpha=0.15, beta=0.99):
    nodes = sorted({n for e in edges for n in e})
    out = {n: [d for s, d in edges if s == n] for n in nodes}
    size = len(nodes)
    count = {t: sum(topic.get(n, 0) == t for n in nodes) for t in range(n_topics + 1)}
    p = {n: [1.0] * (n_topics + 1) for n in nodes}
    for _ in range(passes):
        new = {n: [0.0] * (n_topics + 1) for n in nodes}
        for i in range(n_topics + 1):
            lost = sum(p[n][i] for n in nodes if not out[n])
            for n in nodes:
                for d in out[n]:
                    new[d][i] += p[n][i] / len(out[n])
            for n in nodes:
                if i == 0:
                    v = 1.0
                elif topic.get(n, 0) == i:
                    v = beta * size / count[i]
                else:
                    v = (1 - beta) * size / (size - count[i])
                new[n][i] = (lost / size + new[n][i]) * (1 - alpha) + alpha * v
        p = new
    return p


def test_topic_ranks_against_brute_force(spark):
    rng = random.Random(3)
    edges = sorted({(f"n{rng.randint(0, 29)}", f"n{rng.randint(0, 39)}") for _ in range(150)})
    topic = {f"n{i}": 1 + i % 3 for i in range(35)}
    ranked = g.topic_pagerank(
        spark.createDataFrame(edges, "src string, dst string"),
        spark.createDataFrame(list(topic.items()), "id string, topic int"),
        3,
        passes=4,
    )
    wanted = _topic_brute_force(edges, topic, 3, 4)
    got = {r.id: r.p for r in ranked.collect()}
    assert got.keys() == wanted.keys()
    for n in wanted:
        assert got[n] == pytest.approx(wanted[n], abs=1e-12)


def test_top_per_vector_ties(spark):
    rows = [(f"i{i}", 0, vec, float(i // 3)) for i in range(12) for vec in (0, 1)]
    vectors = spark.createDataFrame(rows, "id string, topic int, vec int, rank double")
    one = topk.top_per_vector(vectors, 2).filter("vec = 0").orderBy("place").collect()
    assert [(r.place, r.rank, r.id) for r in one] == [(1, 3.0, "i10"), (2, 2.0, "i6")]
    assert topk.top_per_vector_with_ties(vectors, 2).count() == 12


def test_names_drop_unknown_ids(spark, toy):
    index = spark.createDataFrame([("C", "sea"), ("B", "bee"), ("X", "none")], "id string, name string")
    named = topk.name_top(topk.top_ranked(g.pagerank(toy, 2), 5), index).collect()
    assert [r.label for r in named] == ["C - sea", "B - bee"]


def test_topic_start(spark, toy):
    index = spark.createDataFrame([("A", "é"), ("B", "x" * 10)], "id string, name string")
    start = {r.id: r for r in g.topic_nodes(toy, index, 4).collect()}
    assert (start["A"].topic, start["B"].topic, start["C"].topic) == (3, 1, 0)
    assert start["A"].degree == 0 and start["A"].p == [1.0] * 5


def test_components_with_long_paths_and_hubs(spark):
    rng = random.Random(5)
    edges = [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)]
    edges += [("hub", f"leaf{i}") for i in range(40)]
    edges += [(f"r{rng.randint(0, 50)}", f"r{rng.randint(0, 50)}") for _ in range(30)]
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    wanted = {n: find(n) for n in parent}
    df = spark.createDataFrame(edges, "src string, dst string")
    for hot_rows in (10, 1_000_000):
        got = {r.id: r.component for r in cc.connected_components(df, hot_rows=hot_rows).collect()}
        assert got == wanted
