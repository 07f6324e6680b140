import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnworks.operators import correlation as co
from tarnworks.operators import features as ft
from tarnworks.operators import games as gm
from tarnworks.operators import queueing as q
from tarnworks.operators import ranking as rk
from tarnworks.operators import rates as r
from tarnworks.operators import series as s
from tarnworks.plans import rates as plans


def _moving_average(a, n, last=False):
    out = []
    for i in range(max(len(a) - n + (1 if last else 0), 0)):
        window = [v for v in a[i : i + n] if v is not None]
        out.append(sum(window) / len(window) if window else None)
    return out


@pytest.mark.parametrize("last", [False, True])
def test_forward_mean_equals_the_loop(spark, last):
    rng = random.Random(2)
    series = {k: [rng.choice([None, 0.0, 0.5, 1.0]) for _ in range(n)] for k, n in [("a", 12), ("b", 5), ("c", 6), ("d", 2)]}
    rows = [(k, i, v) for k, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, idx long, v double")
    lengths = spark.createDataFrame([(k, len(v)) for k, v in series.items()], "k string, n long")
    got = {(x.k, x.idx): x["mean"] for x in r.forward_mean(df, ["k"], "v", lengths, ["k"], 5, last).collect()}
    wanted = {
        (k, i): m for k, v in series.items() for i, m in enumerate(_moving_average(v, 5, last)) if m is not None
    }
    assert got == pytest.approx(wanted)


def test_user_trend_repeats_clicked_links(spark):
    emails = [(1, e, a, "2024_01") for e in range(9) for a in (1, 2, 11)]
    clicks = [(1, 1, "2024_01", 200), (1, 1, "2024_01", 0), (1, 11, "2024_02", 200)]
    articles = spark.createDataFrame([(1, 5, 1), (2, 5, 2), (11, 6, 1)], "article_id int, author_id int, topic_id int")
    e = spark.createDataFrame(emails, "user_id int, email_id int, article_id int, week_num string")
    c = spark.createDataFrame(clicks, "user_id int, article_id int, week_num string, status int")
    rates = {(x.email_id, x.category): (x.m_send, x.m_click) for x in r.email_rates(e, c, articles).collect()}
    assert rates[(0, 1)] == (3, 2) and rates[(0, 2)] == (1, 0)
    once = {(x.email_id, x.category): (x.m_send, x.m_click) for x in r.email_rates(e, c, articles, dedupe_clicks=True).collect()}
    assert once[(0, 1)] == (2, 2)
    trend = {x.category: x.slope for x in r.user_trend(e, c, articles, hot_rows=3).collect()}
    assert trend == {1: pytest.approx(0.0), 2: pytest.approx(0.0)}


def test_click_reports_read_the_events_once(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    reads, table = [], plans.table
    monkeypatch.setattr(plans, "table", lambda s, d, name: reads.append(name) or table(s, d, name))
    for query in ("weekly_rate", "weekly_rate_by_type", "rate_trend", "most_rising", "email_rates", "user_trend", "user_trend_named"):
        reads.clear()
        plan = getattr(plans, query)(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert reads == ["events"] and "FileScan parquet" not in plan, query


def test_weekly_rate_and_trend(spark):
    articles = spark.createDataFrame([(1, 9, 1), (2, 9, 2)], "article_id int, author_id int, topic_id int")
    topics = spark.createDataFrame([(1, "tax"), (2, "audit")], "topic_id int, name string")
    weeks = {"2024_01": (10, 1), "2024_02": (20, 4), "2024_03": (10, 3), "2024_04": (9, 9)}
    sent = [(u, u, 1, w) for w, (n, _) in weeks.items() for u in range(n)] + [(u, u, 2, "2024_01") for u in range(12)]
    hit = [(u, 1, w, 200) for w, (_, n) in weeks.items() for u in range(n)]
    rates = r.weekly_rate(
        spark.createDataFrame(sent, "user_id int, email_id int, article_id int, week_num string"),
        spark.createDataFrame(hit, "user_id int, article_id int, week_num string, status int"),
        articles, topics,
    )
    got = {(x.category, x.week): x.rate for x in rates.collect()}
    assert got == pytest.approx(
        {("tax", "2024_01"): 0.1, ("tax", "2024_02"): 0.2, ("tax", "2024_03"): 0.3, ("audit", "2024_01"): 0.0}
    )
    trend = {x.category: x for x in r.rate_trend(rates).collect()}
    assert trend["tax"].change_rate == pytest.approx(0.1) and trend["tax"].change_pct == pytest.approx(50)
    assert trend["audit"].change_rate == 0.0 and trend["audit"].change_pct is None
    assert [x.category for x in r.notable_changes(r.rate_trend(rates)).collect()] == ["tax"]


def test_fill_days_keeps_double_dates(spark):
    runs = spark.createDataFrame(
        [("2014-08-02", 1.0, None), ("2014-08-04", 2.0, "1:02:03"), ("2014-08-04", 3.0, None)],
        "d string, Miles double, Time string",
    ).select(F.to_date("d").alias("Date"), "Miles", "Time")
    rows = s.prepare_runs(runs).orderBy("Date", "Miles").collect()
    assert [x.Miles for x in rows] == [1.0, 0.0, 2.0, 3.0]
    assert [x.month for x in rows] == ["August", None, "August", "August"]
    assert rows[2].seconds == 3723 and rows[1].seconds is None
    assert rows[0].day_of_week == "Saturday" and rows[0].km == pytest.approx(1.60934)


@pytest.mark.parametrize("hot_rows", [4, 1000])
def test_rolling_std(spark, hot_rows):
    rng = np.random.default_rng(4)
    values = [float(v) for v in rng.integers(0, 50, 30)]
    df = spark.createDataFrame(list(enumerate(values)), "t int, v double")
    got = [x.rolling_std for x in s.rolling_std(df, "v", ["t"], hot_rows=hot_rows).orderBy("t").collect()]
    assert got[:6] == [None] * 6
    assert got[6:] == pytest.approx([np.std(values[i - 6 : i + 1], ddof=1) for i in range(6, 30)])


@pytest.mark.parametrize("hot_rows", [5, 1000])
@pytest.mark.parametrize("cutoff", [None, 90.0])
def test_schedule_equals_the_loop(spark, hot_rows, cutoff):
    rng = random.Random(6)
    jobs, wanted = [], {}
    for server in "xyz":
        now = 0
        end = 0.0
        for i in range(25):
            now += rng.choice([0, 2, 5, 9])
            service = float(rng.randint(1, 9))
            jobs.append((server, i, float(now), service))
            if cutoff is not None and end >= cutoff:
                continue
            begin = max(float(now), end)
            end = begin + service
            wanted[(server, i)] = (begin, end, begin - now)
    df = spark.createDataFrame(jobs, "server string, id int, arrival double, service double")
    got = {(x.server, x.id): (x.start, x.end, x.wait) for x in q.schedule(df, cutoff, hot_rows).collect()}
    assert got == wanted


def _tau(pairs):
    up = x = y = 0
    for i, (s1, l1) in enumerate(pairs):
        for s2, l2 in pairs[i + 1 :]:
            a, b = np.sign(s1 - s2), np.sign(l1 - l2)
            up += a * b
            x += abs(a)
            y += abs(b)
    return up / np.sqrt(x * y) if x * y else None


@pytest.mark.parametrize("hot_rows", [3, 1_000_000])
def test_kendall_tau_without_pairs(spark, hot_rows):
    rng = random.Random(8)
    blocks = {
        "ties": [(rng.randint(0, 4), rng.randint(0, 2)) for _ in range(40)],
        "plain": [(rng.random(), rng.randint(0, 30)) for _ in range(35)],
        "two": [(1.0, 0), (2.0, 1)],
        "flat": [(1.0, 3)] * 4,
        "one": [(1.0, 1)],
    }
    rows = [(b, float(x), y) for b, ps in blocks.items() for x, y in ps]
    df = spark.createDataFrame(rows, "block string, score double, label int")
    got = {x.block: x.tau for x in co.kendall_tau(df, hot_rows).collect()}
    assert got.keys() == blocks.keys()
    for b, ps in blocks.items():
        wanted = _tau(ps)
        assert got[b] is None if wanted is None else got[b] == pytest.approx(wanted, abs=1e-12)


@pytest.mark.parametrize("tile, hot_rows", [(3, 5), (1024, 1_000_000)])
def test_pair_samples_equal_the_loop(spark, tile, hot_rows):
    rng = random.Random(9)
    queries = {qid: [(rng.randint(0, 2), [rng.random(), rng.random()]) for _ in range(n)] for qid, n in [("a", 11), ("b", 4), ("c", 1)]}
    queries["flat"] = [(1, [0.0, 1.0])] * 3
    wanted = {}
    for qid, items in queries.items():
        k = 0
        for i in range(len(items)):
            for j in range(i + 1, len(items)):
                diff = items[i][0] - items[j][0]
                if diff:
                    y = (-1) ** k
                    flip = y * np.sign(diff)
                    x = [flip * (a - b) for a, b in zip(items[i][1], items[j][1])]
                    wanted[(qid, i, j)] = (k, y, diff * flip, x)
                    k += 1
    rows = [(qid, i, rel, fv) for qid, items in queries.items() for i, (rel, fv) in enumerate(items)]
    df = spark.createDataFrame(rows, "qid string, pos long, rel int, fv array<double>")
    got = rk.pair_samples(df, tile, hot_rows).collect()
    assert {(g.qid, g.i, g.j) for g in got} == set(wanted)
    for g in got:
        k, y, diff, x = wanted[(g.qid, g.i, g.j)]
        assert (g.k, g.y, g["diff"]) == (k, y, diff)
        assert g.x == pytest.approx(x)
    assert {x.qid for x in rk.rankable(df).collect()} <= {"a", "b"}


def _blocks(n=60, seed=10):
    rng = np.random.default_rng(seed)
    theta = np.deg2rad(60)
    w = np.array([np.sin(theta), np.cos(theta)])
    rows = []
    for i in range(n):
        rel = i // (n // 3)
        x = rng.normal(size=2) + rel * 4 * w
        if i % 2 == 0:
            x = x - np.array([9, 10])
        rows.append((i % 2, i, int(rel), [float(v) for v in x]))
    return rows, w


def test_pair_model_beats_ridge(spark):
    rows, w = _blocks()
    df = spark.createDataFrame(rows, "qid int, at int, rel int, fv array<double>")
    from tarnworks.operators.scale import positions

    placed = positions(df, ["qid"], ["at"], "pos")
    ridge = rk.fit_ridge(placed)
    x = np.array([r[3] for r in rows])
    y = np.array([r[2] for r in rows], dtype=float)
    xc, yc = x - x.mean(0), y - y.mean()
    exact = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ yc)
    assert ridge == pytest.approx(list(exact / np.linalg.norm(exact)), abs=1e-9)
    svm = rk.fit_pair_svm(rk.pair_samples(placed))
    assert np.dot(svm, w) > 0.95
    tau = {name: {r.qid: r.tau for r in rk.ranking_quality(placed, weights).withColumnRenamed("block", "qid").collect()} for name, weights in [("svm", svm), ("ridge", ridge)]}
    assert all(tau["svm"][b] > tau["ridge"][b] for b in (0, 1))


def test_half_split_is_stratified(spark):
    rows, _ = _blocks()
    df = spark.createDataFrame(rows, "qid int, at int, rel int, fv array<double>")
    halves = rk.half_split(df, "rel", ["at"])
    assert {tuple(r) for r in halves.groupBy("rel", "train").count().collect()} == {
        (rel, t, 10) for rel in range(3) for t in (True, False)
    }


def test_game_points_and_pairs(spark):
    rows = [("A", "B", "1-0"), ("B", "A", "1/2-1/2"), ("A", "C", "*"), ("C", "A", "0-1")]
    games = spark.createDataFrame(rows, "white string, black string, res string").select(
        "white", "black", F.create_map(F.lit("Result"), "res", F.lit("ECO"), F.lit("B97")).alias("tags")
    )
    assert {r.player: r.points for r in gm.player_points(games).collect()} == {"A": 2.5, "B": 0.5, "C": 1.0}
    assert {r.player: r.points for r in gm.player_points(games, True).collect()} == {"A": 2.5, "B": 0.5, "C": 0.0}
    assert {(r.a, r.b): r.games for r in gm.collapse(games).collect()} == {("A", "B"): 2, ("A", "C"): 2}
    assert tuple(gm.player_counts(games).first()) == (4, 3)


def test_nested_features(spark, tmp_path):
    from tarnworks.sources.tables import read_records

    (tmp_path / "plan.json").write_text('[{"plan_id": "p1", "info": {"state": "NY", "fee": 2.5}}, {"plan_id": "p2", "info": {"state": "CA", "fee": 1.0}}]')
    (tmp_path / "drug.json").write_text(
        '[{"name": "d1", "plans": [{"plan_id": "p1", "tier": "x", "cost": 1.0}, {"plan_id": "p1", "tier": "y", "cost": 2.0},'
        ' {"plan_id": "p2", "tier": "y", "cost": 3.0}]}, {"name": "d2", "plans": [{"plan_id": "p2", "tier": "x", "cost": 4.0}]}]'
    )
    plans, drugs = (read_records(spark, str(tmp_path / f)) for f in ("plan.json", "drug.json"))
    fields = ft.leaf_fields(plans.schema)
    assert fields == {"info.fee": "double", "info.state": "string", "plan_id": "string"}
    assert set(ft.leaf_fields(drugs.schema)) == {"name", "plans.cost", "plans.plan_id", "plans.tier"}
    assert set(ft.fields_of(ft.leaf_fields(drugs.schema), "plans")) == {"plans.cost", "plans.plan_id", "plans.tier"}
    index = ft.value_index(ft.distinct_values(plans, ["info.state"]))
    assert {(r.value, r.idx) for r in index.collect()} == {("CA", 0), ("NY", 1)}
    coded = ft.encode(plans, "plan_id", ft.select_fields(fields, ["info.state", "info.fee"]), index)
    assert {tuple(r) for r in coded.collect()} == {
        ("p1", "info.fee", 2.5), ("p1", "info.state", 1.0), ("p2", "info.fee", 1.0), ("p2", "info.state", 0.0)
    }
    hot = ft.one_hot(coded, "plan_id", index, ["info.state"])
    assert ("p1", "info.state=NY", 1.0) in {tuple(r) for r in hot.collect()}
    listed = drugs.select("name", F.posexplode("plans").alias("at", "p")).select("name", "at", "p.*")
    first = ft.first_listing(listed, ["name", "plan_id"], ["at"], ["cost", "tier"])
    assert {tuple(r) for r in first.collect()} == {("d1", "p1", 1.0, "x"), ("d1", "p2", 3.0, "y"), ("d2", "p2", 4.0, "x")}
    wide = {r.plan_id: r for r in ft.widen(first, "plan_id", "name", ["d1", "d2"], ["cost", "tier"]).collect()}
    assert wide["p2"].d1_cost == 3.0 and wide["p2"].d2_tier == "x" and wide["p1"].d2_cost is None
