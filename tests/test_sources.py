import bz2
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarnworks.functions import calendar as cal
from tarnworks.sources import graphs, lines, tables


def _rows(df):
    return {tuple(r) for r in df.collect()}


def test_adjacency_and_mixed_lines(spark, tmp_path):
    path = tmp_path / "graph.txt"
    path.write_text("\"A\"\t{'B': 1, 'C': 2}\nB\t{}\n! (album)\tC\t12\t17\n")
    links, ids, index = graphs.read_mixed(spark, str(path))
    assert _rows(links) == {("A", "B", 1.0), ("A", "C", 2.0)}
    assert _rows(ids) == {("A",), ("B",)}
    assert _rows(index) == {("! (album)", "C", 12, 17)}


def test_index_topics_and_ranks(spark, tmp_path):
    (tmp_path / "index").write_text('say "no"\t7\t1\t0\n')
    assert _rows(graphs.read_index(spark, str(tmp_path / "index"))) == {('say "no"', "7", 1, 0)}
    (tmp_path / "topics").write_text("1\t10\n2\t3\n")
    assert _rows(graphs.read_topics(spark, str(tmp_path / "topics"))) == {("1", 10), ("2", 3)}
    (tmp_path / "ranks").write_text('"A"\t0.5\n"B"\t0.25\n"total mass: "\t0.75\n')
    ranked = graphs.read_ranks(spark, str(tmp_path / "ranks"))
    assert _rows(ranked) == {("A", 0.5), ("B", 0.25)}
    graphs.write_ranks(ranked, str(tmp_path / "out"))
    assert _rows(graphs.read_ranks(spark, str(tmp_path / "out"))) == {("A", 0.5), ("B", 0.25)}
    graphs.save_state(ranked, str(tmp_path / "state"))
    assert graphs.load_state(spark, str(tmp_path / "state")).count() == 2


def test_click_log(spark, tmp_path):
    path = tmp_path / "access.log"
    path.write_text('[01/Jan/2017:05:06:07] "GET /click?article_id=12&user_id=34 HTTP/1.1" 200 99\nnoise\n')
    clicks = lines.read_clicks(spark, str(path))
    row = clicks.first()
    assert clicks.count() == 1
    assert row.click_time == dt.datetime(2017, 1, 1, 5, 6, 7) and row.week_num == "2017_01"
    assert (row.article_id, row.user_id, row.status, row.bsize) == (12, 34, 200, 99)
    lines.save_clicks(clicks, str(tmp_path / "clicks"))
    stored = spark.read.parquet(str(tmp_path / "clicks"))
    assert stored.filter("week_num = '2017_01'").count() == 1


def test_ranking_lines(spark, tmp_path):
    body = " ".join(f"{i}:{i / 100:.6f}" for i in range(1, 47))
    (tmp_path / "train.txt").write_text(f"2 qid:10 {body} #docid = GX0 inc = 0.5 prob = 0.3\n")
    row = lines.read_ranking_samples(spark, str(tmp_path / "train.txt")).first()
    assert (row.qid, row.rel, len(row.fv)) == ("10", 2, 46)
    assert row.fv == pytest.approx([i / 100 for i in range(1, 47)])


def test_numbered_sentences(spark, tmp_path):
    (tmp_path / "s.txt").write_text("3: one, two  three\n4: a: lost\nno number\n")
    rows = {r.id: r.tokens for r in lines.read_numbered_sentences(spark, str(tmp_path / "s.txt")).collect()}
    assert rows == {"3": ["one", "two", "three"], "4": ["a"]}


def test_compressed_games(spark, tmp_path):
    one = '[Event "Final"]\n[White "Stone"]\n[Black "Vale"]\n[Result "1-0"]\n[ECO "B97"]\n\n1. e4 c5\n\n'
    two = '[Event "Final"]\n[White "Vale"]\n[Black "Stone"]\n[Result "*"]\n[ECO "C20"]\n\n1. e4 e5\n'
    (tmp_path / "games.pgn.bz2").write_bytes(bz2.compress((one + two).encode()))
    games = lines.read_games(spark, str(tmp_path / "games.pgn.bz2"))
    rows = {(r.white, r.black): r.tags for r in games.collect()}
    assert rows[("Stone", "Vale")] == {"Event": "Final", "Result": "1-0", "ECO": "B97"}
    assert rows[("Vale", "Stone")]["Result"] == "*"


def test_running_log_with_cr_lines(spark, tmp_path):
    (tmp_path / "runs.csv").write_bytes(b"Date,Miles,Time\r8/2/14,1.7,\r12/31/14,2.5,0:20:30\r")
    rows = tables.read_runs(spark, str(tmp_path / "runs.csv")).collect()
    assert [(r.Date, r.Miles, r.Time) for r in rows] == [
        (dt.date(2014, 8, 2), 1.7, None), (dt.date(2014, 12, 31), 2.5, "0:20:30"),
    ]


def test_returns_documents_values(spark, tmp_path):
    (tmp_path / "r.csv").write_text("date,S1,S2\n1/2/2015 0:00,0.5,\n1/3/2015 0:00,,\n")
    rows = tables.read_returns(spark, str(tmp_path / "r.csv")).collect()
    assert [(r.S1, r.S2) for r in rows] == [(0.5, None), (None, None)]
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "1.txt").write_text("one\ntwo")
    docs = tables.read_documents(spark, str(tmp_path / "docs"))
    assert _rows(docs) == {("1.txt", "one\ntwo")}
    tables.write_by_document(docs.select("doc_id", F.col("text").alias("value")), str(tmp_path / "by"), folders=True)
    assert (tmp_path / "by" / "doc_id=1.txt").is_dir()
    assert tables.from_values(spark, [1, 2]).agg(F.sum("x")).first()[0] == 3.0


def test_week_numbers_follow_strftime(spark):
    days = [dt.date(2012, 1, 1) + dt.timedelta(days=i) for i in range(0, 3000, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", cal.week_label(F.col("d")).alias("w")).collect():
        assert r.w == f"{r.d.year}_{int(r.d.strftime('%W')) + 1:02d}"


def test_records_in_lists_of_bounded_size(spark, tmp_path):
    rows = spark.range(25).select("id", F.struct((F.col("id") * 2).alias("twice")).alias("more")).repartition(2)
    tables.write_records(rows, str(tmp_path / "r"), per_file=10)
    files = [f for f in (tmp_path / "r").iterdir() if f.name.startswith("part")]
    assert 3 <= len(files) <= 4 and all(f.read_text().startswith("[{") for f in files)
    got = tables.read_records(spark, str(tmp_path / "r"))
    assert sorted((r.id, r.more.twice) for r in got.collect()) == [(i, 2 * i) for i in range(25)]


def test_documents_in_one_file_each(spark, tmp_path):
    texts = {1: "one\ntwo\n", 2: "", 30: None, 4: "é" * 3000, 5: "\n"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    manifest = tables.write_document_files(docs, str(tmp_path / "d"), folders=3).collect()
    assert {r.doc_id: r.bytes for r in manifest} == {k: len((t or "").encode()) for k, t in texts.items()}
    got = {r.doc_id: r.text for r in tables.read_document_files(spark, str(tmp_path / "d")).collect()}
    assert got == {k: t or "" for k, t in texts.items()}
