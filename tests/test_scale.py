"""Hot keys take another road to the same rows."""

import random

from pyspark.sql import functions as F

from tarnworks.operators import scale
from tarnworks.operators.scale import join_lookup, positions, running, salted_join
from tarnworks.operators.summaries import tag_words
from tarnworks.session import checkpoint


def _rows(n=400, seed=1):
    rng = random.Random(seed)
    return [("a" if rng.random() < 0.5 else rng.choice("bcd"), i, rng.randint(0, 9)) for i in range(n)]


def test_running_in_slices_equals_one_window(spark):
    df = spark.createDataFrame(_rows(), "k string, t int, v int").repartition(5)
    columns = {"s": ("sum", F.col("v")), "m": ("max", F.col("v") - F.col("t"))}
    plain = running(df, ["k"], ["t"], columns)
    sliced = running(df, ["k"], ["t"], columns, hot_rows=20)
    assert sorted(plain.collect()) == sorted(sliced.collect())


def test_running_without_keys_covers_the_table(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "t int")
    placed = positions(df, [], ["t"], "p", hot_rows=7)
    assert [(r.t, r.p) for r in placed.orderBy("t").collect()] == [(i, i) for i in range(100)]


def test_join_lookup_splits_hot_keys(spark):
    facts = checkpoint(spark.createDataFrame(_rows(), "k string, t int, v int"))
    sizes = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    lookup = checkpoint(sizes.withColumn("name", F.upper("k")))
    cold = join_lookup(facts, lookup, ["k"], "n")
    hot = join_lookup(facts, lookup, ["k"], "n", hot_rows=100)
    assert sorted(cold.collect()) == sorted(hot.select(cold.columns).collect())
    assert cold.count() == 400


def test_200000_hot_keys(spark):
    """Twice as many as may be broadcast; the others are split too."""
    ids = spark.range(600_000)
    facts = checkpoint(ids.select((F.col("id") % 200_000).cast("int").alias("k"), "id"))
    lookup = checkpoint(spark.range(200_010).select("id", (-F.col("id")).alias("name")).select(
        F.col("id").alias("k"), "name", F.lit(3).alias("n")))
    got = join_lookup(facts, lookup, ["k"], "n", hot_rows=2)
    told = got.agg(
        F.count("*").alias("rows"), F.countDistinct("id").alias("ids"), F.sum((F.col("name") != -(F.col("id") % 200_000)).cast("int")).alias("wrong")
    ).first()
    assert tuple(told) == (600_000, 600_000, 0)


def test_salted_join_splits_by_the_keys_count(spark, monkeypatch):
    """The largest share of a key in one group is near ``hot_rows``; the rows are those of the
    plain join, with null keys, keys without entry and clashing values."""
    rows = [("a", i) for i in range(900)] + [("b", i) for i in range(90)] + [("c", 1), (None, 2), ("x", 3)]
    facts = checkpoint(spark.createDataFrame(rows, "k string, t int"))
    lookup = checkpoint(spark.createDataFrame([("a", 900, 1), ("b", 90, 2), ("c", 1, 3), ("d", 0, 4)], "k string, n int, v int"))
    plain = facts.join(lookup.drop("n"), "k")
    for buckets in (1, 65_536):
        monkeypatch.setattr(scale, "SALT_BUCKETS", buckets)
        got = salted_join(facts, lookup, ["k"], "n", hot_rows=100)
        assert sorted(got.select(plain.columns).collect()) == sorted(plain.collect())
    assert salted_join(facts.limit(0), lookup, ["k"], "n", 100).collect() == []
    assert salted_join(facts, lookup.limit(0), ["k"], "n", 100).collect() == []


def test_tags_of_hot_words(spark):
    docs = spark.createDataFrame([(d, ["the", "cat", None, "the", f"w{d}"]) for d in range(40)], "doc_id int, tokens array<string>")
    lexicon = spark.createDataFrame([("the", "DT"), ("cat", "NN"), ("w3", "X"), ("dog", "NN")], "token string, tag string")
    wanted = sorted([(d, "the", "DT", 0) for d in range(40)] + [(d, "cat", "NN", 1) for d in range(40)] + [(3, "w3", "X", 4)])
    for hot_rows in (10, 1000):
        got = tag_words(docs, lexicon, hot_rows).select("doc_id", "token", "tag", "pos").collect()
        assert sorted(map(tuple, got)) == wanted
