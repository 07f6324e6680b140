"""Benchmark passages in training texts, by a positional inverted index, with DataFrame functions
only.

The postings (text, position, term) of every training word that some test item uses are stored
once, as a table in the shared folder. A window of ten words of an item is looked up by its
rarest terms. Taking a term's offset in the item from its positions in a text gives the places
at which the item would have to begin, its shift; where the offset-adjusted lists of the two
rarest terms have a shift in common, the lists of the other words are intersected too. Words that
agree without a gap over a window are an exact phrase match. Where the shifts of the two rarest
terms are a few words apart at most, and most other words lie within so many of their place beside
the rarest one, it is a proximity match.

A text is known by 128 bits of its own hash: copies have the same postings, which aggregation
joins before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.llm.common import BROADCAST_ROWS, SALTS, checkpoint
from tarnworks.session import fresh_folder

# What lies between words, after A-Z has become a-z.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
ANY_CASE = BETWEEN.replace("\\x3A-\\x60", "\\x3A-\\x40\\x5B-\\x60")  # the same in a text as given
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
# In a proximity match words may be off their place by so many, and tenths of them have to be there.
SLACK, TENTHS = 4, 8

TEXT = ["k1", "k2"]


def split_text(text: Column) -> Column:
    """The words of a text in order, an empty one before and after them where it begins or ends
    with something else. (To split is many times as fast as to extract.)"""
    return F.split(F.translate(text, UPPER, LOWER), BETWEEN)


def count_of(parts: Column) -> Column:
    """Number of words in a split text."""
    first, last = (F.element_at(parts, k) == "" for k in (1, -1))
    ends = first.cast("long") + F.when(F.size(parts) > 1, last.cast("long")).otherwise(0)
    return F.size(parts).cast("long") - ends


def with_key(docs: DataFrame) -> DataFrame:
    """``doc_id, text, k1, k2``: two hashes tell a text; null is the empty text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})


def matched(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a checkpointed lookup, whatever the share of one key: a small lookup is
    broadcast, a large one repeated for each salt. No key is null."""
    if lookup.count() <= BROADCAST_ROWS:
        return facts.join(F.broadcast(lookup), keys, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(lookup.withColumn("_salt", salts), [*keys, "_salt"], how).drop("_salt")


class Items:
    """Test items by their words. ``owners``: ``unit, item_id`` (as text; null is empty);
    ``places``: ``unit, size, q, word, term``, a row for each word of a different word list;
    ``terms``: ``word, term``."""

    def __init__(self, bench: DataFrame, window: int):
        rows = bench.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
            F.array_remove(split_text(F.coalesce(F.col("text").cast("string"), F.lit(""))), "").alias("words"),
        ).filter(F.size("words") > 0).withColumn("own", F.sha2(F.concat_ws(" ", "words"), 256))
        units = checkpoint(rows.groupBy("own").agg(F.first("words").alias("words")).withColumn(
            "unit", F.monotonically_increasing_id()
        ))
        keys = checkpoint(units.select("own", "unit"))
        self.owners = checkpoint(matched(rows.select("own", "item_id"), keys, ["own"]).select("unit", "item_id").distinct())
        each = units.select("unit", F.size("words").alias("size"), F.posexplode("words").alias("q", "word"))
        self.terms = checkpoint(each.groupBy("word").agg(F.count(F.lit(1)).alias("uses")).select(
            "word", F.monotonically_increasing_id().alias("term")
        ))
        self.places = checkpoint(matched(each, self.terms, ["word"]))
        self.window = window


def postings(docs: DataFrame, items: Items) -> DataFrame:
    """``k1, k2, pos, term`` of all training words that items use, stored as a table."""
    spark = docs.sparkSession
    parts = with_key(docs).select(*TEXT, split_text(F.col("text")).alias("parts"))
    lead = F.when(F.element_at("parts", 1) == "", 1).otherwise(0).alias("lead")
    each = parts.select(*TEXT, lead, F.posexplode("parts").alias("place", "word"))
    path = fresh_folder(spark, "postings")
    met = matched(each, items.terms, ["word"])
    met.select(*TEXT, (F.col("place") - F.col("lead")).alias("pos"), "term").write.parquet(path)
    return spark.read.parquet(path)


def windows(items: Items, index: DataFrame) -> DataFrame:
    """``unit, s, wide, whole, q1, term1, q2, term2``: for the window from word s of an item its two
    rarest terms in the training texts (the second is null where there is one only). ``whole``:
    the texts have all its terms."""
    counts = checkpoint(index.groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    wide = F.least(F.lit(items.window), F.col("size"))
    starts = F.sequence(F.greatest(F.lit(0), F.col("q") - wide + 1), F.least(F.col("q"), F.col("size") - wide))
    met = matched(items.places, counts, ["term"], "left")
    each = met.select("unit", wide.alias("wide"), F.explode(starts).alias("s"), F.struct(
        F.coalesce("n", F.lit(0)).alias("n"), "q", "term"
    ).alias("w"))
    # A window has few words.
    grouped = each.groupBy("unit", "s", "wide").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    known = grouped.withColumn("known", F.filter("ws", lambda w: w["n"] > 0)).filter(F.size("known") > 0)
    one, two = F.get("known", F.lit(0)), F.get("known", F.lit(1))
    return checkpoint(known.select(
        "unit", "s", "wide", (F.size("known") == F.size("ws")).alias("whole"),
        one["q"].alias("q1"), one["term"].alias("term1"), two["q"].alias("q2"), two["term"].alias("term2"),
    ))


def shifts(index: DataFrame, asked: DataFrame, turn: int) -> DataFrame:
    """``k1, k2, unit, q, shift``: offset-adjusted postings of the windows' rarest (1) or second
    rarest (2) terms."""
    q, term = F.col(f"q{turn}").alias("q"), F.col(f"term{turn}").alias("term")
    places = checkpoint(asked.select("unit", q, term).filter("term is not null").distinct())
    met = matched(index, places, ["term"])
    return met.select(*TEXT, "unit", "q", (F.col("pos") - F.col("q")).alias("shift"))


def candidates(index: DataFrame, asked: DataFrame, slack: int) -> DataFrame:
    """``k1, k2, unit, q1, q2, shift, exact``: shifts of the rarest terms beside which the second
    rarest lies at most ``slack`` words off its place, or just there (``exact``)."""
    pairs = checkpoint(asked.select("unit", "q1", "q2").distinct())
    bin_of = F.floor(F.col("shift") / (slack + 1))
    first = matched(shifts(index, asked, 1).withColumnRenamed("q", "q1"), pairs, ["unit", "q1"])
    alone = first.filter("q2 is null").select(*TEXT, "unit", "q1", "q2", "shift", F.lit(True).alias("exact"))
    bins = F.explode(F.array(bin_of - 1, bin_of, bin_of + 1)).alias("bin")
    left = first.filter("q2 is not null").select(*TEXT, "unit", "q1", "q2", "shift", bins)
    right = shifts(index, asked, 2).withColumnRenamed("q", "q2").select(
        *TEXT, "unit", "q2", F.col("shift").alias("other"), bin_of.alias("bin")
    )
    off = F.abs(F.col("shift") - F.col("other"))
    both = left.join(right, [*TEXT, "unit", "q2", "bin"]).filter(off <= slack)
    both = both.select(*TEXT, "unit", "q1", "q2", "shift", (off == 0).alias("exact")).unionByName(alone)
    return checkpoint(both.groupBy(*TEXT, "unit", "q1", "q2", "shift").agg(F.max("exact").alias("exact")))


def found_windows(asked: DataFrame, pairs: DataFrame) -> DataFrame:
    """The windows that candidates stand for: ``k1, k2, unit, shift, s, wide``."""
    of_pair = asked.select("unit", F.coalesce("q2", F.lit(-1)).alias("q2"), "q1", "s", "wide")
    keyed = pairs.withColumn("q2", F.coalesce("q2", F.lit(-1)))
    met = matched(keyed, checkpoint(of_pair), ["unit", "q1", "q2"])
    return met.select(*TEXT, "unit", "shift", "s", "wide").distinct()


def phrases(lists: DataFrame, items: Items, found: DataFrame) -> DataFrame:
    """``k1, k2, unit, item_start, start, end``: longest stretches, of a window at least, in which an
    item and a text agree word by word. Positions count words from 0, ends are included."""
    at = [*TEXT, "unit", "shift"]
    reach = F.explode(F.sequence(F.col("s"), F.col("s") + F.col("wide") - 1)).alias("q")
    wanted = matched(found.select(*at, reach).distinct(), items.places, ["unit", "q"])
    wanted = wanted.select(*at, "q", "size", (F.col("shift") + F.col("q")).alias("pos"), "term")
    met = wanted.join(lists, [*TEXT, "pos", "term"])
    w = Window.partitionBy(*at).orderBy("q")
    islands = met.withColumn("island", F.col("q") - F.row_number().over(w)).groupBy(*at, "island").agg(
        F.min("q").alias("first"), F.max("q").alias("last"), F.first("size").alias("size")
    )
    long = F.col("last") - F.col("first") + 1 >= F.least(F.lit(items.window), F.col("size"))
    return islands.filter(long).select(
        *TEXT, "unit", F.col("first").alias("item_start"),
        (F.col("first") + F.col("shift")).alias("start"), (F.col("last") + F.col("shift")).alias("end"),
    )


def near_windows(lists: DataFrame, items: Items, found: DataFrame, slack: int, tenths: int) -> DataFrame:
    """``k1, k2, unit, s, start, n``: windows of which at least ``tenths`` of ten words (``n``) lie at
    most ``slack`` words off their place; ``start`` is where the window begins."""
    at = [*TEXT, "unit", "shift", "s", "wide"]
    bin_of = F.floor(F.col("pos") / (slack + 1))
    reach = F.explode(F.sequence(F.col("s"), F.col("s") + F.col("wide") - 1)).alias("q")
    wanted = matched(found.select(*at, reach), items.places.select("unit", "q", "term"), ["unit", "q"])
    wanted = wanted.withColumn("pos", F.col("shift") + F.col("q"))
    wanted = wanted.select(*at, "q", "term", F.col("pos").alias("place"), F.explode(F.array(bin_of - 1, bin_of, bin_of + 1)).alias("bin"))
    met = wanted.join(lists.withColumn("bin", bin_of), [*TEXT, "term", "bin"])
    there = met.filter(F.abs(F.col("pos") - F.col("place")) <= slack).select(*at, "q").distinct()
    counted = there.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * 10 >= F.col("wide") * tenths)
    return counted.select(*TEXT, "unit", "s", (F.col("shift") + F.col("s")).alias("start"), "n")


def matches(
    docs: DataFrame, bench: DataFrame, window: int = WINDOW, slack: int = SLACK, tenths: int = TENTHS
) -> tuple[DataFrame, DataFrame, Items]:
    """Exact phrase matches, proximity matches of other windows (as in ``phrases``, ``near_windows``)
    and the items. Texts are named by ``with_key``."""
    items = Items(bench, window)
    index = postings(docs, items)
    asked = windows(items, index)
    pairs = candidates(index, asked, slack)
    exact_found = found_windows(asked.filter("whole"), pairs.filter("exact"))
    # The lists of all words, of the texts in question.
    texts = checkpoint(pairs.select(*TEXT).distinct())
    lists = checkpoint(matched(index, texts, TEXT).distinct())
    exact = checkpoint(phrases(lists, items, exact_found))
    # Windows inside a phrase are done.
    last = F.col("item_start") + F.col("end") - F.col("start")
    done = exact_found.select(*TEXT, "unit", "shift", "s", "wide").join(exact.select(
        *TEXT, "unit", (F.col("start") - F.col("item_start")).alias("shift"), "item_start", last.alias("last")
    ), [*TEXT, "unit", "shift"]).filter((F.col("s") >= F.col("item_start")) & (F.col("s") + F.col("wide") - 1 <= F.col("last")))
    rest = found_windows(asked, pairs).join(done.select(*TEXT, "unit", "shift", "s"), [*TEXT, "unit", "shift", "s"], "left_anti")
    return exact, checkpoint(near_windows(lists, items, checkpoint(rest), slack, tenths)), items


def contaminated(
    docs: DataFrame, bench: DataFrame, window: int = WINDOW, slack: int = SLACK, tenths: int = TENTHS
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items`` of every row.

    A window is ``window`` consecutive words of an item, or all of them where it has fewer, but
    some. ``n_hit``: words of the document inside an occurrence of a window; ``n_items``: items
    with such windows, ``items_sha256`` of their ids, sorted as strings, joined by commas.
    ``n_near_items``: items with a proximity match, exact ones included.

    Null and empty texts have no words and are clean. Rows may repeat and share ids: each has
    the result of its text. Items may repeat; an item id counts once, a null one as the empty
    string. Without items, or without words in them, all documents are clean; without documents
    the result is empty. Other columns are not read.
    """
    exact, near, items = matches(docs, bench, window, slack, tenths)
    spots = exact.select(*TEXT, F.explode(F.sequence("start", "end")).alias("pos")).distinct()
    hits = spots.groupBy(*TEXT).agg(F.count(F.lit(1)).alias("n_hit"))
    owned = matched(exact.select(*TEXT, "unit").distinct(), items.owners, ["unit"]).select(*TEXT, "item_id").distinct()
    found = owned.groupBy(*TEXT).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("item_id"))), 256).alias("items_sha256"),
    )
    both = near.select(*TEXT, "unit").unionByName(exact.select(*TEXT, "unit")).distinct()
    close = matched(both, items.owners, ["unit"]).select(*TEXT, "item_id").distinct()
    close = close.groupBy(*TEXT).agg(F.count(F.lit(1)).alias("n_near_items"))
    results = checkpoint(close.join(hits.join(found, TEXT), TEXT, "full"))
    rows = with_key(docs).select("doc_id", *TEXT, F.split("text", ANY_CASE).alias("parts"))
    rows = rows.select("doc_id", *TEXT, count_of(F.col("parts")).alias("n_words"))
    none = F.lit(0).cast("long")
    return matched(rows, results, TEXT, "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", none) > 0).alias("contaminated"),
        F.coalesce("n_near_items", none).alias("n_near_items"),
    )
