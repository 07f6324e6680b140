"""URL filters: a blocked Bloom filter in front of an exact hash join.

A URL is judged by the listed entries that cover it. Listed canonical URLs are in a Bloom filter
of one cache line per entry (eight words of 64 bits, one bit set in each); every URL asks it for
each of its possible keys, and only possible hits go on to an exact join with the list, which
takes out the false ones. Keys of a URL are its host and parent hosts together with the
beginnings of its path, of the lengths that the list has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.llm.common import BROADCAST_ROWS, checkpoint

# Verdict, host and path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
LANES = 8
LINE_BITS = 64 * LANES
BITS_PER_KEY = 16
MOST_BITS = 1 << 27  # 16 MB; a longer list has more false hits, which the join takes out
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """``host, path, verdict``, the form of every list."""
    rows = [(host, path, verdict) for verdict, host, path in rules]
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def canonical(listed: DataFrame) -> DataFrame:
    """``key, verdict, path_chars``: one row per entry; blocking wins where both are listed.

    Entries that fit no URL, with a ``/`` in the host or a path that begins otherwise, are left
    out: joined to a key they would look like others.
    """
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    sound = ~host.contains("/") & ((path == "") | path.startswith("/"))
    keyed = listed.filter(sound).select(F.concat(host, path).alias("key"), "verdict", F.length(path).alias("path_chars"))
    return keyed.groupBy("key", "path_chars").agg(F.max("verdict").alias("verdict"))


def bloom(listed: DataFrame, entries: int) -> np.ndarray:
    """The filter's words, made in parts that are joined by OR: at most ``MOST_BITS`` bits."""
    bits = min(MOST_BITS, max(LINE_BITS, BITS_PER_KEY * entries))
    lines = 1 << max(0, (bits // LINE_BITS - 1).bit_length())

    lanes = [f"w{k}" for k in range(LANES)]

    def placed(batches):
        for batch in batches:
            line, words = _spots(batch.column(0).to_pylist(), lines)
            columns = [pa.array(w) for w in words.view(np.int64).T]
            yield pa.RecordBatch.from_arrays([pa.array(line), *columns], ["line", *lanes])

    rows = listed.select("key").mapInArrow(placed, "line long, " + ", ".join(f"{w} long" for w in lanes))
    found = rows.groupBy("line").agg(*[F.bit_or(w).alias(w) for w in lanes]).toPandas()
    table = np.zeros((lines, LANES), np.uint64)
    if len(found):
        words = np.ascontiguousarray(found[lanes].to_numpy(np.int64))
        table[found["line"].to_numpy(np.int64)] = words.view(np.uint64)
    return table


def _spots(keys: list[str], lines: int) -> tuple[np.ndarray, np.ndarray]:
    """Line of each key, and its words with one bit each."""
    digest = xxhash.xxh3_128_intdigest
    both = [digest(k.encode("utf-8", "surrogatepass")) for k in keys]
    low = np.array([b & 0xFFFFFFFFFFFFFFFF for b in both], np.uint64)
    high = np.array([b >> 64 for b in both], np.uint64)
    lane = np.arange(LANES, dtype=np.uint64) * np.uint64(6)
    bit = (high[:, None] >> lane[None, :]) & np.uint64(63)
    return (low & np.uint64(lines - 1)).astype(np.int64), np.uint64(1) << bit


def possible_keys(host: Column, path: Column, chars: list[int], most: int) -> Column:
    """The endings of the host at a label, of at most ``most`` labels, with the beginnings of the path."""
    labels = F.split(F.substring_index(host, ".", -most), "\\.")
    n = F.size(labels)
    ends = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")
    )
    lengths = F.filter(F.array(*map(F.lit, chars)), lambda c: c <= F.length(path))
    starts = F.transform(lengths, lambda c: F.substring(path, F.lit(1), c))
    return F.flatten(F.transform(ends, lambda e: F.transform(starts, lambda p: F.concat(e, p))))


def judged(pages: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``listed``: ``host, path, verdict``. An entry covers its host and all subdomains, where the
    path begins with the entry's; of several, the longest counts, and blocking before allowing
    among equal ones. ``rule``: host and path of that entry, null without one; the verdict is
    then ``default``. Null URLs and those without ``://`` have an empty host and path and no
    rule. Null ids and repeated rows stay as they are; empty tables give no rows; other columns
    aren't read.
    """
    spark = pages.sparkSession
    entries = checkpoint(canonical(listed))
    in_host = F.size(F.split(F.substring_index("key", "/", 1), "\\."))  # a page's host has no /
    n, most = entries.agg(F.count(F.lit(1)), F.coalesce(F.max(in_host), F.lit(1))).first()
    chars = sorted(r[0] for r in entries.select("path_chars").distinct().collect())  # path lengths
    sent = spark.sparkContext.broadcast(bloom(entries, n))

    def possible(batches):
        table = sent.value
        for batch in batches:
            lists, keys = batch.column(1), batch.column(1).flatten()
            line, words = _spots(keys.to_pylist(), len(table))
            (hit,) = np.nonzero(((table[line] & words) == words).all(axis=1))
            owner = pa.compute.list_parent_indices(lists).to_numpy()[hit]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), keys.take(pa.array(hit))], ["url", "key"])

    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"))
    urls = rows.filter(F.col("url").contains("://")).select("url").distinct()
    keys = F.array_distinct(possible_keys(host_of(F.col("url")), path_of(F.col("url")), chars or [0], most))
    asked = urls.select("url", keys.alias("keys")).mapInArrow(possible, "url string, key string")
    small = F.broadcast(entries) if n <= BROADCAST_ROWS else entries
    met = asked.join(small, "key")
    best = met.groupBy("url").agg(
        F.max(F.struct(F.length("key").alias("n"), F.col("verdict"), F.col("key"))).alias("best")
    )
    verdicts = best.select("url", F.col("best.key").alias("rule"), F.col("best.verdict").alias("found"))
    return rows.join(verdicts, "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
        F.coalesce("found", F.lit(default)).alias("verdict"),
    )
