"""Readers and writers: tables written in each format, and read again from the files.

Every query writes into a fresh folder under the checkpoint folder. Text inputs hold broken
lines beside the good ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.operators import features as ft
from tarnworks.plans.rates import WEEK, clicks
from tarnworks.plans.texts import HEADS, MERGE, first_words, keyphrase_merge
from tarnworks.session import fresh_folder
from tarnworks.sources import graphs, lines, tables
from tarnworks.sources.tables import table


def _written(rows: DataFrame, name: str) -> str:
    """Folder with the ``value`` column as text lines."""
    folder = fresh_folder(rows.sparkSession, name)
    rows.select("value").write.text(folder)
    return folder


def _with_broken(rows: DataFrame, *texts: str) -> DataFrame:
    """Some broken lines after the good ones of every thousandth key."""
    broken = rows.filter("key % 1000 = 1").select(F.explode(F.array(*map(F.lit, texts))).alias("value"))
    return rows.select("value").unionByName(broken)


def index_file(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"),
        F.concat_ws("\t", "c_name", F.concat(F.lit("c"), "c_custkey"), "c_nationkey", F.lit("0")).alias("value"),
    )
    return graphs.read_index(spark, _written(rows, "index"))


def topic_file(spark, d):
    rows = table(spark, d, "customer").select(
        F.concat_ws("\t", F.concat(F.lit("c"), "c_custkey"), F.col("c_nationkey") % 10 + 1).alias("value")
    )
    return graphs.read_topics(spark, _written(rows, "topics"))


def mixed_file(spark, d):
    """Adjacency and index lines in one file; how many of each, and how many ids."""
    links = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"),
        F.format_string("c%d\t{'s%d': 1, 'n%d': 2}", "c_custkey", F.col("c_custkey") % 7, "c_nationkey").alias("value"),
    )
    names = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.format_string("%s\ts%d\t%d\t0", "s_name", "s_suppkey", "s_nationkey").alias("value"),
    )
    lines_ = _with_broken(links.unionByName(names), "", "   ", "alone", "x\tno list")
    found, ids, index = graphs.read_mixed(spark, _written(lines_, "mixed"))
    kinds = found.select(F.lit("link").alias("kind"), F.concat_ws(">", "src", "dst").alias("what"))
    kinds = kinds.unionByName(ids.select(F.lit("id").alias("kind"), F.col("id").alias("what")))
    return kinds.unionByName(index.select(F.lit("name").alias("kind"), F.col("id").alias("what")))


def rank_file(spark, d):
    """Ranks written as text and read again, with the trailer and broken lines of another file."""
    ranked = table(spark, d, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("id"), F.round("c_acctbal", 2).alias("rank")
    )
    folder = fresh_folder(spark, "ranks")
    graphs.write_ranks(ranked, folder)
    other = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.format_string('"d%d"\t%d', "c_custkey", "c_nationkey").alias("value")
    )
    more = _written(_with_broken(other, "", '"total mass: "\t9.5', '"c"\tnone', "alone"), "ranks")
    return graphs.read_ranks(spark, folder).unionByName(graphs.read_ranks(spark, more))


def rank_rejects(spark, d):
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.format_string('"c%d"\t%d', "c_custkey", "c_nationkey").alias("value")
    )
    found = _with_broken(rows, "", '"c"\tnone', "alone")
    return graphs.count_rejects(found, graphs.parse_ranks(found))


def run_log(spark, d):
    """Days of orders as a running log; broken dates are null."""
    day = F.to_date("o_orderdate")
    days = table(spark, d, "orders").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    late = F.date_format(F.add_months("day", 120), "M/d/yy")  # the format's years are 2000 to 2099
    rows = days.select(F.format_string("%s,%d.5,0:%02d:00", late, "n", F.col("n") % 60).alias("value"))
    bad = days.agg(F.lit("soon,1.5,0:01:00").alias("value"))
    folder = _written(rows.unionByName(bad).repartition(4), "runs")
    log = _headed(spark, folder, "Date,Miles,Time")
    found = tables.read_runs(spark, log, line_sep="\n")
    return found.select(F.date_format("Date", "yyyy-MM-dd").alias("day"), F.col("Miles").alias("miles"), "Time")


def _headed(spark: SparkSession, folder: str, header: str) -> str:
    """The text lines of a folder in files that each begin with a header line."""
    out = fresh_folder(spark, "headed")
    parts = spark.read.text(folder).select(F.split("value", ",").alias("c"))
    names = header.split(",")
    parts.select(*[F.col("c")[i].alias(n) for i, n in enumerate(names)]).write.csv(out, header=True)
    return out


def return_log(spark, d):
    """Nation returns with empty and unreadable cells."""
    nations = table(spark, d, "customer").groupBy("c_nationkey").agg(F.round(F.sum("c_acctbal"), 2).alias("s"))
    folder = fresh_folder(spark, "returns")
    nations.select(
        F.format_string("1/%d/2012 0:00", F.col("c_nationkey") + 1).alias("date"),
        F.when(F.col("c_nationkey") % 3 > 0, F.col("s").cast("string")).alias("S1"),
        F.when(F.col("c_nationkey") % 5 > 0, F.lit("0.25")).otherwise("n/a").alias("S2"),
    ).write.csv(folder, header=True)
    found = tables.read_returns(spark, folder)
    return found.select(F.date_format("date", "yyyy-MM-dd").alias("day"), "S1", "S2")


def record_file(spark, d):
    """Orders as nested records in files of one JSON list each, read again."""
    folder = fresh_folder(spark, "records")
    sale = F.struct("o_orderstatus", "o_totalprice", F.struct("o_custkey").alias("buyer")).alias("sale")
    tables.write_records(table(spark, d, "orders").select("o_orderkey", sale), folder)
    found = tables.read_records(spark, folder)
    return found.select("o_orderkey", "sale.o_orderstatus", "sale.o_totalprice", "sale.buyer.o_custkey")


def document_files(spark, d):
    """All texts in one file each, with a manifest, read as documents."""
    folder = fresh_folder(spark, "documents")
    docs = table(spark, d, "documents").select("doc_id", "text")
    manifest = tables.write_document_files(docs, folder)
    found = tables.read_document_files(spark, folder).withColumn("doc_id", F.col("doc_id").cast("long"))
    return found.join(manifest.select(F.col("doc_id").cast("long").alias("doc_id"), "bytes"), "doc_id")


def document_results(spark, d):
    """First words and keyphrases of every document, written and read again."""
    folder = fresh_folder(spark, "results")
    phrases = keyphrase_merge(spark, d).groupBy("doc_id").agg(  # of one text
        F.concat_ws("\n", F.sort_array(F.collect_list("phrase"))).alias("phrases")
    )
    heads = first_words(spark, d)
    results = heads.join(phrases, "doc_id", "left").withColumn("phrases", F.coalesce("phrases", F.lit("")))
    tables.write_by_document(results, folder)
    return spark.read.parquet(folder)


def click_files(spark, d):
    """Clicks stored by week; the report reads one week's folder only."""
    folder = fresh_folder(spark, "clicks")
    lines.save_clicks(clicks(spark, d), folder)
    weeks = spark.read.parquet(folder).groupBy(F.col("week_num").cast("string").alias("week_num"))
    return weeks.agg(F.count(F.lit(1)).alias("clicks"), F.sum("bsize").alias("bytes"))


def record_fields(spark, d):
    """Fields of one record type with the number of their values."""
    orders = table(spark, d, "orders").select(
        F.struct("o_orderstatus", "o_orderpriority").alias("sale"), F.struct("o_custkey").alias("buyer")
    )
    fields = ft.fields_of(ft.leaf_fields(orders.schema), "sale")
    counts = ft.distinct_values(orders, list(fields)).groupBy("path")
    return counts.agg(F.count("value").alias("values"))


BROKEN = "SELECT count(*) FROM customer WHERE c_custkey % 1000 = 1"

QUERIES = {
    "index_file": (
        index_file,
        "SELECT c_name AS name, 'c' || c_custkey AS id, c_nationkey AS in_degree, 0 AS out_degree FROM customer",
    ),
    "topic_file": (topic_file, "SELECT 'c' || c_custkey AS id, c_nationkey % 10 + 1 AS topic FROM customer"),
    "mixed_file": (
        mixed_file,
        """SELECT 'link' AS kind, 'c' || c_custkey || '>s' || c_custkey % 7 AS what FROM customer
UNION ALL SELECT 'link', 'c' || c_custkey || '>n' || c_nationkey FROM customer
UNION ALL SELECT 'id', 'c' || c_custkey FROM customer UNION ALL SELECT 'name', 's' || s_suppkey FROM supplier""",
    ),
    "rank_file": (
        rank_file,
        """SELECT 'c' || c_custkey AS id, round(c_acctbal, 2) AS rank FROM customer
UNION ALL SELECT 'd' || c_custkey, c_nationkey FROM customer""",
    ),
    "rank_rejects": (
        rank_rejects, f"SELECT count(*) + 3 * ({BROKEN}) AS lines, 3 * ({BROKEN}) AS rejects FROM customer"
    ),
    "run_log": (
        run_log,
        """WITH days AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT strftime(day + INTERVAL 10 YEAR, '%Y-%m-%d') AS day, n + 0.5::DOUBLE AS miles,
  '0:' || lpad(CAST(n % 60 AS VARCHAR), 2, '0') || ':00' AS Time FROM days
UNION ALL SELECT NULL, 1.5, '0:01:00'""",
    ),
    "return_log": (
        return_log,
        """SELECT '2012-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS day,
  CASE WHEN c_nationkey % 3 > 0 THEN round(sum(c_acctbal), 2) END AS S1,
  CASE WHEN c_nationkey % 5 > 0 THEN 0.25::DOUBLE END AS S2 FROM customer GROUP BY c_nationkey""",
    ),
    "record_file": (record_file, "SELECT o_orderkey, o_orderstatus, o_totalprice, o_custkey FROM orders"),
    "document_files": (document_files, "SELECT doc_id, text, strlen(text) AS bytes FROM documents"),
    "document_results": (
        document_results,
        f"""SELECT doc_id, head, coalesce(phrases, '') AS phrases FROM ({HEADS}) LEFT JOIN (
  SELECT doc_id, string_agg(phrase, chr(10) ORDER BY phrase) AS phrases FROM ({MERGE}) GROUP BY doc_id) USING (doc_id)""",
    ),
    "click_files": (
        click_files,
        f"""SELECT {WEEK.format(t="ts")} AS week_num, count(*) AS clicks, sum(length(props))::BIGINT AS bytes
FROM events WHERE event_type = 'click' GROUP BY 1""",
    ),
    "record_fields": (
        record_fields,
        """SELECT 'sale.o_orderstatus' AS path, count(DISTINCT o_orderstatus) AS values FROM orders
UNION ALL SELECT 'sale.o_orderpriority', count(DISTINCT o_orderpriority) FROM orders""",
    ),
}
