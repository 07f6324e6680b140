"""Graph queries over the trade graph of customers and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.operators import components as cc
from tarnworks.operators import graph as g
from tarnworks.operators import topk
from tarnworks.session import checkpoint, fresh_folder
from tarnworks.sources import graphs as files
from tarnworks.sources.tables import table

PASSES = 10
ALPHA = 0.15
ALPHAS = [1.0, 0.75, 0.5, 0.25, 0.15, 0.0]
TOPICS = 10
BETA = 0.99


def trade_edges(spark: SparkSession, d: str) -> DataFrame:
    """Customer -> supplier for kept lines, supplier -> customer for returned ones, and
    supplier -> part, so that parts have no out-links."""
    lines = table(spark, d, "lineitem")
    orders = table(spark, d, "orders")
    customer, supplier = F.concat(F.lit("c"), "o_custkey"), F.concat(F.lit("s"), "l_suppkey")
    part = F.concat(F.lit("p"), "l_partkey")
    returned = F.col("l_returnflag") == "R"
    trade = F.struct(
        F.when(returned, supplier).otherwise(customer).alias("src"),
        F.when(returned, customer).otherwise(supplier).alias("dst"),
    )
    sold = F.struct(supplier.alias("src"), part.alias("dst"))
    met = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return met.select(F.explode(F.array(trade, sold)).alias("e")).select("e.*").distinct()


def all_traders(spark: SparkSession, d: str) -> DataFrame:
    """Every customer and supplier, with or without trades."""
    return table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id")).unionByName(
        table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"))
    )


def page_index(spark: SparkSession, d: str) -> DataFrame:
    """Names of customers; some of them have no trades and so stand in the index only."""
    return table(spark, d, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("name")
    )


def name_index(spark: SparkSession, d: str) -> DataFrame:
    """Names of customers, suppliers and parts, but for each seventh supplier and fifth part,
    which have none."""
    kinds = [("customer", "c", "c_custkey", "c_name", "true"), ("supplier", "s", "s_suppkey", "s_name", "s_suppkey % 7 > 0"),
             ("part", "p", "p_partkey", "p_name", "p_partkey % 5 > 0")]
    named = [
        table(spark, d, t).filter(known).select(F.concat(F.lit(mark), key).alias("id"), F.col(name).alias("name"))
        for t, mark, key, name, known in kinds
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


def trade_topics(spark: SparkSession, d: str) -> DataFrame:
    """Ten topics of customers by segment, suppliers by nation and parts by size; the rest has
    none. Every customer stands there twice, as files with doubled rows have it."""
    segment = F.col("c_mktsegment")
    customers = table(spark, d, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("id"),
        F.when(segment == "BUILDING", 1).when(segment == "MACHINERY", 2).when(segment == "AUTOMOBILE", 3)
        .when(segment == "HOUSEHOLD", 4).alias("topic"),
    )
    suppliers = table(spark, d, "supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("id"), (F.col("s_nationkey") % 5 + 5).alias("topic")
    )
    parts = table(spark, d, "part").select(
        F.concat(F.lit("p"), "p_partkey").alias("id"), F.when(F.col("p_size") < 20, 10).alias("topic")
    )
    marked = customers.unionByName(customers).unionByName(suppliers).unionByName(parts)
    return marked.filter("topic is not null")


def _rounded(ranked: DataFrame) -> DataFrame:
    return ranked.withColumns({c: F.round(c, 9) for c in ("rank", "score") if c in ranked.columns})


def _settled(ranked: DataFrame) -> DataFrame:
    """Ranks without the last digits, in which sums differ by their order alone."""
    return ranked.withColumns({c: F.round(c, 12) for c in ("rank", "score") if c in ranked.columns})


def _ranks(spark, d) -> DataFrame:
    return g.pagerank(trade_edges(spark, d), PASSES, ALPHA)


def pagerank_trade(spark, d):
    return _rounded(_ranks(spark, d))


def pagerank_top(spark, d):
    return _rounded(topk.top_ranked(_settled(_ranks(spark, d)), 100))


def pagerank_normalized(spark, d):
    ranked = g.pagerank(trade_edges(spark, d), PASSES, ALPHA, normalize=True)
    return ranked.select("id", F.round("rank", 15).alias("rank"))


def pagerank_resumed(spark, d):
    """Half of the passes, ranks kept in files with a doubled row, and the other half."""
    edges = trade_edges(spark, d)  # kept by the layout alone
    layout = g.lay_out(edges)
    folder = fresh_folder(spark, "ranks")
    files.save_state(g.pagerank(edges, PASSES // 2, ALPHA, layout=layout), folder)
    begun = files.load_state(spark, folder)
    doubled = begun.unionByName(begun.filter("id like 'c1%'"))
    return _rounded(g.pagerank(edges, PASSES - PASSES // 2, ALPHA, initial=doubled, layout=layout))


def pagerank_sweep(spark, d):
    return _rounded(g.damping_sweep(trade_edges(spark, d), ALPHAS, PASSES))


def top_mass(spark, d):
    mass = topk.top_mass(_settled(_ranks(spark, d)), 100)
    return mass.select(F.round("top_k_mass", 7).alias("top_k_mass"))


def rank_name_join(spark, d):
    top = topk.top_ranked(_settled(_ranks(spark, d)), 200).select("id", "rank")
    return _rounded(topk.name_top(top, name_index(spark, d)))


def dangling_nodes(spark, d):
    return g.dangling_nodes(trade_edges(spark, d))


def node_counts(spark, d):
    return g.node_counts(trade_edges(spark, d))


def node_degrees(spark, d):
    return g.graph_nodes(trade_edges(spark, d))


def topic_from_name(spark, d):
    named = table(spark, d, "customer").select(g.topic_from_name(F.col("c_name")).alias("topic"))
    return g.topic_sizes(named)


def topic_start(spark, d):
    start = g.topic_nodes(trade_edges(spark, d), page_index(spark, d), TOPICS)
    return start.select("id", "degree", "topic", F.size("p").alias("slots"))


def _topic_vectors(spark, d):
    ranked = g.topic_pagerank(
        trade_edges(spark, d), trade_topics(spark, d), TOPICS, PASSES, ALPHA, BETA,
        extra_nodes=all_traders(spark, d),
    )
    return _settled(g.rank_vectors(ranked))


def pagerank_topic(spark, d):
    return _rounded(_topic_vectors(spark, d))


def topic_top(spark, d):
    # read twice by the report
    return _rounded(topk.top_per_vector(checkpoint(_topic_vectors(spark, d)), 10))


def topic_top_ties(spark, d):
    return _rounded(topk.top_per_vector_with_ties(checkpoint(_topic_vectors(spark, d)), 10))


def components(spark, d):
    return cc.connected_components(trade_edges(spark, d), all_traders(spark, d))


def component_sizes(spark, d):
    return cc.component_sizes(components(spark, d))


def adjacency_parse(spark, d):
    lines = trade_edges(spark, d).select(
        F.format_string("\"%s\"\t{'%s': 1}", "src", "dst").alias("value")
    )
    return files.parse_adjacency(lines)[0]


def mixed_parse(spark, d):
    adjacency = trade_edges(spark, d).select(
        F.format_string("%s\t{'%s': 1}", "src", "dst").alias("value")
    )
    index = table(spark, d, "customer").select(
        F.format_string("%s\tc%d\t%d\t0", "c_name", "c_custkey", "c_nationkey").alias("value")
    )
    links, _, names = files.parse_mixed(adjacency.unionByName(index))
    return links.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit("link").alias("kind")).unionByName(
        names.select(F.col("id").alias("a"), F.col("name").alias("b"), F.lit("name").alias("kind"))
    )


def rank_file_parse(spark, d):
    lines = table(spark, d, "customer").select(
        F.concat(F.lit('"c'), "c_custkey", F.lit('"\t'), "c_acctbal").alias("value")
    )
    trailer = lines.agg(
        F.concat(F.lit('"total mass: "\t'), F.count(F.lit(1)).cast("string")).alias("value")
    )
    return files.parse_ranks(lines.unionByName(trailer))


# --- SQL twins -------------------------------------------------------------------

EDGES = """lines AS (
  SELECT 'c' || o_custkey AS customer, 's' || l_suppkey AS supplier, 'p' || l_partkey AS part,
    l_returnflag = 'R' AS returned FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
edges AS MATERIALIZED (
  SELECT CASE WHEN returned THEN supplier ELSE customer END AS src,
         CASE WHEN returned THEN customer ELSE supplier END AS dst FROM lines
  UNION SELECT supplier, part FROM lines),
nodes AS MATERIALIZED (
  SELECT id, CAST(sum(out) AS BIGINT) AS degree
  FROM (SELECT src AS id, 1 AS out FROM edges UNION ALL SELECT dst, 0 FROM edges{more}) GROUP BY id),
size AS (SELECT count(*) AS n FROM nodes)"""
TRADERS = " UNION ALL SELECT 'c' || c_custkey, 0 FROM customer UNION ALL SELECT 's' || s_suppkey, 0 FROM supplier"
INDEXED = " UNION ALL SELECT 'c' || c_custkey, 0 FROM customer"


def _edges(more: str = "") -> str:
    return EDGES.format(more=more)


def _chain(passes: int, alpha: float, prefix: str = "r", normalize: bool = False) -> str:
    """One CTE per PageRank pass; the last one is ``{prefix}{passes}``."""
    ctes = [f"{prefix}0 AS (SELECT id, degree, CAST(1 AS DOUBLE) AS rank FROM nodes)"]
    divide = " / (SELECT n FROM size)" if normalize else ""
    for k in range(1, passes + 1):
        was = f"{prefix}{k - 1}"
        ctes.append(f"""{prefix}{k} AS MATERIALIZED (
  SELECT p.id, p.degree,
    ((coalesce((SELECT sum(rank) FROM {was} WHERE degree = 0), 0) / (SELECT n FROM size)
      + coalesce(c.inflow, 0)) * (1 - {alpha}::DOUBLE) + {alpha}::DOUBLE){divide} AS rank
  FROM {was} p LEFT JOIN (
    SELECT dst AS id, sum(s.rank / s.degree) AS inflow
    FROM edges JOIN {was} s ON s.id = src GROUP BY dst) c ON c.id = p.id)""")
    return ",\n".join(ctes)


RANKED = f"WITH {_edges()},\n{_chain(PASSES, ALPHA)},\nranked AS MATERIALIZED (\n" + f"""
  SELECT id, round(rank, 12) AS rank, round(rank / (SELECT n FROM size), 12) AS score
  FROM r{PASSES})"""


def _topic_sql() -> str:
    values = "\nUNION ALL ".join(f"SELECT {v} AS vec" for v in range(TOPICS + 1))
    ctes = [
        f"WITH {_edges(TRADERS)}",
        """topic_of AS MATERIALIZED (
  SELECT nodes.id, nodes.degree, coalesce(t.topic, 0) AS topic FROM nodes LEFT JOIN (
    SELECT 'c' || c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2
      WHEN 'AUTOMOBILE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 END AS topic FROM customer
    UNION ALL SELECT 's' || s_suppkey, s_nationkey % 5 + 5 FROM supplier
    UNION ALL SELECT 'p' || p_partkey, CASE WHEN p_size < 20 THEN 10 END FROM part) t
  ON t.id = nodes.id)""",
        f"vecs AS ({values})",
        f"""jump AS MATERIALIZED (
  SELECT t.id, t.degree, t.topic, v.vec,
    CASE WHEN v.vec = 0 THEN 1.0::DOUBLE
      WHEN t.topic = v.vec THEN {BETA}::DOUBLE * n / s.cnt
      ELSE (1 - {BETA}::DOUBLE) * n / (n - coalesce(s.cnt, 0)) END AS w
  FROM topic_of t CROSS JOIN vecs v CROSS JOIN size
  LEFT JOIN (SELECT topic, count(*) AS cnt FROM topic_of GROUP BY topic) s ON s.topic = v.vec)""",
        "t0 AS (SELECT id, degree, topic, vec, w, 1.0::DOUBLE AS rank FROM jump)",
    ]
    for k in range(1, PASSES + 1):
        was = f"t{k - 1}"
        ctes.append(f"""t{k} AS MATERIALIZED (
  SELECT p.id, p.degree, p.topic, p.vec, p.w,
    (coalesce(l.lost, 0) / (SELECT n FROM size) + coalesce(c.inflow, 0)) * (1 - {ALPHA}::DOUBLE)
      + {ALPHA}::DOUBLE * p.w AS rank
  FROM {was} p
  LEFT JOIN (SELECT vec, sum(rank) AS lost FROM {was} WHERE degree = 0 GROUP BY vec) l ON l.vec = p.vec
  LEFT JOIN (SELECT dst AS id, vec, sum(s.rank / s.degree) AS inflow
    FROM edges JOIN {was} s ON s.id = src GROUP BY dst, vec) c ON c.id = p.id AND c.vec = p.vec)""")
    ctes.append(
        f"vectors AS MATERIALIZED (SELECT id, topic, vec, round(rank, 12) AS rank FROM t{PASSES})"
    )
    return ",\n".join(ctes)


def _sweep_sql() -> str:
    chains = ",\n".join(_chain(PASSES, a, f"a{i}_") for i, a in enumerate(ALPHAS))
    rows = "\nUNION ALL ".join(
        f"SELECT {a}::DOUBLE AS alpha, id, round(rank, 9) AS rank,"
        f" round(rank / (SELECT n FROM size), 9) AS score FROM a{i}_{PASSES}"
        for i, a in enumerate(ALPHAS)
    )
    return f"WITH {_edges()},\n{chains}\n{rows}"


# Every label moves to the smallest one around it, from all links at once, until none does.
COMPONENTS = f"""WITH RECURSIVE {_edges(TRADERS)},
sym AS MATERIALIZED (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
walk(step, id, component, changed) AS (
  SELECT 0, id, id, true FROM nodes
  UNION ALL
  SELECT step + 1, id, least(component, coalesce(low, component)), max(coalesce(low, component) < component) OVER ()
  FROM (SELECT w.step, w.id, w.component, w.changed, m.low FROM walk w LEFT JOIN (
    SELECT s.a AS id, min(o.component) AS low FROM sym s JOIN walk o ON o.id = s.b GROUP BY s.a) m ON m.id = w.id)
  WHERE changed),
comp AS (SELECT id, component FROM walk WHERE step = (SELECT max(step) FROM walk))"""

QUERIES = {
    "pagerank_trade": (pagerank_trade, f"{RANKED} SELECT id, round(rank, 9) AS rank, round(score, 9) AS score FROM ranked"),
    "pagerank_top": (
        pagerank_top,
        f"""{RANKED} SELECT id, round(rank, 9) AS rank, round(score, 9) AS score
FROM (SELECT * FROM ranked ORDER BY rank DESC, id LIMIT 100)""",
    ),
    "pagerank_normalized": (
        pagerank_normalized,
        f"WITH {_edges()},\n{_chain(PASSES, ALPHA, normalize=True)} SELECT id, round(rank, 15) AS rank FROM r{PASSES}",
    ),
    "pagerank_resumed": (
        pagerank_resumed,
        f"{RANKED} SELECT id, round(rank, 9) AS rank, round(score, 9) AS score FROM ranked",
    ),
    "pagerank_sweep": (pagerank_sweep, _sweep_sql()),
    "top_mass": (
        top_mass,
        f"{RANKED} SELECT round(sum(score), 7) AS top_k_mass FROM"
        " (SELECT score FROM ranked ORDER BY rank DESC, id LIMIT 100)",
    ),
    "rank_name_join": (
        rank_name_join,
        f"""{RANKED}, top AS (SELECT id, rank FROM ranked ORDER BY rank DESC, id LIMIT 200)
SELECT round(rank, 9) AS rank, id || ' - ' || name AS label FROM top JOIN (
  SELECT 'c' || c_custkey AS id, c_name AS name FROM customer
  UNION ALL SELECT 's' || s_suppkey, s_name FROM supplier WHERE s_suppkey % 7 > 0
  UNION ALL SELECT 'p' || p_partkey, p_name FROM part WHERE p_partkey % 5 > 0) USING (id)""",
    ),
    "dangling_nodes": (
        dangling_nodes,
        f"""WITH {_edges()} SELECT DISTINCT dst AS id FROM edges
WHERE dst NOT IN (SELECT src FROM edges)""",
    ),
    "node_counts": (
        node_counts,
        f"""WITH {_edges()} SELECT count(*) AS nodes, count(*) FILTER (degree = 0) AS dangling,
(SELECT count(*) FROM edges) AS links FROM nodes""",
    ),
    "node_degrees": (node_degrees, f"WITH {_edges()} SELECT id, degree FROM nodes"),
    "topic_from_name": (
        topic_from_name,
        """SELECT CAST(strlen(c_name) % 10 + 1 AS INTEGER) AS topic, count(*) AS nodes
FROM customer GROUP BY 1""",
    ),
    "topic_start": (
        topic_start,
        f"""WITH {_edges(INDEXED)} SELECT id, degree,
CAST(coalesce(strlen(c_name) % 10 + 1, 0) AS INTEGER) AS topic, 11 AS slots
FROM nodes LEFT JOIN customer ON id = 'c' || c_custkey""",
    ),
    "pagerank_topic": (
        pagerank_topic, f"{_topic_sql()} SELECT id, topic, vec, round(rank, 9) AS rank FROM vectors"
    ),
    "topic_top": (
        topic_top,
        f"""{_topic_sql()}, firsts AS (
  SELECT vec, rank, min(id) AS id, arg_min(topic, id) AS topic FROM vectors GROUP BY vec, rank),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec ORDER BY rank DESC) AS INTEGER) AS place
  FROM firsts)
SELECT vec, place, round(rank, 9) AS rank, id, topic FROM placed WHERE place <= 10""",
    ),
    "topic_top_ties": (
        topic_top_ties,
        f"""{_topic_sql()}, placed AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY vec ORDER BY rank DESC) AS INTEGER) AS place FROM vectors)
SELECT vec, place, round(rank, 9) AS rank, id, topic FROM placed WHERE place <= 10""",
    ),
    "components": (components, f"{COMPONENTS} SELECT id, component FROM comp"),
    "component_sizes": (
        component_sizes,
        f"{COMPONENTS} SELECT component, count(*) AS nodes FROM comp GROUP BY component",
    ),
    "adjacency_parse": (
        adjacency_parse, f"WITH {_edges()} SELECT src, dst, 1.0::DOUBLE AS weight FROM edges"
    ),
    "mixed_parse": (
        mixed_parse,
        f"""WITH {_edges()} SELECT src AS a, dst AS b, 'link' AS kind FROM edges
UNION ALL SELECT 'c' || c_custkey, c_name, 'name' FROM customer""",
    ),
    "rank_file_parse": (
        rank_file_parse, "SELECT 'c' || c_custkey AS id, c_acctbal AS rank FROM customer"
    ),
}
