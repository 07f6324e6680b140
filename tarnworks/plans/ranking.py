"""Learning-to-rank queries over the embeddings.

25 neighbouring vectors form a query, so that queries keep their size as the table
grows; the label is the relevance and the vector holds the features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.vectors import dot, norm
from tarnworks.operators import correlation as co
from tarnworks.operators import ranking as rk
from tarnworks.session import checkpoint
from tarnworks.sources.lines import parse_ranking_samples
from tarnworks.sources.tables import table

QUERY_ROWS = 25


def samples(spark, d) -> DataFrame:
    whole = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, d, "embeddings").select(
        F.floor(F.col("vec_id") / QUERY_ROWS).alias("qid"),
        (F.col("vec_id") % QUERY_ROWS).alias("pos"),
        F.col("label").alias("rel"),
        whole.alias("fv"),
    )


def pair_samples(spark, d):
    """Every third place of a query is left empty. ``x`` holds all dimensions, ``mixed`` is a
    weighted sum of them."""
    pairs = rk.pair_samples(samples(spark, d).withColumn("pos", F.floor(F.col("pos") * 3 / 2)))
    weights = F.transform("x", lambda _, n: (n + 1).cast("double"))
    return pairs.select(
        "qid", "i", "j", "k", "y", "diff", F.size("x").alias("n"),
        F.round(dot(F.col("x"), weights), 6).alias("mixed"),
    )


def level_counts(spark, d):
    return rk.level_counts(samples(spark, d))


def rankable(spark, d):
    return rk.rankable(samples(spark, d)).select("qid", "pos", "rel")


def split_sizes(spark, d):
    halves = rk.half_split(samples(spark, d), "rel", ["qid", "pos"])
    return halves.groupBy("rel", "train").agg(F.count(F.lit(1)).alias("n"))


def kendall_tau(spark, d):
    scored = samples(spark, d).select(
        F.col("qid").alias("block"), F.round(F.col("fv")[0], 1).alias("score"), F.col("rel").alias("label")
    )
    return co.kendall_tau(scored).withColumn("tau", F.round("tau", 9))


def kendall_tau_whole(spark, d):
    """The whole table as one block."""
    scored = samples(spark, d).select(
        F.lit(0).alias("block"), F.col("fv")[1].alias("score"), F.col("rel").alias("label")
    )
    return co.kendall_tau(scored).withColumn("tau", F.round("tau", 9))


def vector_scores(spark, d):
    vectors = samples(spark, d).select("qid", "pos", "fv")
    weights = F.transform("fv", lambda _, i: F.lit(1.0) / (i + 1))
    return vectors.select(
        "qid", "pos", F.round(dot(F.col("fv"), weights), 7).alias("score"),
        F.round(norm(F.col("fv")), 7).alias("length"),
    )


def letor_parse(spark, d):
    sample = samples(spark, d)
    features = F.transform("fv", lambda v, i: F.format_string("%d:%.6f", i + 1, v))
    lines = sample.select(
        F.concat_ws(
            " ", F.col("rel").cast("string"), F.concat(F.lit("qid:"), "qid"),
            F.array_join(features, " "),
            F.concat(F.lit("#docid = GX"), "pos", F.lit(" inc = 1 prob = 0.5")),
        ).alias("value")
    )
    broken = sample.select(F.explode(F.array(F.lit(""), F.lit("2 1:0.5"), F.lit("x qid:1 1:2"))).alias("value"))
    parsed = parse_ranking_samples(lines.unionByName(broken))
    return parsed.select(
        "qid", "rel", F.size("fv").alias("n"), F.col("fv")[0].alias("first"), F.element_at("fv", -1).alias("last")
    )


def linear_rank(spark, d):
    """Weights of the pair classifier and its ranking quality on the held-out half."""
    halves = checkpoint(rk.half_split(samples(spark, d), "rel", ["qid", "pos"]))
    weights = rk.fit_pair_svm(rk.pair_samples(halves.filter("train")))
    return rk.ranking_quality(halves.filter("not train"), weights)


def ridge_rank(spark, d):
    halves = checkpoint(rk.half_split(samples(spark, d), "rel", ["qid", "pos"]))
    weights = rk.fit_ridge(halves.filter("train"))
    found = rk.ranking_quality(halves.filter("not train"), weights)
    return found.select("block", F.round("tau", 9).alias("tau"))


# --- SQL twins -------------------------------------------------------------------

SAMPLES = f"""WITH samples AS MATERIALIZED (
  SELECT vec_id // {QUERY_ROWS} AS qid, vec_id % {QUERY_ROWS} AS pos, label AS rel,
    CAST(embedding AS DOUBLE[]) AS fv FROM embeddings)"""


def _tau_sql(block: str, score: str) -> str:
    return f"""{SAMPLES},
scored AS MATERIALIZED (SELECT {block} AS block, {score} AS score, rel AS label, qid * {QUERY_ROWS} + pos AS id FROM samples)
SELECT a.block, round(sum(sign(a.score - b.score) * sign(a.label - b.label))
  / nullif(sqrt(CAST(sum(abs(sign(a.score - b.score))) AS DOUBLE) * sum(abs(sign(a.label - b.label)))), 0), 9) AS tau
FROM scored a JOIN scored b ON a.block = b.block AND a.id < b.id GROUP BY a.block"""


# The normal equations of centred features, solved by elimination one column at a time.
RIDGE_RANK = SAMPLES.replace("WITH", "WITH RECURSIVE", 1) + """,
halves AS MATERIALIZED (SELECT *, 2 * (row_number() OVER (PARTITION BY rel ORDER BY md5('0:' || qid || ':' || pos), qid, pos) - 1)
    < count(*) OVER (PARTITION BY rel) AS train FROM samples),
cells AS MATERIALIZED (SELECT qid, pos, i, x - avg(x) OVER (PARTITION BY i) AS x, rel - avg(rel) OVER (PARTITION BY i) AS y
  FROM (SELECT qid, pos, rel, unnest(fv) AS x, generate_subscripts(fv, 1) AS i FROM halves WHERE train)),
gram AS (SELECT a.i, b.i AS j, sum(a.x * b.x) + CASE WHEN a.i = b.i THEN 1 ELSE 0 END AS g
  FROM cells a JOIN cells b USING (qid, pos) GROUP BY a.i, b.i
  UNION ALL SELECT i, 1000000, sum(x * y) FROM cells GROUP BY i),
steps(k, i, r) AS (
  SELECT 0, i, list(g ORDER BY j) FROM gram GROUP BY i
  UNION ALL
  SELECT a.k + 1, a.i, CASE WHEN a.i = a.k + 1 THEN list_transform(a.r, lambda x: x / a.r[a.k + 1])
    ELSE list_transform(list_zip(a.r, p.r), lambda z: z[1] - a.r[a.k + 1] / p.r[a.k + 1] * z[2]) END
  FROM steps a JOIN steps p ON p.i = a.k + 1 WHERE a.k < len(a.r) - 1),
weights AS (SELECT list(r[-1] ORDER BY i) AS w FROM steps WHERE k = len(r) - 1),
scored AS MATERIALIZED (SELECT qid AS block, list_dot_product(fv, w) AS score, rel AS label, pos AS id
  FROM halves, weights WHERE NOT train)
SELECT a.block, round(sum(sign(a.score - b.score) * sign(a.label - b.label))
  / nullif(sqrt(CAST(sum(abs(sign(a.score - b.score))) AS DOUBLE) * sum(abs(sign(a.label - b.label)))), 0), 9) AS tau
FROM scored a JOIN scored b ON a.block = b.block AND a.id < b.id GROUP BY a.block"""


QUERIES = {
    "pair_samples": (
        pair_samples,
        SAMPLES + """,
pairs AS (SELECT a.qid, a.pos AS i, b.pos AS j, a.fv AS fa, b.fv AS fb, a.rel - b.rel AS d,
    row_number() OVER (PARTITION BY a.qid ORDER BY a.pos, b.pos) - 1 AS k
  FROM samples a JOIN samples b ON a.qid = b.qid AND a.pos < b.pos AND a.rel <> b.rel),
signed AS (SELECT *, CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END AS y FROM pairs),
flipped AS (SELECT *, y * sign(d) AS f FROM signed)
SELECT qid, i, j, k, y, CAST(d * f AS INTEGER) AS diff, CAST(len(fa) AS INTEGER) AS n,
round(list_sum(list_transform(range(1, len(fa) + 1), lambda n: (fa[n] - fb[n]) * f * n)), 6) AS mixed FROM flipped""",
    ),
    "level_counts": (
        level_counts, f"{SAMPLES} SELECT qid, rel, count(*) AS n FROM samples GROUP BY qid, rel"
    ),
    "rankable": (
        rankable,
        f"""{SAMPLES} SELECT qid, pos, rel FROM samples WHERE qid IN (
  SELECT qid FROM samples GROUP BY qid HAVING count(DISTINCT rel) > 1)""",
    ),
    "split_sizes": (
        split_sizes,
        f"""{SAMPLES}, sizes AS (SELECT rel, count(*) AS n FROM samples GROUP BY rel)
SELECT rel, true AS train, n - n // 2 AS n FROM sizes
UNION ALL SELECT rel, false, n // 2 FROM sizes WHERE n > 1""",
    ),
    "kendall_tau": (kendall_tau, _tau_sql("qid", "round(fv[1], 1)")),
    "kendall_tau_whole": (kendall_tau_whole, _tau_sql("0", "fv[2]")),
    "vector_scores": (
        vector_scores,
        f"""{SAMPLES}, cells AS (SELECT qid, pos, unnest(fv) AS v, generate_subscripts(fv, 1) AS i FROM samples)
SELECT qid, pos, round(sum(v / i), 7) AS score, round(sqrt(sum(v * v)), 7) AS length FROM cells GROUP BY qid, pos""",
    ),
    "letor_parse": (
        letor_parse,
        f"""{SAMPLES} SELECT CAST(qid AS VARCHAR) AS qid, rel, CAST(len(fv) AS INTEGER) AS n,
round(fv[1], 6) AS first, round(fv[-1], 6) AS last FROM samples""",
    ),
    "linear_rank": (linear_rank, None),
    "ridge_rank": (ridge_rank, RIDGE_RANK),
}
