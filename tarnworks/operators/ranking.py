"""Pairwise learning to rank: pair samples, linear models, evaluation."""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.functions.vectors import dot, minus, times
from tarnworks.operators.correlation import kendall_tau
from tarnworks.operators.scale import HOT_ROWS, join_lookup, positions, running
from tarnworks.session import checkpoint

# Rows per side of one tile of the pair triangle.
TILE = 1024


def level_counts(samples: DataFrame) -> DataFrame:
    """Rows per query and relevance level."""
    return samples.groupBy("qid", "rel").agg(F.count(F.lit(1)).alias("n"))


def rankable(samples: DataFrame) -> DataFrame:
    """Samples of queries that have more than one relevance level."""
    levels = samples.groupBy("qid").agg(F.min("rel").alias("lo"), F.max("rel").alias("hi"))
    return samples.join(levels.filter("lo < hi").select("qid"), "qid", "left_semi")


def _numbered(samples: DataFrame, hot_rows: int) -> DataFrame:
    """Samples with the number of pairs of their query that come before their own; ``pos``
    becomes the place in the query."""
    order = samples.select("qid", F.col("pos").alias("_order"), "rel", "fv")
    samples = checkpoint(positions(order, ["qid"], ["_order"], "pos", hot_rows).drop("_order"))
    per_level = level_counts(samples).withColumnRenamed("n", "level_rows")
    per_level = checkpoint(per_level.withColumn("size", F.col("level_rows")))
    placed = positions(samples, ["qid", "rel"], ["pos"], "level_pos", hot_rows)
    placed = join_lookup(checkpoint(placed), per_level, ["qid", "rel"], "size", hot_rows)
    per_query = per_level.groupBy("qid").agg(F.sum("level_rows").alias("rows"))
    per_query = checkpoint(per_query.withColumn("size", F.col("rows")))
    sized = join_lookup(checkpoint(placed), per_query, ["qid"], "size", hot_rows)
    later = F.col("rows") - F.col("pos") - (F.col("level_rows") - F.col("level_pos"))
    counted = running(
        sized.withColumn("pairs", later), ["qid"], ["pos"], {"upto": ("sum", F.col("pairs"))},
        hot_rows,
    )
    return counted.select(
        "qid", "pos", "rel", "fv", "rows", (F.col("upto") - F.col("pairs")).alias("before")
    )


def pair_samples(
    samples: DataFrame, tile: int = TILE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The pairwise transform: every pair i < j of one query with different relevance.

    ``samples`` has qid, pos (its order in the query, gaps allowed), rel and fv; i and j are
    places counted from 0. The k-th pair of
    a query gets ``y = (-1)^k``; ``x`` and ``diff`` are flipped to match: ``qid, i, j,
    k, x, y, diff``. The pairs are the result, so their number is what the queries
    imply; a long query is cut into tiles of ``tile x tile`` that run as separate
    tasks.
    """
    numbered = checkpoint(_numbered(samples, hot_rows))
    block = F.floor(F.col("pos") / tile)
    last = F.floor((F.col("rows") - 1) / tile)
    first_of_pair = numbered.select(
        "qid",
        F.col("pos").alias("i"),
        F.col("rel").alias("rel_i"),
        F.col("fv").alias("fv_i"),
        "before",
        block.alias("block_i"),
        F.explode(F.sequence(block, last)).alias("block_j"),
    )
    second_of_pair = numbered.select(
        "qid",
        F.col("pos").alias("j"),
        F.col("rel").alias("rel_j"),
        F.col("fv").alias("fv_j"),
        block.alias("block_j"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), block)).alias("block_i"),
    )
    met = first_of_pair.join(second_of_pair, ["qid", "block_i", "block_j"])
    met = met.filter("i < j and rel_i <> rel_j")
    w = Window.partitionBy("qid", "i").orderBy("j")
    k = F.col("before") + F.row_number().over(w) - 1
    sign = F.when(F.col("k") % 2 == 0, 1).otherwise(-1)
    flip = (sign * F.signum(F.col("rel_i") - F.col("rel_j"))).cast("int")
    return met.withColumn("k", k).select(
        "qid",
        "i",
        "j",
        "k",
        times(minus(F.col("fv_i"), F.col("fv_j")), flip).alias("x"),
        sign.alias("y"),
        ((F.col("rel_i") - F.col("rel_j")) * flip).alias("diff"),
    )


def half_split(samples: DataFrame, label: str, order: list[str], seed: int = 0) -> DataFrame:
    """Mark a stratified half: ``train`` is true for half the rows of each label, picked
    by the MD5 hash of ``seed`` and the columns in ``order``, joined by colons."""
    mixed = samples.withColumn("_mix", F.md5(F.concat_ws(":", F.lit(seed), *order)))
    placed = positions(mixed, [label], ["_mix", *order], "_pos")
    sizes = samples.groupBy(label).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = checkpoint(sizes.withColumn("_size", F.col("_rows")))
    met = join_lookup(checkpoint(placed), sizes, [label], "_size")
    return met.withColumn("train", F.col("_pos") * 2 < F.col("_rows")).drop(
        "_mix", "_pos", "_rows"
    )


def fit_pair_svm(
    pairs: DataFrame, c: float = 0.1, max_iter: int = 1000, tol: float = 1e-4
) -> list[float]:
    """Unit-length weights of a linear support vector machine on pair samples. A fit that
    doesn't settle to ``tol`` is an error, not a result."""
    points = pairs.select(
        array_to_vector("x").alias("features"), ((F.col("y") + 1) / 2).alias("label")
    ).persist()
    ridge = 1 / (c * points.count())
    svm = LinearSVC(regParam=ridge, standardization=False, maxIter=max_iter, tol=tol)
    model = svm.fit(points)
    points.unpersist()
    if model.summary().totalIterations >= max_iter:
        raise ValueError(f"no convergence after {max_iter} iterations")
    weights = model.coefficients
    return [float(v) for v in weights / weights.norm(2)]


def fit_ridge(samples: DataFrame, penalty: float = 1.0) -> list[float]:
    """Unit-length coefficients of a ridge regression of ``rel`` on ``fv``."""
    points = samples.select(
        array_to_vector("fv").alias("features"), F.col("rel").cast("double").alias("label")
    ).persist()
    # the solver works on the label divided by its deviation, and on means over the rows
    n, spread = points.agg(F.count(F.lit(1)), F.stddev_pop("label")).first()
    ridge = LinearRegression(
        regParam=penalty * spread / n, elasticNetParam=0.0, standardization=False, solver="normal"
    )
    weights = ridge.fit(points).coefficients
    points.unpersist()
    return [float(v) for v in weights / weights.norm(2)]


def with_score(samples: DataFrame, weights: list[float]) -> DataFrame:
    return samples.withColumn(
        "score", dot(F.col("fv"), F.array(*[F.lit(float(v)) for v in weights]))
    )


def ranking_quality(
    samples: DataFrame, weights: list[float], block: str = "qid", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Kendall tau between model score and relevance per block."""
    scored = with_score(samples, weights)
    return kendall_tau(
        scored.select(F.col(block).alias("block"), "score", F.col("rel").alias("label")), hot_rows
    )
