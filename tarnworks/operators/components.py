"""Connected components by alternating star contractions.

Each round ties every neighbour of a node to the smallest node around it, first
the larger neighbours, then the smaller ones (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014). The pair set shrinks to one star per
component in about log N rounds, whatever the diameter.

A round shuffles all pairs several times, so they are thinned before: every node is tied
to its smallest neighbour, these ties, one for a node, are contracted, and only pairs
between different trees stay, by the names of their trees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.operators.scale import HOT_ROWS, join_lookup
from tarnworks.session import checkpoint, stored


def _lowest(pairs: DataFrame) -> DataFrame:
    return checkpoint(
        pairs.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("size"))
    )


def _tie_larger(pairs: DataFrame, hot_rows: int) -> DataFrame:
    turned = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    both = pairs.select(F.explode(F.array(F.struct("u", "v"), turned)).alias("p")).select("p.*")
    met = join_lookup(both, _lowest(both), ["u"], "size", hot_rows)
    tied = met.filter("v > u").select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
    return checkpoint(tied.distinct())


def _tie_smaller(pairs: DataFrame, hot_rows: int) -> DataFrame:
    met = join_lookup(pairs, _lowest(pairs), ["u"], "size", hot_rows)
    low = F.col("low")
    tied = met.select(
        F.explode(
            F.when(
                F.col("v") == low, F.array(F.struct("u", low.alias("v")))
            ).otherwise(
                F.array(F.struct("u", low.alias("v")), F.struct(F.col("v").alias("u"), low.alias("v")))
            )
        ).alias("p")
    ).select("p.*")
    return checkpoint(tied.distinct())


def _signature(pairs: DataFrame) -> tuple:
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def _stars(pairs: DataFrame, hot_rows: int) -> DataFrame:
    """``u, v``: the smallest node ``v`` of the component of each ``u`` but itself. ``pairs`` have
    ``u > v`` and are checkpointed."""
    seen = None
    while True:
        now = _signature(pairs)
        if now == seen or not now[0]:
            return pairs
        seen = now
        pairs = _tie_smaller(_tie_larger(pairs, hot_rows), hot_rows)


def _renamed(pairs: DataFrame, end: str, names: DataFrame, hot_rows: int) -> DataFrame:
    """``pairs`` with the node at one end replaced by its ``root`` (names: id, root, size)."""
    other = "v" if end == "u" else "u"
    met = join_lookup(pairs, names.withColumnRenamed("id", end), [end], "size", hot_rows)
    return met.select(other, F.col("root").alias(end))


def connected_components(
    edges: DataFrame, nodes: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``id, component`` where the component is named by its smallest id.

    Edge direction is ignored; ``nodes`` may add ids without edges.
    """
    edges = stored(edges.select("src", "dst"))  # read several times
    pairs = edges.filter("src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    )
    turned = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    low = _lowest(pairs.select(F.explode(F.array(F.struct("u", "v"), turned)).alias("p")).select("p.*"))
    ties = low.filter("low <> u").select(F.greatest("u", "low").alias("u"), F.least("u", "low").alias("v"))
    trees = _stars(checkpoint(ties.distinct()), hot_rows).withColumnRenamed("v", "root")
    names = checkpoint(low.join(trees, "u", "left").select(
        F.col("u").alias("id"), F.coalesce("root", "u").alias("root"), "size"
    ))
    between = _renamed(_renamed(pairs, "u", names, hot_rows), "v", names, hot_rows).filter("u <> v")
    between = between.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    joined = _stars(checkpoint(between), hot_rows).select(F.col("u").alias("root"), F.col("v").alias("least"))
    found = names.join(joined, "root", "left").select("id", F.coalesce("least", "root").alias("component"))
    # Loops and edges with a null end name nodes only.
    loose = edges.filter("not coalesce(src <> dst, false)")
    ids = names.select("id").unionByName(loose.select(F.explode(F.array("src", "dst")).alias("id")))
    if nodes is not None:
        ids = ids.unionByName(nodes.select("id"))
    return ids.distinct().join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def component_sizes(components: DataFrame) -> DataFrame:
    """Components from largest to smallest; ties go to the smaller name."""
    return (
        components.groupBy("component")
        .agg(F.count(F.lit(1)).alias("nodes"))
        .orderBy(F.desc("nodes"), "component")
    )
