"""Feature queries: suppliers as plans, lines as drug listings of a part type."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.operators import features as ft
from tarnworks.session import checkpoint, stored
from tarnworks.sources.tables import table

VALUES = ["quantity", "discount", "tax", "flag"]


def plan_records(spark, d) -> DataFrame:
    """Nested plan records: a supplier with its place and money."""
    suppliers = table(spark, d, "supplier")
    nations = table(spark, d, "nation")
    met = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey)
    nation = F.when(F.col("n_nationkey") != 7, F.col("n_name"))  # plans of one nation have none
    return met.select(
        F.col("s_suppkey").alias("plan_id"),
        F.struct(
            nation.alias("nation"),
            F.struct((F.col("n_regionkey") > 2).alias("far")).alias("zone"),
        ).alias("place"),
        F.col("s_acctbal").alias("balance"),
    )


def drug_records(spark, d) -> DataFrame:
    """Nested drug records: the plan listings of a part type in one order."""
    lines = table(spark, d, "lineitem")
    parts = table(spark, d, "part")
    met = lines.join(parts, lines.l_partkey == parts.p_partkey)
    listing = F.struct(
        F.col("l_suppkey").alias("plan_id"),
        F.struct("l_orderkey", "l_linenumber", "l_extendedprice").alias("place"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("flag"),
    )
    return met.groupBy("l_orderkey", F.col("p_type").alias("drug")).agg(
        F.collect_list(listing).alias("plans")  # an order has seven lines at most
    ).select("drug", "plans")


def _fields(records: DataFrame) -> dict[str, str]:
    return ft.leaf_fields(records.schema)


def leaf_fields(spark, d):
    """All leaf fields of both record types with the number of their distinct values."""
    plans, drugs = plan_records(spark, d), drug_records(spark, d)
    rows = {"plan": (plans, _fields(plans)), "drug": (drugs, _fields(drugs))}
    found = None
    for kind, (records, fields) in rows.items():
        counts = ft.distinct_values(records, list(fields)).groupBy("path").agg(
            F.count("value").alias("values")
        )
        counts = counts.select(F.lit(kind).alias("kind"), "path", "values")
        found = counts if found is None else found.unionByName(counts)
    return found


def field_values(spark, d):
    return ft.distinct_values(drug_records(spark, d), ["drug", "plans.flag", "plans.plan_id"])


def value_index(spark, d):
    values = ft.distinct_values(plan_records(spark, d), ["place.nation"]).unionByName(
        ft.distinct_values(drug_records(spark, d), ["drug", "plans.flag"])
    )
    return ft.value_index(values)


PLAN_FIELDS = ["place.nation", "place.zone.far", "balance"]


def _encoded_plans(spark, d):
    plans = plan_records(spark, d)
    fields = ft.select_fields(_fields(plans), PLAN_FIELDS)
    index = checkpoint(ft.value_index(ft.distinct_values(plans, ["place.nation"])))
    return ft.encode(plans, "plan_id", fields, index), index


def plan_features(spark, d):
    return _encoded_plans(spark, d)[0]


def plan_one_hot(spark, d):
    encoded, index = _encoded_plans(spark, d)
    return ft.one_hot(encoded, "plan_id", index, ["place.nation"])


def listings(spark, d) -> DataFrame:
    """First listing of every drug and plan."""
    rows = drug_records(spark, d).select("drug", F.explode("plans").alias("p")).select(
        "drug", "p.plan_id", "p.place.*", *[f"p.{v}" for v in VALUES]
    )
    order = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    return ft.first_listing(rows, ["drug", "plan_id"], order, VALUES)


def drug_plan_long(spark, d):
    return listings(spark, d)


def drug_plan_wide(spark, d):
    rows = checkpoint(listings(spark, d))
    index = ft.value_index(rows.select(F.lit("drug").alias("path"), F.col("drug").alias("value")).distinct())
    names = [r["value"] for r in index.orderBy("idx").collect()]  # columns of the wide form
    wide = ft.widen(rows, "plan_id", "drug", names, VALUES)
    cells = [
        F.struct(F.lit(n).alias("drug"), *[F.col(f"`{n}_{v}`").alias(v) for v in VALUES]) for n in names
    ]
    # one row per cell, so that the query's columns don't depend on the data
    return wide.select("plan_id", F.explode(F.array(*cells)).alias("c")).select("plan_id", "c.*")


def feature_join(spark, d):
    plans = plan_records(spark, d).select("plan_id", F.col("place.nation").alias("nation"), "balance")
    return ft.join_features(plans, listings(spark, d)).select(
        "plan_id", "drug", "nation", "balance", "quantity", "flag"
    )


def feature_vectors(spark, d):
    """One-hot vectors of the joined features, taken apart again."""
    joined = stored(feature_join(spark, d))  # read for the index, to fit the encoder and by it
    index = checkpoint(
        ft.value_index(joined.select(F.lit("flag").alias("path"), F.col("flag").alias("value")).distinct())
    )
    coded = joined.join(
        index.select(F.col("value").alias("flag"), F.col("idx").cast("double").alias("code")), "flag"
    )
    vectors = ft.one_hot_vectors(coded, ["code"], ["balance", "quantity"])
    v = vector_to_array("features")
    slots = F.slice(v, 3, F.size(v) - 2)
    return vectors.select(
        "plan_id", "drug", v[0].alias("balance"), v[1].alias("quantity"),
        (F.array_position(slots, 1.0) - 1).alias("slot"),
        F.aggregate(slots, F.lit(0.0), lambda s, x: s + x).alias("ones"), F.size(v).alias("width"),
    )


# --- SQL twins -------------------------------------------------------------------

PLANS = """plans AS MATERIALIZED (SELECT s_suppkey AS plan_id,
  CASE WHEN n_nationkey <> 7 THEN n_name END AS nation, n_regionkey > 2 AS far,
  s_acctbal AS balance FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
NATION_INDEX = """nation_index AS (SELECT nation, row_number() OVER (ORDER BY nation NULLS LAST) - 1 AS idx
  FROM (SELECT DISTINCT nation FROM plans))"""
DRUG_LINES = """drugs AS MATERIALIZED (SELECT p_type AS drug, l_suppkey AS plan_id, l_orderkey, l_linenumber,
  l_extendedprice, l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_returnflag AS flag
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
FIRST = DRUG_LINES + """,
firsts AS MATERIALIZED (SELECT drug, plan_id, quantity, discount, tax, flag FROM drugs
  QUALIFY row_number() OVER (PARTITION BY drug, plan_id
    ORDER BY l_orderkey, l_linenumber, l_extendedprice, quantity, discount, tax, flag) = 1)"""


def _distinct_counts() -> str:
    columns = {
        ("plan", "plan_id"): "plans.plan_id", ("plan", "place.nation"): "plans.nation",
        ("plan", "place.zone.far"): "plans.far", ("plan", "balance"): "plans.balance",
        ("drug", "drug"): "drugs.drug", ("drug", "plans.plan_id"): "drugs.plan_id",
        ("drug", "plans.place.l_orderkey"): "drugs.l_orderkey",
        ("drug", "plans.place.l_linenumber"): "drugs.l_linenumber",
        ("drug", "plans.place.l_extendedprice"): "drugs.l_extendedprice",
        **{("drug", f"plans.{v}"): f"drugs.{v}" for v in VALUES},
    }
    return f"WITH {PLANS}, {DRUG_LINES} " + " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{path}' AS path, count(DISTINCT {c}) AS values FROM {c.split('.')[0]}"
        for (kind, path), c in columns.items()
    )


QUERIES = {
    "leaf_fields": (leaf_fields, _distinct_counts()),
    "field_values": (
        field_values,
        f"""WITH {DRUG_LINES} SELECT DISTINCT 'drug' AS path, drug AS value FROM drugs
UNION ALL SELECT DISTINCT 'plans.flag', flag FROM drugs
UNION ALL SELECT DISTINCT 'plans.plan_id', CAST(plan_id AS VARCHAR) FROM drugs""",
    ),
    "value_index": (
        value_index,
        f"""WITH {PLANS}, {DRUG_LINES}, v AS (SELECT DISTINCT 'place.nation' AS path, nation AS value FROM plans
UNION ALL SELECT DISTINCT 'drug', drug FROM drugs UNION ALL SELECT DISTINCT 'plans.flag', flag FROM drugs)
SELECT path, value, row_number() OVER (PARTITION BY path ORDER BY value NULLS LAST) - 1 AS idx FROM v""",
    ),
    "plan_features": (
        plan_features,
        f"""WITH {PLANS}, {NATION_INDEX}
SELECT plan_id, 'place.nation' AS path, CAST(idx AS DOUBLE) AS value FROM plans p JOIN nation_index i ON p.nation IS NOT DISTINCT FROM i.nation
UNION ALL SELECT plan_id, 'place.zone.far', CAST(far AS DOUBLE) FROM plans
UNION ALL SELECT plan_id, 'balance', balance FROM plans""",
    ),
    "plan_one_hot": (
        plan_one_hot,
        f"""WITH {PLANS} SELECT plan_id, 'place.nation=' || coalesce(nation, 'null') AS feature, 1.0::DOUBLE AS value FROM plans
UNION ALL SELECT plan_id, 'place.zone.far', CAST(far AS DOUBLE) FROM plans
UNION ALL SELECT plan_id, 'balance', balance FROM plans""",
    ),
    "drug_plan_long": (
        drug_plan_long,
        f"WITH {FIRST} SELECT drug, plan_id, quantity, discount, tax, flag FROM firsts",
    ),
    "drug_plan_wide": (
        drug_plan_wide,
        f"""WITH {FIRST} SELECT p.plan_id, d.drug, f.quantity, f.discount, f.tax, f.flag
FROM (SELECT DISTINCT plan_id FROM firsts) p CROSS JOIN (SELECT DISTINCT drug FROM firsts) d
LEFT JOIN firsts f ON f.plan_id = p.plan_id AND f.drug = d.drug""",
    ),
    "feature_join": (
        feature_join,
        f"""WITH {PLANS}, {FIRST}
SELECT plan_id, drug, nation, balance, quantity, flag FROM firsts JOIN plans USING (plan_id)""",
    ),
    "feature_vectors": (
        feature_vectors,
        f"""WITH {PLANS}, {FIRST}, met AS (SELECT * FROM firsts JOIN plans USING (plan_id)),
flags AS (SELECT flag, row_number() OVER (ORDER BY flag) - 1 AS slot FROM (SELECT DISTINCT flag FROM met))
SELECT plan_id, drug, balance, quantity, slot, 1.0::DOUBLE AS ones,
  CAST(2 + (SELECT count(*) FROM flags) AS INTEGER) AS width FROM met JOIN flags USING (flag)""",
    ),
}
