"""Feature building from nested records.

Fields are named by dotted paths; a path may run through arrays of records.
Feature tables are kept in long form (one row per record and slot), which holds for
any number of fields, categories and drugs; ``assemble`` and ``one_hot_vectors``
give Spark ML vectors where the slots are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.functions.vectors import exploded
from tarnworks.operators.scale import HOT_ROWS, join_lookup, positions
from tarnworks.session import checkpoint


def leaf_fields(schema: T.DataType, prefix: str = "") -> dict[str, str]:
    """Dotted paths of all leaf fields with their type names, arrays looked through."""
    if isinstance(schema, T.ArrayType):
        return leaf_fields(schema.elementType, prefix)
    if not isinstance(schema, T.StructType):
        return {prefix: schema.simpleString()}
    found: dict[str, str] = {}
    for field in schema.fields:
        found |= leaf_fields(field.dataType, f"{prefix}.{field.name}" if prefix else field.name)
    return found


def select_fields(fields: dict[str, str], chosen: Sequence[str]) -> dict[str, str]:
    """Keep the fields that are switched on."""
    return {p: t for p, t in fields.items() if p in set(chosen)}


def fields_of(fields: dict[str, str], record_type: str) -> dict[str, str]:
    """Keep the fields of one record type (path prefix)."""
    return {p: t for p, t in fields.items() if p.startswith(record_type)}


def _values_at(kind: T.DataType, steps: list[str], value: Column) -> Column:
    """Array of the texts found below ``value`` by following ``steps``."""
    if isinstance(kind, T.ArrayType):
        below = F.transform(value, lambda x: _values_at(kind.elementType, steps, x))
        return F.coalesce(F.flatten(below), F.array().cast("array<string>"))
    if not steps:
        return F.array(value.cast("string"))
    return _values_at(kind[steps[0]].dataType, steps[1:], value[steps[0]])


def path_values(records: DataFrame, path: str) -> Column:
    """Array of all values of a record at a path, as text."""
    first, *rest = path.split(".")
    return _values_at(records.schema[first].dataType, rest, F.col(first))


def distinct_values(records: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Distinct values of each field as text, in one pass over the records: ``path,
    value``."""

    def entries(path: str) -> Column:
        name = F.lit(path).alias("path")
        return F.transform(path_values(records, path), lambda v: F.struct(name, v.alias("value")))

    found = records.select(exploded(F.concat(*[entries(p) for p in paths])).alias("e"))
    return found.select("e.*").filter("path is not null").distinct()


def value_index(values: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number the values of each path alphabetically from 0: ``path, value, idx``. A null is
    a value like any other and comes last."""
    marked = values.withColumn("_null", F.col("value").isNull())
    return positions(marked, ["path"], ["_null", "value"], "idx", hot_rows).drop("_null")


def encode(
    records: DataFrame,
    key: str,
    fields: dict[str, str],
    index: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Numbers for the fields of flat records in long form: ``key, path, value``. Text
    becomes its index, numbers and booleans keep their value."""
    text = [p for p, t in fields.items() if t == "string"]
    plain = [p for p in fields if p not in text]

    def long(paths: list[str], kind: str) -> DataFrame:
        entries = F.array(
            *[F.struct(F.lit(p).alias("path"), F.col(p).cast(kind).alias("value")) for p in paths]
        )
        return records.select(key, F.explode(entries).alias("e")).select(key, "e.*")

    parts = []
    if plain:
        parts.append(long(plain, "double"))
    if text:
        # the null value joins as any other
        keyed = lambda df: df.withColumn("slot", F.struct("value")).drop("value")
        entries = checkpoint(keyed(long(text, "string")))
        sizes = entries.groupBy("path", "slot").agg(F.count(F.lit(1)).alias("size"))
        lookup = checkpoint(keyed(index).join(sizes, ["path", "slot"]))
        met = join_lookup(entries, lookup, ["path", "slot"], "size", hot_rows)
        parts.append(met.select(key, "path", F.col("idx").cast("double").alias("value")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def first_listing(
    listings: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """The first record of each key combination in list order (a drug may be listed on
    two tiers of one plan)."""
    picked = listings.groupBy(*keys).agg(F.min(F.struct(*order, *values)).alias("first"))
    return picked.select(*keys, *[F.col("first")[v].alias(v) for v in values])


def widen(
    listings: DataFrame, key: str, column: str, names: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """One row per ``key`` with all ``values`` of each of the named columns side by side."""
    aggs = [F.first(v, ignorenulls=True).alias(v) for v in values]
    return listings.groupBy(key).pivot(column, list(names)).agg(*aggs)


def one_hot(
    encoded: DataFrame,
    key: str,
    index: DataFrame,
    text: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sparse one-hot form ``key, feature, value`` of long features: entries of ``text``
    fields become ``path=category`` with value 1, the others keep name and number."""
    is_text = F.col("path").isin(*text)
    plain = encoded.filter(~is_text).select(key, F.col("path").alias("feature"), "value")
    slots = checkpoint(encoded.filter(is_text))
    sizes = slots.groupBy("path", "value").agg(F.count(F.lit(1)).alias("size"))
    named = index.select(
        "path",
        F.col("idx").cast("double").alias("value"),
        F.concat("path", F.lit("="), F.coalesce("value", F.lit("null"))).alias("feature"),
    )
    lookup = checkpoint(sizes.join(named, ["path", "value"]))
    hot = join_lookup(slots, lookup, ["path", "value"], "size", hot_rows)
    return plain.unionByName(hot.select(key, "feature", F.lit(1.0).alias("value")))


def assemble(features: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns as one dense vector."""
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(features)


def one_hot_vectors(
    features: DataFrame, categorical: Sequence[str], numeric: Sequence[str]
) -> DataFrame:
    """One-hot encode index columns and join them with the numeric ones to a vector."""
    hot = [f"{c}_hot" for c in categorical]
    encoder = OneHotEncoder(inputCols=list(categorical), outputCols=hot, dropLast=False)
    wide = encoder.fit(features).transform(features)
    return assemble(wide, [*numeric, *hot]).drop(*hot)


def join_features(plans: DataFrame, drugs: DataFrame, key: str = "plan_id") -> DataFrame:
    """Plan features next to drug features, for plans that any drug lists."""
    return drugs.join(plans, key)


