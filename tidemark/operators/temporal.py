"""Questions to historised tables (Q1-Q13). All are filters, joins and aggregates that reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lookup tables up to this many codes are broadcast.
MOST_CODES = 100_000


def active(history: DataFrame) -> DataFrame:
    return history.where("valid_to is null")


def versions(history: DataFrame, key: str, value: object) -> DataFrame:
    """Of one key, oldest first."""
    return history.where(F.col(key) == F.lit(value)).orderBy("valid_from")


def as_of(history: DataFrame, at: object) -> DataFrame:
    """What held at a moment; intervals hold their start, not their end."""
    t = at if isinstance(at, Column) else F.lit(at)
    return history.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def version_counts(history: DataFrame) -> DataFrame:
    open_ = F.count_if(F.col("valid_to").isNull()).cast("long")
    return history.agg(F.count(F.lit(1)).alias("total"), open_.alias("active"), (F.count(F.lit(1)) - open_).alias("historical"))


def _small(lookup: DataFrame) -> DataFrame:
    return F.broadcast(lookup) if lookup.limit(MOST_CODES + 1).count() <= MOST_CODES else lookup


def with_label(entities: DataFrame, field: str, lookup: DataFrame, name: str = "label") -> DataFrame:
    """entities and the label of a coded field; unknown codes stay, without one."""
    side = lookup.select(F.col("code").alias("_code"), F.col("label").alias(name))
    return entities.join(_small(side), F.col(field) == F.col("_code"), "left").drop("_code")


def with_labels(entities: DataFrame, key: str, junction: DataFrame, lookup: DataFrame, name: str = "labels", separator: str = ", ") -> DataFrame:
    """Per entity its open option labels, joined in their order; entities without options stay, with null."""
    links = junction.where("valid_to is null").select(F.col("entity_id").alias("_id"), "option_code")
    told = links.join(_small(lookup.select("code", "label")), F.col("option_code") == F.col("code"), "left")
    listed = told.groupBy("_id").agg(F.array_sort(F.collect_list("label")).alias("_labels"))
    listed = listed.select("_id", F.when(F.size("_labels") > 0, F.array_join("_labels", separator)).alias(name))
    return entities.join(listed, F.col(key).cast("string") == F.col("_id").cast("string"), "left").drop("_id")


def active_codes(junction: DataFrame, entity: object) -> DataFrame:
    return active(junction).where(F.col("entity_id") == F.lit(entity)).select("option_code").orderBy("option_code")


def snapshots(history: DataFrame, junction: DataFrame, key: str) -> DataFrame:
    """Each entity version with the options recorded at its start."""
    side = junction.select("entity_id", "option_code", F.col("valid_from").alias("_from"), F.col("valid_to").alias("option_valid_to"))
    return history.join(side, (F.col(key) == F.col("entity_id")) & (F.col("valid_from") == F.col("_from"))).drop("_from", "entity_id")


def distinct_values(table: DataFrame, column: str, name: str = "id") -> DataFrame:
    return table.where(F.col(column).isNotNull()).select(F.col(column).alias(name)).distinct()


def union_values(tables: list[tuple[DataFrame, str]], name: str = "id") -> DataFrame:
    """Distinct non-null values of several columns, as strings; each column is made distinct before the union's shuffle."""
    each = [t.where(F.col(c).isNotNull()).select(F.col(c).cast("string").alias(name)) for t, c in tables]
    out = each[0]
    for x in each[1:]:
        out = out.unionByName(x)
    return out.distinct()
