"""Entity schemas from an OData CSDL document, and foreign keys by rule (#5, #22a-#22h)."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types_map import db_type
from ..model import METADATA, Column, ForeignKey, TableSchema, local_frame

#: Fixed values.
EDM_NAMESPACE = "{http://docs.oasis-open.org/odata/ns/edm}"
NO_REFERENCE = "versionnumber"


def read_document(spark: SparkSession, path: str) -> str:
    """The metadata document, from any file system that Spark reads."""
    return spark.read.text(path, wholetext=True).first()[0]


def inferred_key(name: str, primary_key: str | None) -> ForeignKey | None:
    """`_x_value` refers to x.xid; any other column in `...id`, but the key itself, to the table before the `id`."""
    low = name.lower()
    if low.startswith("_") and low.endswith("_value"):
        return ForeignKey(name, name[1:-6], f"{name[1:-6]}id")
    if low.endswith("id") and name not in (primary_key, NO_REFERENCE):
        return ForeignKey(name, name[:-2], name)
    return None


def inferred_keys(columns: DataFrame, navigation: DataFrame | None = None) -> DataFrame:
    """columns(entity, column, primary_key) -> entity, column, referenced_table, referenced_column, by the same rule, set-based; columns that navigation(entity, column, ...) covers keep that."""
    low = F.lower("column")
    lookup = F.startswith(low, F.lit("_")) & F.endswith(low, F.lit("_value"))
    plain = F.endswith(low, F.lit("id")) & ~F.col("column").eqNullSafe(F.col("primary_key")) & (F.col("column") != NO_REFERENCE)
    base = F.expr("substring(column, 2, greatest(length(column) - 7, 0))")
    found = columns.where(lookup | plain).select(
        "entity", "column",
        F.when(lookup, base).otherwise(F.expr("substring(column, 1, length(column) - 2)")).alias("referenced_table"),
        F.when(lookup, F.concat(base, F.lit("id"))).otherwise(F.col("column")).alias("referenced_column"),
    )
    if navigation is None:
        return found
    return navigation.select("entity", "column", "referenced_table", "referenced_column").unionByName(found.join(navigation, ["entity", "column"], "left_anti"))


def _entity(element: ET.Element, dialect: str, option_fields: frozenset[str]) -> TableSchema:
    tag = lambda x: EDM_NAMESPACE + x
    schema = TableSchema(element.get("Name"))
    ref = element.find(f"{tag('Key')}/{tag('PropertyRef')}")
    schema.primary_key = None if ref is None else ref.get("Name")
    for p in element.findall(tag("Property")):
        name, kind = p.get("Name"), p.get("Type", "Edm.String")
        length = p.get("MaxLength", "")
        size = int(length) if length.isdigit() else None
        schema.columns.append(Column(name, db_type(kind, dialect, size, name in option_fields), kind, p.get("Nullable", "true").lower() != "false", size))
    for nav in element.findall(tag("NavigationProperty")):
        rule = nav.find(tag("ReferentialConstraint"))
        if rule is None or not rule.get("Property") or not rule.get("ReferencedProperty"):
            continue
        target = nav.get("Type", "").removeprefix("Collection(").removesuffix(")").rpartition(".")[2]
        if target:
            schema.foreign_keys.append(ForeignKey(rule.get("Property"), target, rule.get("ReferencedProperty")))
    known = {fk.column for fk in schema.foreign_keys}
    schema.foreign_keys += [fk for c in schema.columns if c.name not in known and (fk := inferred_key(c.name, schema.primary_key))]
    return schema


def parse(document: str, dialect: str = "sqlite", option_sets: Mapping[str, Iterable[str]] | None = None) -> dict[str, TableSchema]:
    """Entity name -> schema; abstract entities are left out. Raises ValueError for a document that is no XML."""
    try:
        root = ET.fromstring(document)
    except ET.ParseError as e:
        raise ValueError(f"Failed to parse metadata XML: {e}") from e
    options = {k: frozenset(v) for k, v in (option_sets or {}).items()}
    return {
        e.get("Name"): _entity(e, dialect, options.get(e.get("Name"), frozenset()))
        for e in root.iter(f"{EDM_NAMESPACE}EntityType")
        if e.get("Name") and e.get("Abstract", "false").lower() != "true"
    }


def requested(schemas: dict[str, TableSchema], names: Iterable[str]) -> tuple[dict[str, TableSchema], list[str]]:
    """(the schemas asked for, the names that the metadata lack)."""
    wanted = list(names)
    return {n: schemas[n] for n in wanted if n in schemas}, [n for n in wanted if n not in schemas]


def column_table(spark: SparkSession, schemas: Mapping[str, TableSchema]) -> DataFrame:
    return local_frame(spark, [(n, c.name, c.edm_type, c.db_type, c.nullable, c.max_length) for n, s in schemas.items() for c in s.columns], METADATA)


def key_table(spark: SparkSession, schemas: Mapping[str, TableSchema]) -> DataFrame:
    return local_frame(spark, [(n, s.primary_key) for n, s in schemas.items()], "entity string, primary_key string")


def reference_table(spark: SparkSession, schemas: Mapping[str, TableSchema]) -> DataFrame:
    rows = [(n, fk.column, fk.referenced_table, fk.referenced_column, i) for n, s in schemas.items() for i, fk in enumerate(s.foreign_keys)]
    return local_frame(spark, rows, "entity string, column string, referenced_table string, referenced_column string, seq int")
