"""Schemas of existing databases: tables of the store, and PostgreSQL by JDBC (#13, #14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Column, ForeignKey, TableSchema
from .store import Store

#: Spark types as the store's database types.
STORED_AS = {"string": "TEXT", "bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "boolean": "INTEGER", "double": "REAL", "binary": "BLOB"}


def store_schemas(store: Store) -> dict[str, TableSchema]:
    out = {}
    for name in store.tables():
        fields = store.state(name).schema().fields
        columns = [Column(f.name, STORED_AS.get(f.dataType.simpleString(), "TEXT"), (f.metadata or {}).get("edm_type") or "", f.nullable) for f in fields]
        out[name] = TableSchema(name, columns, "row_id" if any(f.name == "row_id" for f in fields) else None)
    return out


def postgres_tables(spark: SparkSession, url: str, **options: str) -> dict[str, DataFrame]:
    """The views of information_schema that a schema is read from."""
    names = ("columns", "table_constraints", "key_column_usage", "constraint_column_usage")
    return {n: spark.read.format("jdbc").options(url=url, dbtable=f"information_schema.{n}", **options).load() for n in names}


def postgres_schemas(views: dict[str, DataFrame], schema: str = "public") -> dict[str, TableSchema]:
    """Tables, columns, primary and foreign keys; joins of small catalogue views, collected."""
    cols = views["columns"].where(F.col("table_schema") == schema).orderBy("table_name", "ordinal_position")
    out: dict[str, TableSchema] = {}
    for r in cols.select("table_name", "column_name", "data_type", "is_nullable", "character_maximum_length").collect():
        out.setdefault(r[0], TableSchema(r[0])).columns.append(Column(r[1], r[2].upper(), "", r[3] == "YES", r[4]))
    # names of constraints are unique within a table only
    own = ["constraint_name", "table_name"]
    held = views["table_constraints"].where(F.col("table_schema") == schema).select(*own, "constraint_type")
    used = held.join(views["key_column_usage"].where(F.col("table_schema") == schema).select(*own, "column_name", "ordinal_position", "position_in_unique_constraint"), own)
    for r in used.where("constraint_type = 'PRIMARY KEY'").orderBy("table_name", "ordinal_position").collect():
        if r["table_name"] in out and out[r["table_name"]].primary_key is None:
            out[r["table_name"]].primary_key = r["column_name"]
    # of a key of several columns each refers to the one in its place of the target's key
    keys = used.where("constraint_type in ('PRIMARY KEY', 'UNIQUE')").select(F.col("table_name").alias("to_table"), F.col("column_name").alias("to_column"), F.col("ordinal_position").alias("place"))
    target = views["constraint_column_usage"].select("constraint_name", F.col("table_name").alias("to_table"), F.col("column_name").alias("to_column")).distinct()
    placed = target.join(keys.distinct(), ["to_table", "to_column"], "left")
    found = used.where("constraint_type = 'FOREIGN KEY'").join(placed, "constraint_name")
    found = found.where("position_in_unique_constraint is null or place is null or position_in_unique_constraint = place")
    for r in found.select("table_name", "column_name", "to_table", "to_column", "ordinal_position").distinct().orderBy("table_name", "ordinal_position", "to_table", "to_column").collect():
        if r["table_name"] in out:
            out[r["table_name"]].foreign_keys.append(ForeignKey(r["column_name"], r["to_table"], r["to_column"]))
    return out
