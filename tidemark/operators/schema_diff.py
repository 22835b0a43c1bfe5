"""Differences between expected and actual schemas, set-based on tables of metadata (#22i-#22s)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.types_map import normal_type_col
from ..model import SYSTEM_COLUMNS, TableSchema, local_frame


def _issue(entity: Column, kind: str, severity: str, description: Column, /, **details: Column) -> list[Column]:
    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in details.items()]), lambda e: e["v"].isNotNull())
    return [entity.alias("entity"), F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), description.alias("description"), F.map_from_entries(entries).alias("details")]


def _exploded(rows: DataFrame, *issues: tuple[Column, list[Column]]) -> DataFrame:
    """One row for each issue whose condition holds: the rows are read once, whatever the number of issues."""
    found = F.filter(F.array(*[F.when(when, F.struct(*issue)) for when, issue in issues]), lambda x: x.isNotNull())
    return rows.select(F.explode(found).alias("x")).select("x.*")


def _says(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def table_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """expected(entity), actual(entity): tables yet to be made (info) and tables that nothing expects (warning)."""
    e, a = expected.select("entity").distinct(), actual.select("entity").distinct()
    missing = e.join(a, "entity", "left_anti").select(*_issue(F.col("entity"), "missing_table", "info", _says("Table '", F.col("entity"), "' not in the store"), entity=F.col("entity")))
    extra = a.join(e, "entity", "left_anti").select(*_issue(F.col("entity"), "extra_table", "warning", _says("Table '", F.col("entity"), "' is not in the metadata"), entity=F.col("entity")))
    return missing.unionByName(extra)


def column_differences(expected: DataFrame, actual: DataFrame, dialect: str = "sqlite") -> DataFrame:
    """Columns of entities that both sides have, matched whatever their case: one full join, one row an issue."""
    both = expected.select("entity").intersect(actual.select("entity"))
    pick = lambda d, p: d.join(F.broadcast(both), "entity", "left_semi").select("entity", F.lower("column").alias("_low"), F.struct("column", "db_type", "edm_type" if "edm_type" in d.columns else F.lit(None).cast("string").alias("edm_type"), "nullable").alias(p))
    j = pick(expected, "e").join(pick(actual, "a"), ["entity", "_low"], "full_outer")
    e, a, n = F.col("e"), F.col("a"), F.col("entity")
    e_norm, a_norm = normal_type_col(e["db_type"], dialect), normal_type_col(a["db_type"], dialect)
    here = e.isNotNull() & a.isNotNull()
    return _exploded(
        j,
        (a.isNull(), _issue(n, "missing_column", "info", _says("Column '", e["column"], "' missing in the store"), column_name=e["column"], expected_type=e["db_type"], edm_type=e["edm_type"])),
        (e.isNull(), _issue(n, "extra_column", "warning", _says("Column '", a["column"], "' is not in the metadata"), column_name=a["column"], actual_type=a["db_type"])),
        (here & (e_norm != a_norm), _issue(n, "type_mismatch", "error", _says("Column '", e["column"], "' is stored as another type"), column_name=e["column"], expected_type=e["db_type"], actual_type=a["db_type"], expected_normalized=e_norm, actual_normalized=a_norm, edm_type=e["edm_type"])),
        (here & (e["nullable"] != a["nullable"]), _issue(n, "nullable_mismatch", "warning", _says("Column '", e["column"], "' differs in whether it may be null"), column_name=e["column"], expected_nullable=e["nullable"], actual_nullable=a["nullable"])),
    )


def key_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """entity, primary_key of both sides: errors where they differ, whatever their case; null equals null."""
    j = expected.join(actual.select("entity", F.col("primary_key").alias("actual_key")), "entity").where(~F.lower("primary_key").eqNullSafe(F.lower("actual_key")))
    return j.select(*_issue(F.col("entity"), "pk_mismatch", "error", F.lit("The stored key is another column"), expected_pk=F.col("primary_key"), actual_pk=F.col("actual_key")))


def reference_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Foreign keys by column, the last of a column counts; for entities that both sides have."""

    def last(d: DataFrame, name: str) -> DataFrame:
        seq = F.col("seq") if "seq" in d.columns else F.lit(0)
        return d.groupBy("entity", F.lower("column").alias("_low")).agg(F.max_by(F.struct("column", "referenced_table", "referenced_column"), seq).alias(name))

    j = last(expected, "e").join(last(actual, "a"), ["entity", "_low"], "full_outer")
    e, a, n = F.col("e"), F.col("a"), F.col("entity")
    to = lambda x: F.concat(x["referenced_table"], F.lit("."), x["referenced_column"])
    return _exploded(
        j,
        (a.isNull(), _issue(n, "fk_missing", "info", _says("Column '", e["column"], "' has no foreign key constraint"), column=e["column"], expected_references=to(e))),
        (e.isNotNull() & a.isNotNull() & (F.lower(to(e)) != F.lower(to(a))), _issue(n, "fk_mismatch", "warning", _says("Foreign key on column '", e["column"], "' refers elsewhere"), column=e["column"], expected_references=to(e), actual_references=to(a))),
        (e.isNull(), _issue(n, "fk_extra", "info", _says("Extra foreign key on column '", a["column"], "'"), column=a["column"], actual_references=to(a))),
    )


def compare(spark, expected: dict[str, TableSchema], actual: dict[str, TableSchema], dialect: str = "sqlite") -> DataFrame:
    """All differences: tables, then columns, keys and foreign keys of the entities that both have."""
    from ..sources.metadata import column_table, key_table, reference_table

    names = lambda s: local_frame(spark, [(n,) for n in s], "entity string")
    common = [n for n in expected if n in actual]
    e, a = {n: expected[n] for n in common}, {n: actual[n] for n in common}
    return (
        table_differences(names(expected), names(actual))
        .unionByName(column_differences(column_table(spark, e), column_table(spark, a), dialect))
        .unionByName(key_differences(key_table(spark, e), key_table(spark, a)))
        .unionByName(reference_differences(reference_table(spark, e), reference_table(spark, a)))
    )


def without_system_columns(schema: TableSchema, expected_key: str | None = None, entity: str | None = None) -> TableSchema:
    """The stored schema as its source would have it; a surrogate key gives way to the expected one, else `{entity}id`, else none."""
    own = [c for c in schema.columns if c.name not in SYSTEM_COLUMNS]
    names = {c.name for c in own}
    key = schema.primary_key
    if key in SYSTEM_COLUMNS:
        key = next((k for k in (expected_key, f"{entity}id" if entity else None) if k and k in names), None)
    return replace(schema, columns=own, primary_key=key)


def with_real_key(expected: TableSchema, actual: TableSchema, entity: str) -> TableSchema:
    """A declared key that is no column gives way to `{entity}id` where the store uses that already."""
    own = f"{entity}id"
    if expected.primary_key and not expected.has(expected.primary_key) and actual.primary_key == own:
        return replace(expected, primary_key=own)
    return expected


def passes(differences: DataFrame) -> bool:
    return differences.where("severity = 'error'").isEmpty()


def gate(spark, expected: dict[str, TableSchema], actual: dict[str, TableSchema], entities: list, dialect: str = "sqlite") -> tuple[list, list, DataFrame, bool]:
    """Before a sync: (entities that can be synced, those whose table must be made, differences, whether no error is among them).

    Names of tables are the entities' api_name; expected must have been parsed with the same coded fields that the tables were made with.
    """
    valid = [e for e in entities if e.name in expected]
    unknown = local_frame(spark, [(e.name,) for e in entities if e.name not in expected], "entity string")
    to_create = [e for e in valid if e.api_name not in actual]
    want, have = {}, {}
    for e in valid:
        if e.api_name in actual:
            seen = without_system_columns(actual[e.api_name], expected[e.name].primary_key, e.name)
            # stored tables declare no foreign keys, so none are compared
            want[e.api_name] = replace(with_real_key(expected[e.name], seen, e.name), foreign_keys=[])
            have[e.api_name] = replace(seen, foreign_keys=[])
    found = compare(spark, want, have, dialect).unionByName(
        unknown.select(*_issue(F.col("entity"), "missing_in_metadata", "warning", _says("Entity '", F.col("entity"), "' is not in the metadata"), entity=F.col("entity")))
    )
    new = local_frame(spark, [(e.api_name,) for e in to_create], "entity string")
    found = found.unionByName(new.select(*_issue(F.col("entity"), "new_entity", "info", _says("Table '", F.col("entity"), "' will be made"), entity=F.col("entity"))))
    return valid, to_create, found, passes(found)


def option_set_config(lookups: DataFrame, columns: DataFrame) -> DataFrame:
    """lookups(field), columns(entity, column, db_type) -> entity, fields: for each table its integer columns that have a lookup, sorted."""
    hits = columns.where(F.upper("db_type").isin("INTEGER", "BIGINT", "INT")).join(F.broadcast(lookups.select(F.col("field").alias("column")).distinct()), "column", "left_semi")
    return hits.groupBy("entity").agg(F.sort_array(F.collect_set("column")).alias("fields"))


def summary(differences: DataFrame) -> DataFrame:
    return differences.groupBy("severity", "issue_type").agg(F.count(F.lit(1)).alias("n"))
