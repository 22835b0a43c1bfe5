"""Watermarks, incremental filters, key resolution and the split into new and known ids (#39-#49)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import TableSchema

#: Keys up to this many are broadcast in semi and anti joins.
MOST_IDS = 1_000_000
IDS_A_REQUEST = 50


def watermark(batch: DataFrame, column: str = "modifiedon") -> DataFrame:
    """last_timestamp (largest non-empty, as it is compared: a string, or a time) and records_count of this batch."""
    value = F.col(column)
    kept = F.when(value.cast("string") != "", value)
    return batch.agg(F.max(kept).alias("last_timestamp"), F.count(F.lit(1)).alias("records_count"))


def since(rows: DataFrame, mark: object | None, column: str = "modifiedon") -> DataFrame:
    """Rows strictly after the watermark; all without one or without the column. Pushed down to the scan."""
    if mark is None or column not in rows.columns:
        return rows
    return rows.where(F.col(column) > F.lit(mark))


def order_column(schema: TableSchema) -> str | None:
    """By what to page: the key, else createdon, else modifiedon, else nothing."""
    if schema.primary_key:
        return schema.primary_key
    return next((c for c in ("createdon", "modifiedon") if schema.has(c)), None)


def resolve_key(schema: TableSchema, name: str, record: dict | None = None, required: bool = True) -> str | None:
    """The business key: declared and present, else `{name}id`, else the same in a record, else the first `...id` column.

    A key that only a record has, but no column, is refused at once.
    """
    own = f"{name}id"
    if schema.primary_key and schema.has(schema.primary_key):
        return schema.primary_key
    if schema.has(own):
        return own
    if record is not None and own in record:
        raise ValueError(f"Entity {name}: the key {own} is in its records, but no column of its table")
    found = next((c.name for c in schema.columns if c.name.lower().endswith("id") and not c.name.startswith("_")), None)
    if found is None and required:
        raise ValueError(f"Entity {name}: no key column")
    return found


def _side(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.limit(MOST_IDS + 1).count() <= MOST_IDS else ids


def split_ids(ids: DataFrame, stored: DataFrame, key: str, has_watermark: bool = True, column: str = "id") -> tuple[DataFrame, DataFrame]:
    """(ids that the table lacks, ids that it has), compared as strings. Without a watermark all are new."""
    wanted = ids.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias(column)).distinct()
    if not has_watermark:
        return wanted, wanted.limit(0)
    known = _side(stored.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_id")).distinct())
    on = wanted[column] == known["_id"]
    return wanted.join(known, on, "left_anti"), wanted.join(known, on, "left_semi")


def fetch_by_ids(source: DataFrame, key: str, new: DataFrame, existing: DataFrame, mark: object | None, modified: str = "modifiedon", column: str = "id") -> DataFrame:
    """Rows of the wanted ids: all of the new ones, of the existing ones those after the watermark."""
    k = source[key].cast("string")
    fresh = source.join(_side(new), k == new[column], "left_semi")
    changed = since(source, mark, modified)
    return fresh.unionByName(changed.join(_side(existing), changed[key].cast("string") == existing[column], "left_semi"))


def id_filters(key: str, ids: list[str], mark: str | None = None, size: int = IDS_A_REQUEST) -> list[str]:
    """Request filters for a remote source, `size` ids each."""
    out = []
    for a in range(0, len(ids), size):
        any_of = " or ".join(f"{key} eq '{i.replace(chr(39), chr(39) * 2)}'" for i in ids[a : a + size])
        out.append(f"({any_of}) and modifiedon gt {mark}" if mark else any_of)
    return out
