"""Relationship edges and the closure of filtered entities over them (#46, #50, #51)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import EntityConfig, TableSchema
from ..sources.store import checkpointed

ROUNDS = 5


def edges(schemas: dict[str, TableSchema], entities: Iterable[EntityConfig]) -> tuple[list[tuple[str, str, str, str]], list[tuple[str, str, str, str]]]:
    """(src_table, fk_col, dst_table, dst_col) of every key between configured entities, and the edges dropped because the source table lacks the column."""
    tables = {e.name.lower(): e.api_name for e in entities}
    kept, dropped = [], []
    for name, schema in schemas.items():
        if name.lower() not in tables:
            continue
        for fk in schema.foreign_keys:
            if fk.referenced_table.lower() in tables:
                edge = (tables[name.lower()], fk.column, tables[fk.referenced_table.lower()], fk.referenced_column)
                (kept if schema.has(fk.column) else dropped).append(edge)
    return list(dict.fromkeys(kept)), list(dict.fromkeys(dropped))


def referencing(found: list[tuple[str, str, str, str]], table: str) -> list[tuple[str, str]]:
    """(table, column) of all that refer to the table."""
    return [(s, c) for s, c, d, _ in found if d == table]


def referenced_by(found: list[tuple[str, str, str, str]], table: str) -> list[tuple[str, str]]:
    return [(d, k) for s, _, d, k in found if s == table]


def referenced_ids(tables: dict[str, DataFrame], found: list[tuple[str, str, str, str]], table: str) -> DataFrame | None:
    """id: distinct non-null references to the table, from all versions of all rows, as strings."""
    each = [tables[s].where(F.col(c).isNotNull()).select(F.col(c).cast("string").alias("id")).distinct() for s, c in referencing(found, table) if s in tables]
    if not each:
        return None
    out = each[0]
    for x in each[1:]:
        out = out.unionByName(x)
    return out.distinct()


def closure(
    tables: dict[str, DataFrame],
    filtered: dict[str, tuple[DataFrame, str]],
    found: list[tuple[str, str, str, str]],
    rounds: int = ROUNDS,
    fetch: Callable[[str, DataFrame], DataFrame] | None = None,
) -> tuple[dict[str, DataFrame], bool]:
    """(the filtered tables restricted to the rows that others refer to, directly or through one another; whether nothing was left to fetch).

    filtered: name -> (source, key).  Each round asks only for ids not asked for before, so cycles end;
    frontiers and results are checkpointed, so the plan does not grow with the rounds.
    """
    have = dict(tables)
    done: dict[str, DataFrame] = {}
    parts: dict[str, DataFrame] = {}
    for _ in range(rounds):
        moved = False
        for name, (source, key) in filtered.items():
            ids = referenced_ids(have, found, name)
            if ids is None:
                continue
            if name in done:
                ids = ids.join(done[name], "id", "left_anti")
            ids = checkpointed(ids)
            if ids.isEmpty():
                continue
            moved = True
            done[name] = done[name].unionByName(ids) if name in done else ids
            rows = fetch(name, ids) if fetch else source.join(ids, source[key].cast("string") == ids["id"], "left_semi")
            rows = checkpointed(rows)
            parts[name] = parts[name].unionByName(rows) if name in parts else rows
            have[name] = parts[name]
        if not moved:
            return {n: parts.get(n, s.limit(0)) for n, (s, _) in filtered.items()}, True
    left = False
    for name in filtered:
        ids = referenced_ids(have, found, name)
        if ids is not None:
            rest = ids.join(done[name], "id", "left_anti") if name in done else ids
            left = left or not rest.isEmpty()
    return {n: parts.get(n, s.limit(0)) for n, (s, _) in filtered.items()}, not left


def connected(tables: dict[str, DataFrame], keys: dict[str, str], found: list[tuple[str, str, str, str]], start: dict[str, DataFrame], outward: bool = True, inward: bool = True) -> dict[str, DataFrame]:
    """The rows of all tables that references connect with those of `start`, to the fixpoint: inward the rows that a row refers to, outward those that refer to it.

    Every edge is followed, also several between two tables, and from a table to itself; cycles end, as a round asks only about the rows
    that the round before brought.  keys: what tells a table's rows apart; the rows of a table without a key are told apart by all
    their columns.  Rows of tables that lead no further are not made here but where they are read.  A round reads a table once for all its edges, and only tables that an edge joins to new rows; values meet
    as distinct (edge, value) pairs, so a value that many rows share is one row in the join.
    """
    edges = [e for e in found if e[0] in tables and e[2] in tables]

    def with_id(name: str, rows: DataFrame) -> DataFrame:
        whole = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
        return rows.withColumn("_id", F.col(keys[name]).cast("string") if keys.get(name) else whole)

    def values(rows: DataFrame, number: int, column: str) -> DataFrame:
        return rows.select(F.lit(number).alias("edge"), F.col(column).cast("string").alias("value")).where("value is not null")

    def ids(name: str) -> DataFrame:
        """_id of the table's rows so far, made when the table is asked again."""
        for part in late.pop(name, []):
            told = with_id(name, part).select("_id").distinct()
            done[name] = done[name].unionByName(told) if name in done else told
        done[name] = checkpointed(done[name])
        return done[name]

    fresh = {n: checkpointed(t.select(*tables[n].columns)) for n, t in start.items()}
    done: dict[str, DataFrame] = {}
    late = {n: [t] for n, t in fresh.items()}
    parts = dict(fresh)
    while fresh:
        brought = {}
        for name in tables:
            sides = []
            for i, (s, c, d, k) in enumerate(edges):
                sides += ([(2 * i, c, d, k)] if outward and s == name and d in fresh else []) + ([(2 * i + 1, k, s, c)] if inward and d == name and s in fresh else [])
            if not sides:
                continue
            if not keys.get(name) and len(sides) == 1:
                # rows that are equal have equal values: they meet these as they are, in one shuffle
                number, own, other, theirs = sides[0]
                asked = values(fresh[other], number, theirs).select("value").distinct()
                rows = tables[name]
                if name in parts:
                    rows = with_id(name, rows).join(ids(name), "_id", "left_anti").drop("_id")
                new = rows.join(asked, F.col(own).cast("string") == asked["value"], "left_semi")
            else:
                asked, columns = None, []
                for number, own, other, theirs in sides:
                    columns.append(F.struct(F.lit(number).alias("edge"), F.col(own).cast("string").alias("value")))
                    wanted = values(fresh[other], number, theirs)
                    asked = wanted if asked is None else asked.unionByName(wanted)
                rows = whole = with_id(name, tables[name])
                if name in parts:
                    rows = whole.join(ids(name), "_id", "left_anti")
                met = rows.select("_id", F.explode(F.array(*columns)).alias("x")).select("_id", "x.edge", "x.value").join(asked.distinct(), ["edge", "value"], "left_semi")
                new = whole.join(met.select("_id").distinct(), "_id", "left_semi").drop("_id")
            if not any(outward and d == name or inward and s == name for s, _, d, _ in edges):
                # no round asks about these rows, so they are left to the plan of who reads them, with the columns that this needs
                parts[name] = parts[name].unionByName(new) if name in parts else new
                late.setdefault(name, []).append(new)
                continue
            new = checkpointed(new)
            if not new.isEmpty():
                brought[name] = new
        for name, new in brought.items():
            late.setdefault(name, []).append(new)
            parts[name] = parts[name].unionByName(new) if name in parts else new
        fresh = brought
    return {n: parts[n] if n in parts else t.limit(0) for n, t in tables.items()}


def reverse_closure(tables: dict[str, DataFrame], found: list[tuple[str, str, str, str]], start: str, rows: DataFrame) -> dict[str, DataFrame]:
    """Rows of all tables that refer to the given rows of `start`, directly or through others, over every key."""
    got = connected({start: rows, **tables}, {d: k for _, _, d, k in found}, found, {start: rows}, inward=False)
    reached = {start}
    while more := {s for s, _, d, _ in found if d in reached and s in tables} - reached:
        reached |= more
    return {n: got[n] for n in got if n in reached}
