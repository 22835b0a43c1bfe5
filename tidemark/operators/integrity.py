"""Referential integrity over all versions of all tables (#52-#54).

References that no version of the target holds dangle; null references do not count.  Anti joins are
written as such.  Edges of one table and column to several targets (a polymorphic reference) dangle only if no
target holds the value; compat counts each target alone.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 10


def dangling(source: DataFrame, fk: str, targets: list[tuple[DataFrame, str]]) -> DataFrame:
    """fk_value, n: the values of source.fk that no target holds, and their rows. Values are summed before the join, so a hot value is one row in it."""
    values = source.where(F.col(fk).isNotNull()).groupBy(F.col(fk).cast("string").alias("fk_value")).agg(F.count(F.lit(1)).alias("n"))
    for table, key in targets:
        keys = table.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_key")).distinct()
        values = values.join(keys, values["fk_value"] == keys["_key"], "left_anti")
    return values


def report(tables: dict[str, DataFrame], edges: list[tuple[str, str, str, str]], compat: bool = False) -> tuple[DataFrame | None, int, list[tuple[str, str, str, str]]]:
    """(src_table, fk_col, dst_table, dangling_count, total_checked, samples per dangling edge; number of edges checked; edges whose table or column is missing)."""
    usable, missing = [], []
    for e in edges:
        s, c, d, k = e
        ok = s in tables and d in tables and c in tables[s].columns and k in tables[d].columns
        (usable if ok else missing).append(e)
    sorted_edges = sorted(usable, key=lambda e: (e[0], e[1]))
    grouped = [[e] for e in usable] if compat else [list(g) for _, g in groupby(sorted_edges, key=lambda e: (e[0], e[1]))]
    out = None
    for table in dict.fromkeys(g[0][0] for g in grouped):
        rows = _of_table(tables, [g for g in grouped if g[0][0] == table])
        out = rows if out is None else out.unionByName(rows)
    return out, len(edges), missing


def _of_table(tables: dict[str, DataFrame], groups: list[list[tuple[str, str, str, str]]]) -> DataFrame:
    """The report's rows of one source table: its columns are read in one scan and summed by value before they meet the keys of their targets."""
    source = tables[groups[0][0][0]]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("edge"), F.col(g[0][1]).cast("string").alias("fk_value")) for i, g in enumerate(groups)])).alias("x")
    values = source.select(each).select("x.*").where("fk_value is not null").groupBy("edge", "fk_value").agg(F.count(F.lit(1)).alias("n"))
    keys = None
    for i, g in enumerate(groups):
        for _, _, d, k in g:
            own = tables[d].where(F.col(k).isNotNull()).select(F.lit(i).alias("edge"), F.col(k).cast("string").alias("fk_value"))
            keys = own if keys is None else keys.unionByName(own)
    bad = values.join(keys.distinct(), ["edge", "fk_value"], "left_anti")
    totals = values.groupBy("edge").agg(F.sum("n").alias("total_checked"))
    # the smallest values: a group limit before the shuffle, not all of them collected
    turn = F.row_number().over(Window.partitionBy("edge").orderBy("fk_value"))
    first = bad.withColumn("turn", turn).where(F.col("turn") <= SAMPLES).groupBy("edge").agg(F.sort_array(F.collect_list("fk_value")).alias("samples"))
    names = F.create_map(*[F.lit(x) for i, g in enumerate(groups) for x in (i, f"{g[0][1]}\t{','.join(d for _, _, d, _ in g)}")])
    name = F.split(names[F.col("edge")], "\t")
    rows = bad.groupBy("edge").agg(F.sum("n").alias("dangling_count")).join(totals, "edge").join(first, "edge")
    return rows.select(F.lit(groups[0][0][0]).alias("src_table"), name[0].alias("fk_col"), name[1].alias("dst_table"), "dangling_count", "total_checked", "samples")


def grouped(edges: list[tuple[str, str, str, str]]) -> dict[str, list[tuple[str, str, str, str]]]:
    """Edges by what refers, `table.column`: those of one column to several targets are one reference."""
    out: dict[str, list[tuple[str, str, str, str]]] = {}
    for e in sorted(dict.fromkeys(edges)):
        out.setdefault(f"{e[0]}.{e[1]}", []).append(e)
    return out


def followed_up(dangling: DataFrame, references: DataFrame, keys: DataFrame, held: DataFrame) -> DataFrame:
    """edge, fk_value, n of what dangles after a batch, from what dangled before.

    dangling: edge, fk_value, n as it was; references: the same of the batch's new rows; keys: edge, fk_value that the batch's rows
    hold as targets; held: edge, fk_value of those of `references` that a target holds.  Versions stay, so a value that is held once is held for good,
    and one that never was is among `dangling` already: nothing else need be read.
    """
    on = ["edge", "fk_value"]
    left = dangling.join(keys.distinct(), on, "left_anti").unionByName(references.join(held.distinct(), on, "left_anti"))
    return left.groupBy(*on).agg(F.sum("n").alias("n"))


def told(dangling: DataFrame, totals: DataFrame, edges: dict[str, list[tuple[str, str, str, str]]]) -> list[dict]:
    """The report's rows of what followed_up keeps: at most one a reference."""
    turn = F.row_number().over(Window.partitionBy("edge").orderBy("fk_value"))
    first = dangling.withColumn("turn", turn).where(F.col("turn") <= SAMPLES).groupBy("edge").agg(F.sort_array(F.collect_list("fk_value")).alias("samples"))
    rows = dangling.groupBy("edge").agg(F.sum("n").alias("dangling_count")).join(totals.select("edge", F.col("n").alias("total_checked")), "edge").join(first, "edge")
    out = {r["edge"]: r for r in rows.collect()}
    return [{"src_table": g[0][0], "fk_col": g[0][1], "dst_table": ",".join(e[2] for e in g), **{c: out[n][c] for c in ("dangling_count", "total_checked", "samples")}} for n, g in edges.items() if n in out]


def report_text(rows: list, checks: int, shown: int = 5) -> str:
    """The report of collected rows, at most one an edge."""
    if not rows:
        return f"All references hold ({checks} checked)."
    lines = [f"{len(rows)} reference(s) dangle:"]
    for r in rows:
        lines.append(f"- {r['src_table']}.{r['fk_col']} -> {r['dst_table']}: {r['dangling_count']} of {r['total_checked']} rows; for example {', '.join(r['samples'][:shown])}")
    return "\n".join(lines)
