"""CSV export of a sampled, closed set of tables, and its diagram (#19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .closure import connected

HIDDEN = "json_response"


def sample(table: DataFrame, rows: int, seed: int, key: str) -> DataFrame:
    """A reproducible sample of `rows` rows: the smallest seeded hashes of the key. The limit is what is asked for."""
    return table.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(rows)


def closed_sample(tables: dict[str, DataFrame], keys: dict[str, str], edges: list[tuple[str, str, str, str]], start: str, rows: int, seed: int) -> dict[str, DataFrame]:
    """A sample of `start` with all rows that references connect with it, either way and through others, until nothing is new."""
    return connected(tables, keys, edges, {start: sample(tables[start], rows, seed, keys[start])})


def write_csv(tables: dict[str, DataFrame], folder: str) -> None:
    for name, t in tables.items():
        t.drop(HIDDEN).write.mode("errorifexists").option("header", True).csv(f"{folder.rstrip('/')}/{name}")


def diagram(edges: list[tuple[str, str, str, str]]) -> str:
    """The edges as a Mermaid entity-relationship diagram."""
    return "\n".join(["erDiagram", *sorted({f'    {d} ||--o{{ {s} : "{c}"' for s, c, d, _ in edges})])
