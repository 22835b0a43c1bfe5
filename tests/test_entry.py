"""Every registered query of the engine's own operators against its SQL, and the entry module without the optional part."""

import glob
import math
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tidemark.plans import catalogue

DATA = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parent.parent


def rows(frame, columns):
    def plain(v):
        if pd.isna(v):
            return "~"
        return f"{v:.6g}" if isinstance(v, float) and not math.isnan(v) else str(v)

    return sorted(tuple(map(plain, r)) for r in frame[columns].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f).removesuffix('.parquet')} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, DATA).toPandas()
    want = duck.sql(catalogue.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_optional_part(tmp_path):
    """The entry module imports and lists its queries where the optional subpackage and the pipeline are gone."""
    (tmp_path / "tidemark").mkdir()
    for p in (REPO / "tidemark").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "tidemark" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").write_text((REPO / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'scd2_active' in q and not any(n.startswith('op1') or n == 'pipeline' for n in q), list(q); e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
