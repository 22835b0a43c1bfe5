import time
from pathlib import Path

import numpy as np
import pytest

from tidemark.llm import neighbours


def brute(rows, every=20, top=20):
    out = {}
    for q, x in rows:
        if q % every == 0:
            scored = sorted((-float(np.dot(x, y)), i) for i, y in rows if i != q)
            out[q] = [i for _, i in scored[:top]]
    return out


def table(spark, rows):
    return spark.createDataFrame([(int(i), None if x is None else [None if v is None else float(v) for v in x], 1, 5) for i, x in rows], "vec_id long, embedding array<float>, label int, node int")


def found(df):
    out = {}
    for r in sorted(neighbours.nearest(df).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_recall(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 1500)] + 0.6 * rng.normal(size=(1500, 16))).astype(np.float32).astype(float)
    rows = list(enumerate(x))
    got, want = found(table(spark, rows)), brute(rows)
    assert set(got) == set(want)
    hits = sum(len({i for _, i, _ in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    for q, each in got.items():
        assert [r for r, _, _ in each] == list(range(1, 21))
        assert [(-s, i) for _, i, s in each] == sorted((-s, i) for _, i, s in each)
        assert all(abs(s - float(np.dot(x[q], x[i]))) < 1e-9 for _, i, s in each)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, [1, 0]), (2, [0, 1]), (3, None), (4, []), (5, [nan, 1]), (6, [inf, 1]), (7, [None, 1]), (8, [0, 0]), (9, [1, 2, 3]), (20, [2, 0]), (40, [nan, nan]), (1, [1, 0])]
    got = found(table(spark, rows))
    assert got == {0: [(1, 20, 2.0), (2, 1, 1.0), (3, 2, 0.0)], 20: [(1, 0, 2.0), (2, 1, 2.0), (3, 2, 0.0)]}
    assert found(table(spark, [(0, [1.0])])) == {}
    assert found(table(spark, [])) == {}


def test_recall_of_uniform_vectors(spark):
    """Nothing clusters; every id divisible by 20 asks, and the graph is a graph, not one block."""
    rng = np.random.default_rng(9)
    x = rng.uniform(-1, 1, size=(2000, 24)).astype(np.float32).astype(float)
    rows = list(enumerate(x))
    got, want = found(table(spark, rows)), brute(rows)
    hits = sum(len({i for _, i, _ in got[q]} & set(want[q])) for q in want)
    assert set(got) == set(want) and hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("copies", [60])
def test_a_large_group_of_copies(spark, copies):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.5, 0.25]) for i in range(copies)] + [(copies + i, rng.normal(size=3).astype(np.float32)) for i in range(60)]
    got = found(table(spark, rows))
    want = brute([(i, np.array(x, float)) for i, x in rows])
    assert {q: [i for _, i, _ in v] for q, v in got.items()} == want


@pytest.mark.parametrize("spread", [0.08, 0.0005])
def test_recall_among_near_copies(spark, spread):
    rng = np.random.default_rng(4)
    x = rng.normal(size=32) + spread * rng.normal(size=(3000, 32))
    rows = list(enumerate(x.astype(np.float32).astype(float)))
    got, want = found(table(spark, rows)), brute(rows)
    hits = sum(len({i for _, i, _ in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.95 * 20 * len(want)


@pytest.mark.parametrize("factor", [100.0, 1e200])
def test_recall_beside_a_very_long_vector(spark, factor):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 16))
    x = centres[rng.integers(0, 30, 1500)] + 0.6 * rng.normal(size=(1500, 16))
    x[7] *= factor
    rows = list(enumerate(x))
    got = found(spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>"))
    want = brute(rows)
    hits = sum(len({i for _, i, _ in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.95 * 20 * len(want)


def test_search_goes_on_until_nothing_is_open(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SEEDS", 1)
    many = 80  # a chain, searched from one node to its farther end
    code = lambda x: np.array([x, 0], np.float32).tobytes()
    near = lambda i: np.array([j for j in (i - 1, i + 1) if 0 <= j < many], np.int64)
    rows = [(i, code(i / many), near(i).tobytes(), np.zeros(len(near(i)), np.float32).tobytes()) for i in range(many)]
    nodes = spark.createDataFrame(rows, neighbours.NODE)
    queries = spark.createDataFrame([(1000, code(1)), (1001, code(-1))], "id long, code binary")
    got = {r["query"]: np.frombuffer(r["beam"], np.int64).tolist() for r in neighbours.search(queries, nodes, 4).collect()}
    assert got == {1000: [1000, 79, 78, 77], 1001: [1001, 0, 1, 2]}


def test_steps_leave_no_shuffles_and_only_the_tables_that_are_read(spark, monkeypatch):
    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    real, seen, conf = neighbours.stored, [], spark.conf.get(key, None)
    monkeypatch.setattr(neighbours, "stored", lambda df, name: seen.append((name, spark.conf.get(key, None))) or real(df, name))
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    rng = np.random.default_rng(12)
    rows = table(spark, list(enumerate(rng.normal(size=(400, 8)).astype(np.float32))))
    tables = set(folder.iterdir())
    df = neighbours.nearest(rows)
    assert {"nodes", "near", "beam"} <= {n for n, _ in seen} and {c for _, c in seen} == {"true"}
    assert spark.conf.get(key, None) == conf
    assert sorted(x.name.split("-")[0] for x in set(folder.iterdir()) - tables) == ["found", "long", "members", "points"]
    assert df.count() == 400
    files = shuffles()
    with neighbours.shuffles_removed(spark):
        df = real(rows.repartition(3, "vec_id"), "dealt")
    for _ in range(50):  # executors are told to remove them, not waited for
        if shuffles() <= files:
            break
        time.sleep(0.1)
    assert shuffles() <= files
    assert df.count() == 400
