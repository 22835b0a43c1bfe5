"""Centroid clustering and exact top-k search against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import balltree, centroids
from tidemark.llm.quantised import products

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(parts)


def finite(v, dims=None):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (dims is None or len(v) == dims)


def random_vector(rng, dims, wide=1.0):
    return [float(np.float32(rng.gauss(0, wide))) for _ in range(dims)]


def odd(dims):
    return [(1001, None), (1002, [1.0]), (1003, []), (1004, [float("nan")] * dims), (1005, [None] + [0.5] * (dims - 1)), (1006, [float("inf")] + [0.5] * (dims - 1)), (1007, [0.0] * dims), (1008, [-0.0] * dims)]


# ---- clustering


def lloyd(rows, k, rounds, scale, dims, seed):
    own = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if finite(v, dims)]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), np.array(q, "<i4").tobytes(), q) for i, q in own if i is not None)
    centres = [q for _, _, q in order[:k]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        at = [near(q)[1] for _, q in own]
        for n in range(len(centres)):
            mine = [q for (_, q), a in zip(own, at, strict=True) if a == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted(((i, near(q)[1], near(q)[0]) for i, q in own), key=repr), centres


def clustered(spark, rows, **options):
    found, centres = centroids.cluster(frame(spark, rows), **options)
    return sorted(map(tuple, found.select("vec_id", "cluster", "distance").collect()), key=repr), [r["centroid"] for r in centres.orderBy("cluster").collect()], centres


def test_clusters_equal_lloyd_on_all_rows(spark):
    rng = random.Random(5)
    rows = [(i, random_vector(rng, 8)) for i in range(300)]
    copy = random_vector(rng, 8)
    rows += [(300 + i, copy) for i in range(400)] + odd(8) + [rows[3], rows[3], (None, rows[5][1])]  # a hot vector, repeated rows, a null id
    options = {"k": 16, "rounds": 3, "scale": 64, "dims": 8, "seed": 1}
    got, centres, told = clustered(spark, rows, **options)
    assert (got, centres) == lloyd(rows, **options)
    sums = {r["cluster"]: (r["n_rows"], int(r["inertia"])) for r in told.collect()}
    assert sums == {c: (sum(x[1] == c for x in got), sum(x[2] for x in got if x[1] == c)) for c in range(16)}


def test_few_rows_ties_and_empty_clusters(spark):
    rows = [(1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 3.0])]
    options = {"k": 16, "rounds": 2, "scale": 64, "dims": 2, "seed": 1}
    got, centres, _ = clustered(spark, rows, **options)
    assert (got, centres) == lloyd(rows, **options) and len(centres) == 4
    assert clustered(spark, [(1, None), (2, [1.0])], **options)[:2] == ([], [])
    assert clustered(spark, [(None, [1.0, 2.0])], **options)[:2] == ([(None, None, None)], [])
    assert clustered(spark, [], **options)[:2] == ([], [])


def test_columns_of_other_names_do_not_clash(spark):
    rows = frame(spark, [(i, [float(i), 1.0]) for i in range(20)]).select("vec_id", "embedding", *[F.lit(1).alias(c) for c in ("id", "q", "n", "cluster", "distance", "at", "turn", "query_id", "rank", "score", "shard")])
    found, _ = centroids.cluster(rows, k=2, dims=2)
    assert found.columns == ["vec_id", "cluster", "distance"] and found.count() == 20
    assert balltree.top_products(rows, every=10).count() == 10


def test_components_beyond_32_bits_are_refused(spark):
    with pytest.raises(Exception, match="leaves 32 bits"):
        centroids.cluster(frame(spark, [(1, [1e30, 1.0])]), dims=2)


# ---- top-k search


def plain_top(rows, k, every, scale):
    own = [(i, tuple(math.floor(x * scale) for x in v)) for i, v in rows if finite(v) and i is not None]
    out = []
    for i, q in {(i, q) for i, q in own if i % every == 0}:
        best = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in own if j != i and len(c) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def top(spark, rows, parts=3, **options):
    got = balltree.top_products(frame(spark, rows, parts), **options)
    return sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("wide", [1.0, 3e5])
def test_top_k_equals_brute_force(spark, wide, monkeypatch):
    monkeypatch.setattr(balltree, "LEAST_SHARD", 64)
    monkeypatch.setattr(balltree, "LEAF", 8)
    rng = random.Random(9)
    hubs = [random_vector(rng, 6, wide) for _ in range(12)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, wide / 20))) for x in rng.choice(hubs)]) for i in range(-40, 500)]
    rows += [(600 + i, hubs[0]) for i in range(90)] + odd(6) + [rows[50], rows[50], rows[40], (None, hubs[1]), (0, hubs[2])]  # copies, repeated rows (one of a query), a null id, an id with two vectors
    options = {"k": 5, "every": 20, "scale": 256}
    assert top(spark, rows, **options) == plain_top(rows, **options)


def test_top_k_of_few_rows(spark):
    options = {"k": 5, "every": 2, "scale": 256}
    rows = [(2, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [0.0, 0.0]), (5, [1.0])]
    assert top(spark, rows, **options) == plain_top(rows, **options)
    assert top(spark, [(2, [1.0])], **options) == [] and top(spark, [], **options) == [] and top(spark, [(2, None)], **options) == []


def test_a_tree_leaves_out_what_cannot_reach_the_kth_score():
    rng = np.random.default_rng(3)
    codes = np.concatenate([rng.integers(-9, 9, (400, 16)), rng.integers(-9, 9, (4000, 16)) + rng.integers(-900, 900, (40, 1, 16)).repeat(100, 1).reshape(-1, 16)])
    tree = balltree.Tree.build(np.arange(len(codes)), codes)
    queries = tree.codes[::500]
    q, ids, scores = tree.search(np.full(len(queries), -1), queries, 5, np.full(len(queries), balltree.NONE))
    want = np.sort(products(queries, tree.codes), 1)[:, :-6:-1]
    assert (scores.reshape(-1, 5) == want).all()
    tree.nodes.clear()
    tree.search(np.array([-1]), tree.codes[-1:], 5, np.array([balltree.NONE]))
    leaves = [n for n in tree.nodes if n[1] - n[0] <= balltree.LEAF]
    assert len(leaves) < len(codes) / balltree.LEAF / 2  # most leaves never got a ball


def test_products_are_exact_or_refused():
    big = np.array([[(1 << 31) - 1, 1 << 30]])
    assert products(big, big)[0, 0] == ((1 << 31) - 1) ** 2 + (1 << 60)
    with pytest.raises(OverflowError):
        products(np.repeat(big, 3, 1), np.repeat(big, 3, 1))
