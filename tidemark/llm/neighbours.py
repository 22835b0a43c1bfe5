"""Approximate nearest neighbours by largest inner product.

NN-descent: every distinct vector keeps its NEAR best neighbours so far, at first from brute force in
blocks of vectors that fall on the same sides of random hyperplanes (or, of one side, lie near along a line); then, round after round, each vector
gathers its neighbours and a sample of those that have it as a neighbour, compares them with one another,
and passes on what is better than their worst; Spark joins and merges the lists until few change.  Queries
are answered by greedy search in the graph: a beam of the best vectors seen, of which the best that are
not yet expanded send for their neighbours, until the whole beam is expanded.  What the beam holds is then
scored on the original vectors in double precision.  Every step's shuffles go when it ends, its tables when nothing
reads them any more, so disk holds a step or two, the search's table of neighbours and what the answers are made of.

Graph and search use vectors of 32-bit numbers, with one more coordinate that puts all on one sphere, so that
the largest inner product is the nearest neighbour; differences and sums are taken in double precision, so
vectors that lie close together keep their order.  The LONG longest vectors are kept out of the graph and scored
exactly for every query, so that single long ones do not shrink all others towards the pole.  Equal vectors are one node (its smallest ids are
kept, more than any query can return), so a large group of copies is one node too.

Vectors that are null, zero, of another length than most, or hold null or non-finite numbers take no part,
as queries or candidates; null ids neither.  Ties go to the smaller id.  With fewer candidates than `top` all
come back.  Rows with the query's own id are never its candidates; repeated rows count once.  Other columns are not read, so none can
clash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, parts, shuffles_removed, stored
from .kernel import aligned, tidy

NEAR, BACK, TREES, BLOCK = 32, 24, 4, 512
ROUNDS, ENOUGH = 5, 0.01
PASSED = 8
BEAM, EXPANDED, SEEDS = 256, 64, 512
PLANES = 30
LONG = 64
#: Neighbours in a row of the search's table, which bounds a batch's bytes.
A_ROW = 12
#: Lengths beyond count as this, when vectors are scaled.
LARGEST = 1e300
NODE = "id long, code binary, near binary, sims binary"


def valid(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id, vec (array<double>) of the rows that take part."""
    rows = df.select(df[key].cast("long").alias("id"), df[vector].cast("array<double>").alias("vec")).where("id is not null and vec is not null and size(vec) > 0")
    limit = 1.7976931348623157e308
    rows = rows.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= limit)) & F.exists("vec", lambda x: x != 0))
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (size["n"] if size else 0))


def codes(vecs: np.ndarray, norm: float) -> np.ndarray:
    """32-bit vectors on a sphere about its pole, at the scale of a power of two, so that 32-bit input stays exact.  The added coordinate is counted from the pole, where short vectors lie, so that their differences are not rounded away."""
    scale = np.ldexp(1.0, int(np.frexp(norm)[1]))
    y, radius = vecs / scale, norm / scale
    t = np.minimum((y * y).sum(1) / (radius * radius), 1)
    return np.hstack([y, (radius * t / (1 + np.sqrt(1 - t)))[:, None]]).astype(np.float32)


def closeness(code: np.ndarray) -> np.ndarray:
    """Squared distances between all, negative; of none to itself."""
    x = code.astype(np.float64) - code[0]
    half = (x * x).sum(1)
    sims = 2 * (x @ x.T) - half[:, None] - half
    np.fill_diagonal(sims, -np.inf)
    return sims


def inner(code: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the same for a vector in any company."""
    return (code.astype(np.float64) * query.astype(np.float64)).sum(1)


def matrix(col: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    rows = col.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def flat(col: pa.ChunkedArray | pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, how many a row)."""
    rows = col.to_pylist()
    data = np.frombuffer(b"".join(rows), kind)
    return data, np.array([len(x) for x in rows], np.int64) // data.itemsize


def best(of: np.ndarray, who: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
    """Indices of the `most` best distinct `who` of each `of`, best first; ties to the smaller id."""
    order = np.lexsort((-sim, who, of))
    o, w = of[order], who[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (w[1:] != w[:-1])
    order = order[new]
    order = order[np.lexsort((who[order], -sim[order], of[order]))]
    o = of[order]
    first = np.searchsorted(o, o, "left")
    return order[np.arange(len(o)) - first < most]


def lists(of: np.ndarray, who: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """Rows of a sorted edge list: (id, neighbours, similarities)."""
    ids, at = np.unique(of, return_index=True)
    cuts = np.append(at, len(of))
    return ids, [who[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], [sim[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def in_blocks(size: int):
    """(id, code) in the order of a hyperplane code -> id, near, sims: the best of each block of `size` consecutive vectors, or a few more."""

    def brute(ids: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
        sims = closeness(code)
        k = min(NEAR, len(ids) - 1)
        at = np.argpartition(-sims, k - 1, 1)[:, :k] if k else np.zeros((len(ids), 0), int)
        found = np.take_along_axis(sims, at, 1)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array([ids[r].tobytes() for r in at], pa.binary()), pa.array([r.astype(np.float32).tobytes() for r in found], pa.binary())], names=["id", "near", "sims"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(), matrix(batch.column(1), "f4")))
            if sum(len(i) for i, _ in held) >= 2 * size:
                ids, code = np.concatenate([i for i, _ in held]), np.concatenate([c for _, c in held])
                whole = len(ids) // size - 1
                for b in range(whole):
                    yield brute(ids[b * size : (b + 1) * size], code[b * size : (b + 1) * size])
                held = [(ids[whole * size :], code[whole * size :])]
        if held:
            yield brute(np.concatenate([i for i, _ in held]), np.concatenate([c for _, c in held]))

    return run


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, code or null, near, sims, old) sorted by id -> nodes and the number of their new neighbours."""
    for t in aligned(batches, "id"):
        ids = t["id"].to_numpy()
        who, sizes = flat(t["near"], "i8")
        sim, _ = flat(t["sims"], "f4")
        of = np.repeat(ids, sizes)
        old = np.repeat(t["old"].to_numpy().astype(bool), sizes)
        keep = best(of, who, sim, NEAR)
        known = np.unique(of[old].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ who[old].astype(np.uint64))
        mine = of[keep].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ who[keep].astype(np.uint64)
        fresh = ~np.isin(mine, known)
        code = {i: c for i, c in zip(ids.tolist(), t["code"].to_pylist(), strict=True) if c is not None}
        got, near, sims = lists(of[keep], who[keep], sim[keep])
        rows = dict(zip(got.tolist(), zip(near, sims, strict=True), strict=True))
        new = dict(zip(*(x.tolist() for x in np.unique(of[keep][fresh], return_counts=True)), strict=True))
        nodes = list(code)
        yield pa.RecordBatch.from_pydict({
            "id": pa.array(nodes, pa.int64()), "code": pa.array([code[i] for i in nodes], pa.binary()),
            "near": pa.array([rows.get(i, (b"", b""))[0] for i in nodes], pa.binary()), "sims": pa.array([rows.get(i, (b"", b""))[1] for i in nodes], pa.binary()),
            "fresh": pa.array([new.get(i, 0) for i in nodes], pa.int64()),
        })


def edges(nodes: DataFrame) -> DataFrame:
    """nodes -> id, other: one row a neighbour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                who, sizes = flat(batch.column(1), "i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), sizes)), pa.array(who)], names=["id", "other"])

    return nodes.select("id", "near").mapInArrow(run, "id long, other long")


def joined_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pivot, id, code, worst) sorted by pivot -> id, near, sims: for each gathered vector the best of the others, if better than its worst."""
    for t in aligned(batches, "pivot", 16384):
        pivots, ids = t["pivot"].to_numpy(), t["id"].to_numpy()
        code = matrix(t["code"], "f4")
        worst = t["worst"].to_numpy()
        cuts = np.flatnonzero(np.diff(pivots)) + 1
        of, who, sim = [], [], []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pivots)], strict=True):
            if b - a < 2:
                continue
            s = closeness(code[a:b]).astype(np.float32)
            k = min(PASSED, b - a - 1)
            at = np.argpartition(-s, k - 1, 1)[:, :k]
            found = np.take_along_axis(s, at, 1)
            x, y = np.nonzero(found > worst[a:b, None])
            of.append(ids[a:b][x])
            who.append(ids[a:b][at[x, y]])
            sim.append(found[x, y])
        if not of:
            continue
        of, who, sim = np.concatenate(of), np.concatenate(who), np.concatenate(sim).astype(np.float32)
        other = of != who
        of, who, sim = of[other], who[other], sim[other]
        keep = best(of, who, sim, NEAR)
        got, near, sims = lists(of[keep], who[keep], sim[keep])
        yield pa.RecordBatch.from_arrays([pa.array(got), pa.array(near, pa.binary()), pa.array(sims, pa.binary())], names=["id", "near", "sims"])


def back_links(nodes: DataFrame) -> DataFrame:
    """nodes -> id, other: up to BACK vectors that have id as a neighbour, one for each slot of a hash, combined before the shuffle, so hubs do not weigh."""
    e = edges(nodes)
    slot = F.pmod(F.xxhash64("id"), F.lit(BACK))
    picked = e.groupBy(F.col("other").alias("to"), slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("id", F.lit(3)).alias("h"), "id")).alias("x"))
    return picked.select(F.col("to").alias("id"), F.col("x.id").alias("other"))


def worst_of(nodes: DataFrame) -> DataFrame:
    """nodes -> id, code, worst: the least similarity a new neighbour must exceed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = [np.frombuffer(x, np.float32) for x in batch.column(2).to_pylist()]
            worst = [float(x.min()) if len(x) >= NEAR else float("-inf") for x in sims]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(worst, pa.float32())], names=["id", "code", "worst"])

    return nodes.select("id", "code", "sims").mapInArrow(run, "id long, code binary, worst float")


def build(points: DataFrame, dims: int) -> DataFrame:
    """points(id, code) -> the neighbour graph: id, code, near, sims."""
    spark = points.sparkSession
    n = parts(spark)
    total = points.count()
    size = max(2 * NEAR, min(BLOCK, total // 8))  # of few vectors too, blocks are parts
    rng = np.random.default_rng(11)
    planes = rng.normal(size=(TREES, dims, PLANES + 1))
    some = points.orderBy(F.xxhash64("id", F.lit(31)), "id").limit(SEEDS).select("code").toArrow()
    centre = matrix(some["code"], "f4").astype(np.float64).mean(0) if some.num_rows else np.zeros(dims)
    powers = (1 << np.arange(PLANES - 1, -1, -1)).astype(np.int64)

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = [(matrix(batch.column(1), "f4") - centre) @ p for p in planes]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array((y[:, :-1] > 0) @ powers) for y in x), *(pa.array(y[:, -1]) for y in x)], names=["id", "code", *(f"side{t}" for t in range(TREES)), *(f"along{t}" for t in range(TREES))])

    sided = stored(points.select("id", "code").mapInArrow(sides, "id long, code binary, " + ", ".join([*(f"side{t} long" for t in range(TREES)), *(f"along{t} double" for t in range(TREES))])), "sides")
    merged = f"{NODE}, fresh long"
    lists_ = None
    for t in range(TREES):
        block = sided.select("id", "code", f"side{t}", f"along{t}").repartitionByRange(n, f"side{t}", f"along{t}", "id").sortWithinPartitions(f"side{t}", f"along{t}", "id").select("id", "code").mapInArrow(tidy(in_blocks(size)), "id long, near binary, sims binary")
        lists_ = block if lists_ is None else lists_.union(block)

    def combined(base: DataFrame, more: DataFrame) -> DataFrame:
        rows = base.withColumn("old", F.lit(True)).unionByName(more.select("id", F.lit(None).cast("binary").alias("code"), "near", "sims").withColumn("old", F.lit(False)))
        return rows.repartition(n, "id").sortWithinPartitions("id").mapInArrow(tidy(merge), merged)

    empty = sided.select("id", "code", F.lit(b"").alias("near"), F.lit(b"").alias("sims"))
    nodes = stored(combined(empty, lists_), "nodes")
    discard(sided)
    for _ in range(ROUNDS):
        graph = nodes.select("id", "code", "near", "sims")
        members = edges(graph).union(back_links(graph)).where("id <> other").distinct()
        sent = members.select(F.col("id").alias("pivot"), F.col("other").alias("id")).join(worst_of(graph), "id")
        better = sent.select("pivot", "id", "code", "worst").repartition(n, "pivot").sortWithinPartitions("pivot").mapInArrow(tidy(joined_locally), "id long, near binary, sims binary")
        before, nodes = nodes, stored(combined(graph, better), "nodes")
        discard(before)
        if (nodes.agg(F.sum("fresh").alias("n")).first()["n"] or 0) <= ENOUGH * NEAR * total:
            break
    return nodes.select("id", "code", "near", "sims")


def adjacency(nodes: DataFrame) -> DataFrame:
    """nodes -> id, near (ids), codes: neighbours both ways with their vectors, up to A_ROW in a row."""
    both = edges(nodes).union(back_links(nodes)).where("id <> other").distinct()
    rows = both.join(nodes.select(F.col("id").alias("other"), "code"), "other").repartition(parts(nodes.sparkSession), "id").sortWithinPartitions("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in aligned(batches, "id"):
            ids = t["id"].to_numpy()
            place = np.arange(len(ids)) - np.searchsorted(ids, ids, "left")
            at = np.flatnonzero(place % A_ROW == 0)
            ids, cuts = ids[at], [*at.tolist(), t.num_rows]
            who = t["other"].to_numpy()
            code = t["code"].to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([who[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), pa.array([b"".join(code[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], names=["id", "near", "codes"])

    return rows.select("id", "other", "code").mapInArrow(tidy(run), "id long, near binary, codes binary")


BEAMS = "query long, code binary, beam binary, sims binary, done binary, open long"


def beam_row(ids: np.ndarray, sims: np.ndarray, done: np.ndarray, width: int) -> tuple[bytes, bytes, bytes, int]:
    order = np.lexsort((-sims, ~done, ids))  # of one id what is expanded stays so
    order = order[np.append(True, np.diff(ids[order]) != 0)]
    keep = order[np.lexsort((ids[order], -sims[order]))][:width]
    return ids[keep].tobytes(), sims[keep].tobytes(), done[keep].astype(np.int8).tobytes(), int((~done[keep]).sum())


def search(queries: DataFrame, nodes: DataFrame, width: int = BEAM) -> DataFrame:
    """queries(id, code) -> query, beam (ids, best first): greedy search from a bounded sample of nodes."""
    spark = nodes.sparkSession
    n = parts(spark)
    seeds = nodes.select("id", "code").orderBy(F.xxhash64("id", F.lit(29)), "id").limit(max(1, min(SEEDS, nodes.count() // 8))).toArrow()
    seed_ids = seeds["id"].to_numpy()
    seed_codes = matrix(seeds["code"], "f4") if len(seed_ids) else np.zeros((0, 1), np.float32)
    near = stored(adjacency(nodes), "near")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            # the node of the query itself is a candidate like others, and known from the start
            rows = [beam_row(np.append(seed_ids, own[i]), np.append(inner(seed_codes, c), 1.0), np.zeros(len(seed_ids) + 1, bool), width) for i, c in enumerate(matrix(batch.column(1), "f4"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.binary(), pa.binary(), pa.binary(), pa.int64()), strict=True))], names=["query", "code", "beam", "sims", "done", "open"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for q, c, b, d in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                ids, done = np.frombuffer(b, np.int64), np.frombuffer(d, np.int8)
                out += [(int(i), q, c) for i in ids[np.flatnonzero(done == 0)[:EXPANDED]]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["id", "query", "code"])

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sims = [], []
            for c, who, codes_ in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
                q = np.frombuffer(c.as_buffer(), np.float32)
                s = inner(np.frombuffer(codes_.as_buffer(), np.float32).reshape(-1, len(q)), q)
                ids.append(who.as_py())
                sims.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(sims, pa.binary())], names=["query", "beam", "sims"])

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in aligned(batches, "query", 4096):
            query = t["query"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(query)) + 1).tolist(), len(query)]
            code, beam, sims, done = (t[c].to_pylist() for c in ("code", "beam", "sims", "done"))
            out = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = next(i for i in range(a, b) if code[i] is not None)
                ids = np.frombuffer(b"".join([beam[own], *(beam[i] for i in range(a, b) if i != own)]), np.int64)
                s = np.frombuffer(b"".join([sims[own], *(sims[i] for i in range(a, b) if i != own)]), np.float64)
                was = np.frombuffer(done[own], np.int8).astype(bool)
                flags = np.zeros(len(ids), bool)
                flags[: len(was)] = was
                flags[np.flatnonzero(~was)[:EXPANDED]] = True  # just expanded
                out.append((int(query[own]), code[own], *beam_row(ids, s, flags, width)))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64()), strict=True)], names=["query", "code", "beam", "sims", "done", "open"])

    state = stored(queries.select("id", "code").mapInArrow(tidy(begin), BEAMS), "beam")
    finished, steps = None, [state]
    while True:  # ends: a beam only gets better, and each step expands what is open
        live = state.where("open > 0")
        ended = state.where("open = 0").select("query", "beam")
        finished = ended if finished is None else finished.union(ended)
        if live.isEmpty():
            found = stored(finished, "found")
            discard(near, *steps)
            return found
        asked = live.select("query", "code", "beam", "done").mapInArrow(ask, "id long, query long, code binary")
        replies = asked.join(near, "id").select("query", "code", "near", "codes").mapInArrow(tidy(reply), "query long, beam binary, sims binary")
        rows = live.select("query", "code", "beam", "sims", "done").unionByName(replies.select("query", F.lit(None).cast("binary").alias("code"), "beam", "sims", F.lit(None).cast("binary").alias("done")))
        state = stored(rows.repartition(n, "query").sortWithinPartitions("query").mapInArrow(tidy(advance), BEAMS), "beam")
        steps.append(state)


def nearest(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, top: int = 20, width: int = BEAM) -> DataFrame:
    """Of each row whose key is divisible by `every`: query_id, rank (from 1), vec_id, score, its `top` nearest found."""
    with shuffles_removed(df.sparkSession):
        return answers_of(df, key, vector, every, top, width)


def answers_of(df: DataFrame, key: str, vector: str, every: int, top: int, width: int) -> DataFrame:
    rows = stored(valid(df, key, vector).distinct(), "vectors")
    grouped = rows.withColumn("same", F.xxhash64("vec")).groupBy("same", "vec").agg(F.min("id").alias("node"))
    largest = F.array_max(F.transform("vec", F.abs))
    length = largest * F.sqrt(F.aggregate(F.transform("vec", lambda x: x / largest), F.lit(0.0), lambda a, x: a + x * x))  # squares do not overflow
    nodes = stored(grouped.select("node", "vec", length.alias("length")), "points")
    if nodes.isEmpty():
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = nodes.select(F.size("vec").alias("n")).first()["n"]
    long = stored(nodes.orderBy(F.desc("length"), "node").limit(LONG), "long")
    rest = nodes.join(F.broadcast(long.select("node")), "node", "left_anti")
    norm = min(rest.agg(F.max("length")).first()[0] or 1.0, LARGEST)
    nodes = nodes.select("node", "vec")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in codes(x, norm)], pa.binary())], names=["id", "code"])

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                x = x / np.abs(x).max(1, keepdims=True)
                c = np.hstack([x / np.sqrt((x * x).sum(1, keepdims=True)), np.zeros((len(x), 1))]).astype(np.float32)  # no part of a query in the added coordinate
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in c], pa.binary())], names=["id", "code"])

    points = rest.select("node", "vec").mapInArrow(coded, "id long, code binary")
    graph = build(points, dims + 1)
    member = rows.join(nodes, "vec").select("id", "node")
    member = stored(member, "members")
    discard(rows)
    asked = member.where(F.col("id") % every == 0)
    queries = asked.select("node").distinct().join(nodes, "node").select("node", "vec")
    found = search(queries.mapInArrow(asking, "id long, code binary"), graph, width)
    discard(graph)

    def spread_beam(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                who, sizes = flat(batch.column(1), "i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), sizes)), pa.array(who)], names=["query", "node"])

    pairs = found.mapInArrow(spread_beam, "query long, node long")
    score = F.aggregate(F.zip_with("vec", "asked", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x).alias("score")
    scored = pairs.join(nodes, "node").join(nodes.select(F.col("node").alias("query"), F.col("vec").alias("asked")), "query").select("query", "node", score)
    # a query's own node is always in its beam
    scored_long = queries.select(F.col("node").alias("query"), F.col("vec").alias("asked")).join(F.broadcast(long.select("node", "vec")), F.col("query") != F.col("node")).select("query", "node", score)
    least = member.withColumn("turn", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("turn") <= top + 1).groupBy("node").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    least_long = least.join(F.broadcast(long.select("node")), "node", "left_semi")
    candidates = scored.join(least, "node").unionByName(scored_long.join(F.broadcast(least_long), "node")).select("query", F.explode("ids").alias("vec_id"), "score")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = candidates.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= top + 1)
    answers = ranked.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("turn", "vec_id", "score"))).alias("found"))
    full = asked.join(answers, F.col("node") == F.col("query")).select(F.col("id").alias("query_id"), F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("id")), 1, top).alias("found"))
    each = full.select("query_id", F.posexplode("found").alias("at", "x"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
