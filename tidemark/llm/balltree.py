"""Exact search for the largest inner products, by branch and bound in ball trees.

Each task packs the vectors that it reads into shards of at most SHARD rows and builds a shard's ball tree: rows are
halved at the median along the direction in which they spread most, so the tree is the order of the rows, and a node
a range of them with a centre and a radius.  A block of queries walks a tree with a queue of nodes, the one with the largest
upper bound (q.c + |q| r) of any query first; at a node only those queries go on whose bound reaches their current k-th
score, which all nodes, and all shards, share: queries first search the shard that they lie in, and take the k-th
score found there to every shard.  Blocks of queries go to all shards: each shard's task reads its vectors
and then, one block after the other, the queries, so memory is bounded by a shard and a block.

Scores are exact integers; bounds are rounded up.  A candidate is a row with another id than the query; repeated rows are
candidates one by one, so shards are cut by place, and a large group of copies is dealt out like other rows.
Queries with equal id and vector are one; those with one id and several vectors are ranked one by one.  Queries meet
only vectors of their own length.  Ties go to the smaller id; with fewer candidates than k all come back.  Vectors that
are null or hold null or non-finite components take no part, null ids neither; zero vectors do.  Other columns
are not read, so none can clash; an empty table gives an empty result.  Components beyond 32 bits and
scores beyond 64 are errors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, stored
from .kernel import tidy
from .quantised import EXACT, KIND, products, quantised

#: Rows of a shard at most, and at least where there are enough; of a leaf; of a row of packed vectors; queries of a block.
SHARD, LEAST_SHARD, LEAF, ROW, BLOCK = 1 << 18, 1 << 12, 128, 2048, 512
#: Shards of a group, to which blocks of queries are dealt.
GROUP = 64
NONE = np.iinfo(np.int64).min
VECTORS, QUERIES = 0, 1
PACKED = "kind int, shard long, dims int, place int, ids binary, codes binary, least long"

BLOCKS = "block long, dims int, ids binary, codes binary, least binary"


class Tree:
    """Rows in the order of a ball tree: node (lo, hi) is a range of rows, its halves are its children."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray) -> None:
        self.ids, self.codes = ids, codes
        self.real = codes.astype(np.float64)
        self.largest = int(np.abs(codes).max(initial=0))
        self.nodes: dict[tuple[int, int], tuple[np.ndarray, float]] = {}

    @classmethod
    def build(cls, ids: np.ndarray, codes: np.ndarray) -> Tree:
        order, x = np.arange(len(ids)), codes.astype(np.float64)
        todo = [(0, len(ids))]
        while todo:
            lo, hi = todo.pop()
            if hi - lo > LEAF:
                own = x[order[lo:hi]]
                # from the farthest of the centre to the farthest of that one
                a = own[((own - own.mean(0)) ** 2).sum(1).argmax()]
                b = own[((own - a) ** 2).sum(1).argmax()]
                half = (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(own @ (b - a), half)]
                todo += [(lo, lo + half), (lo + half, hi)]
        return cls(ids[order], codes[order])

    def ball(self, lo: int, hi: int) -> tuple[np.ndarray, float]:
        if (lo, hi) not in self.nodes:
            own = self.real[lo:hi]
            centre = own.mean(0)
            self.nodes[lo, hi] = centre, float(np.sqrt(((own - centre) ** 2).sum(1).max()))
        return self.nodes[lo, hi]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of the k best rows of each query that reach its score in `least`, NONE where all count; ids may tie beyond k elsewhere, so ties with `least` are kept."""
        n = len(queries)
        real = queries.astype(np.float64)
        most = np.abs(real).sum(1).max(initial=0) * self.largest
        size = np.sqrt((real * real).sum(1))
        slack = 1e-9 * (size * np.sqrt(self.real.shape[1]) * max(self.largest, 1) + 1)
        scores, ids = np.full((n, k), NONE), np.full((n, k), np.iinfo(np.int64).max)
        floor = least.copy()  # the score that a row must reach: the best known k-th

        def bound(who: np.ndarray, lo: int, hi: int) -> np.ndarray:
            centre, radius = self.ball(lo, hi)
            return real[who] @ centre + size[who] * radius + slack[who]

        everyone = np.arange(n)
        queue = [(0.0, 0, len(self.ids), everyone, bound(everyone, 0, len(self.ids)))] if len(self.ids) and n else []
        while queue:
            _, lo, hi, who, up = heapq.heappop(queue)
            who = who[(floor[who] == NONE) | (up >= floor[who].astype(np.float64))]
            if not len(who):
                continue
            if hi - lo > LEAF:
                half = lo + (hi - lo) // 2
                for a, b in ((lo, half), (half, hi)):
                    ups = bound(who, a, b)
                    # ranges differ, so that ties never compare arrays
                    heapq.heappush(queue, (-float(ups.max()), a, b, who, ups))
                continue
            if most < EXACT:
                found = (real[who] @ self.real[lo:hi].T).astype(np.int64)
            else:
                found = products(queries[who], self.codes[lo:hi])
            found[query_ids[who][:, None] == self.ids[lo:hi]] = NONE
            hit = (found > NONE) & (found >= floor[who][:, None])
            q, c = np.nonzero(hit)
            if not len(q):
                continue
            some = np.unique(q)
            of = np.concatenate([np.repeat(some, k), q])
            s = np.concatenate([scores[who[some]].ravel(), found[q, c]])
            i = np.concatenate([ids[who[some]].ravel(), self.ids[lo:hi][c]])
            order = np.lexsort((i, ~s, of))  # ~s falls as s rises, without leaving 64 bits
            turn = np.arange(len(order)) - np.searchsorted(of[order], of[order], "left")
            best = order[turn < k]
            scores[who[some]], ids[who[some]] = s[best].reshape(-1, k), i[best].reshape(-1, k)
            floor[who[some]] = np.maximum(floor[who[some]], scores[who[some], k - 1])
        q, t = np.nonzero(scores > NONE)
        return q, ids[q, t], scores[q, t]


def packs(kind: int, shard: int, dims: int, ids: np.ndarray, codes: np.ndarray, least: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of ROW vectors each, or of one query each with its k-th score so far."""
    cuts = [*range(0, len(ids), ROW if least is None else 1), len(ids)]
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    m = len(spans)
    codes = codes.astype(KIND)
    return pa.RecordBatch.from_pydict({
        "kind": pa.array([kind] * m, pa.int32()), "shard": pa.array([shard] * m, pa.int64()), "dims": pa.array([dims] * m, pa.int32()), "place": pa.array([a for a, _ in spans], pa.int32()),
        "ids": pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary()), "codes": pa.array([codes[a:b].tobytes() for a, b in spans], pa.binary()), "least": pa.array([None] * m if least is None else least, pa.int64()),
    })


def sharded(every: int, size: int, k: int):
    """(id, q) -> shards of at most `size` rows in the order of their trees, and their queries (ids divisible by `every`), each vector followed by the k-th score in its own shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, list[tuple[np.ndarray, list[bytes]]]] = {}
        count: dict[int, int] = {}
        number = TaskContext.get().partitionId() << 32

        def shard(dims: int) -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = held.pop(dims)
            del count[dims]
            ids = np.concatenate([i for i, _ in rows])
            codes = np.frombuffer(b"".join(x for _, q in rows for x in q), KIND).reshape(len(ids), dims).astype(np.int64)
            tree = Tree.build(ids, codes)
            number += 1
            yield packs(VECTORS, number, dims, tree.ids, tree.codes)
            asks = np.flatnonzero(tree.ids % every == 0)
            for a in range(0, len(asks), BLOCK):
                some = asks[a : a + BLOCK]
                q, _, score = tree.search(tree.ids[some], tree.codes[some], k, np.full(len(some), NONE))
                kth = np.full(len(some), NONE)
                full = np.flatnonzero(np.bincount(q, minlength=len(some)) == k)
                kth[full] = score.reshape(-1)[np.searchsorted(q, full, "right") - 1]
                yield packs(QUERIES, number, dims, tree.ids[some], tree.codes[some], kth)

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            q = batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, q), np.int64, len(q)) // np.dtype(KIND).itemsize
            for dims in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dims)
                for a in range(0, len(own), LEAST_SHARD):
                    some = own[a : a + LEAST_SHARD]
                    if count.get(dims, 0) + len(some) > size and dims in held:
                        yield from shard(dims)
                    held.setdefault(dims, []).append((ids[some], [q[i] for i in some.tolist()]))
                    count[dims] = count.get(dims, 0) + len(some)
        for dims in list(held):
            yield from shard(dims)

    return run


def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dims, ids, codes, least), a query each -> (block, dims, ids, codes, least) of at most BLOCK queries of one length each."""
    from pyspark import TaskContext

    held: dict[int, list[tuple[bytes, bytes, int]]] = {}
    number = TaskContext.get().partitionId() << 32

    def block(dims: int) -> pa.RecordBatch:
        nonlocal number
        rows = held.pop(dims)
        number += 1
        least = np.array([r[2] for r in rows], np.int64)
        return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "dims": pa.array([dims], pa.int32()), "ids": pa.array([b"".join(r[0] for r in rows)], pa.binary()), "codes": pa.array([b"".join(r[1] for r in rows)], pa.binary()), "least": pa.array([least.tobytes()], pa.binary())})

    for batch in batches:
        for dims, i, q, least in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            held.setdefault(dims, []).append((i, q, least))
            if len(held[dims]) == BLOCK:
                yield block(dims)
    for dims in list(held):
        yield block(dims)


def searched(k: int):
    """Rows (shard, place, block, ids, codes, least) in the order of shard and place: a shard's vectors (without a block) and then blocks of queries -> (query, query_id, vec_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree, ids, codes, dims = None, None, [], [], 0
        for batch in batches:
            for s, _, d, b, i, c, least in zip(*(batch.column(n).to_pylist() for n in range(7)), strict=True):
                if s != shard:
                    shard, tree, ids, codes, dims = s, None, [], [], d
                if b is None:
                    ids.append(i)
                    codes.append(c)
                    continue
                if tree is None:
                    own = np.frombuffer(b"".join(ids), np.int64)
                    tree = Tree(own, np.frombuffer(b"".join(codes), KIND).reshape(len(own), dims).astype(np.int64))
                    ids, codes = [], []
                asks = np.frombuffer(i, np.int64)
                q, found, score = tree.search(asks, np.frombuffer(c, KIND).reshape(len(asks), dims).astype(np.int64), k, np.frombuffer(least, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.int64(b) * BLOCK + q), pa.array(asks[q]), pa.array(found), pa.array(score)], names=["query", "query_id", "vec_id", "score"])

    return run


def top_products(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id long, rank int, vec_id long, score long: the k largest inner products of each row whose id is divisible by `every` with the rows of other ids."""
    spark = df.sparkSession
    n = parts(spark)
    rows = quantised(df, key, vector, scale).where("id is not null")
    size = min(SHARD, max(LEAST_SHARD, -(-df.count() // (2 * n))))
    known = stored(rows.mapInArrow(tidy(sharded(every, size, k)), PACKED), "shards")
    vectors, asks = known.where(F.col("kind") == VECTORS), known.where(F.col("kind") == QUERIES)
    # an equal query of several shards takes the best of its k-th scores along
    asks = asks.groupBy("dims", "ids", "codes").agg(F.max("least").alias("least"))
    blocks = stored(asks.mapInArrow(tidy(in_blocks), BLOCKS), "queries")
    shards = vectors.select("shard", "dims").distinct()
    groups = max(1, -(-shards.count() // GROUP))
    shards = shards.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(groups)))
    told = blocks.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))).join(shards, ["dims", "group"])
    columns = ["shard", "place", "dims", "block", "ids", "codes", "least"]
    none = vectors.withColumn("block", F.lit(None).cast("long")).withColumn("least", F.lit(None).cast("binary"))
    both = none.select(*columns).unionByName(told.withColumn("place", F.lit(0)).select(*columns))
    found = both.repartition(n, "shard").sortWithinPartitions("shard", "block", "place").mapInArrow(tidy(searched(k)), "query long, query_id long, vec_id long, score long")
    turn = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", turn).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(k: int = 5, every: int = 50, scale: int = 256) -> str:
    """The contract's rows in SQL."""
    return f"""WITH o AS (SELECT vec_id, embedding, len(embedding) AS dims FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
v AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, floor({scale} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM o),
p AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score FROM v q JOIN v c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= {k}"""
