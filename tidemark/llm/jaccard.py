"""N-gram Jaccard join of all documents by chosen paths.

A document is the set of its k-word shingles (64-bit hashes).  Documents with equal sets are one class
and meet the join as one set.  Every set keeps SLOTS sampled tokens: the smallest hash of each slot, so
that two sets share the token of a slot with a probability of their similarity.  A run sends a set down
the paths that it chooses: at each level about PICKS of its sampled tokens that are not on the path yet,
by a hash of path and token.  Buckets of up to SMALL sets, or of few pairs whose sizes allow the threshold, are
compared by brute force; larger ones split on, level by level, up to LEVELS.  A set leaves a path that splits nothing off (as all tokens of a passage do that
very many documents hold) if ENOUGH others of its paths there do, so such a passage costs a level and not the square of
its documents.  A large bucket of sets that are alike in most tokens, and one that stays large to the end, is
compared in pairs of blocks, exactly.  A set that has hardly a token left for a large bucket's next level is
compared with the like of it there.  A pair is taken up only in the first of the leaf buckets that both
sets are in, so runs do not multiply it.  Runs repeat until a pair at the threshold is missed with less than
1 - RECALL even if all its paths go through all levels.  Candidates whose sampled tokens agree well
enough are verified on their whole texts; pairs travel packed in one row a document and group, and groups are
bounded by the number and the size of their sets, so that a task holds little at a time.

Result: one row a document: its class (the smallest id of its connected component) and its number of
links (other documents, copies included, at the threshold or above).  Texts of fewer than k words, but at
least one, have one shingle, all their words; null texts and texts without words have no links and each is
a class of its own.  Rows with the same id are one document, of which the smallest text counts (null only if all
are); rows with a null id come back with a null class and no links.  Other columns are not read, so none can
clash, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, stored
from .kernel import mix, pieces, sorted_runs, spread, tidy, windows, words_of

SLOTS, PICKS, SMALL, BLOCK, LEVELS = 32, 4.0, 256, 2048, 5
#: Shingles of the sets that are compared at a time, about.
MASS = 1 << 21
#: Pairs that fit by size, in squares of SMALL, up to which a large bucket is compared, not split.
FIT = 8
RECALL = 0.999
#: Sampled tokens that must agree, as a share: at similarity 0.8 fewer agree once in 10**5 pairs.
AGREE = 0.45
#: Sets with at most so many sampled tokens off a large bucket's path are compared there.
SPENT = 2
#: Paths that must split off a large bucket for a set to leave those that do not.
ENOUGH = 2
#: Share of sampled tokens that the sets of a large bucket have in common with one of them, on average, from which splitting is no use.
ALIKE = 0.6
_U = np.uint64


def runs_for(threshold: float, recall: float) -> int:
    """Runs until a pair at the threshold shares a path down to the last level with the wanted probability."""
    miss = (1 - PICKS / SLOTS * threshold) ** SLOTS
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - (1 - miss) ** LEVELS)))


def shingle_sets(col: pa.Array, k: int) -> list[np.ndarray]:
    """For each text its distinct shingle hashes, ascending."""
    words = words_of(col)
    hashes = words.hashes()
    counts = words.counts()
    at, found = windows(hashes, words.doc, k)
    doc = words.doc[at]
    first = np.cumsum(counts) - counts
    bounds = np.searchsorted(doc, np.arange(words.docs + 1))
    out = []
    for d in range(words.docs):
        if 0 < counts[d] < k:
            h = _U(counts[d])
            for x in hashes[first[d] : first[d] + counts[d]]:
                h = mix(np.array([h ^ x], _U))[0]
            out.append(np.array([h], _U))
        else:
            out.append(np.unique(found[bounds[d] : bounds[d + 1]]))
    return out


def sample(tokens: np.ndarray) -> np.ndarray:
    """The sampled token of each slot, 0 for none."""
    out = np.full(SLOTS, 1 << 32, _U)
    h = mix(tokens)
    np.minimum.at(out, ((h >> _U(32)) % _U(SLOTS)).astype(np.int64), h & _U(0xFFFFFFFF) | _U(1))
    out[out == 1 << 32] = 0
    return out.astype(np.uint32)


def as_samples(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(-1, SLOTS)


def chosen(bucket: np.ndarray, samples: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, next bucket) of each token that a set (row) in a bucket chooses of those that are free; sets with few choose all."""
    have = np.maximum(free.sum(1, keepdims=True), 1)
    slots = np.arange(SLOTS, dtype=_U)
    h = mix(bucket[:, None] ^ mix(samples.astype(_U) << _U(8) | slots))
    row, slot = np.nonzero(free & ((h >> _U(40)) < np.minimum(PICKS / have, 1.0) * (1 << 24)))
    return row, slot, mix(h[row, slot] * _U(0x9E3779B97F4A7C15))


PATHS = "bucket long, id long, n int, used int, final boolean, parent long, whole long"


def path_rows(bucket: np.ndarray, ids: np.ndarray, n: np.ndarray, used: np.ndarray, final: bool, parent: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
    """parent: the bucket that these split from; whole: its size."""
    columns = [pa.array(bucket.view(np.int64)), pa.array(ids), pa.array(n), pa.array(used.astype(np.uint32).view(np.int32)), pa.array(np.full(len(ids), final)), pa.array(parent.view(np.int64)), pa.array(whole)]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in PATHS.split(", ")])


def first_level(sets: DataFrame, runs: int) -> DataFrame:
    """sets(id, n, samples) -> the buckets of all runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            s = as_samples(batch.column(2))
            for r in range(runs):
                row, slot, bucket = chosen(np.full(len(ids), r + 1, _U), s, s > 0)
                yield path_rows(bucket, ids[row], n[row], _U(1) << slot.astype(_U), False, np.zeros(len(row), _U), np.zeros(len(row), np.int64))

    return sets.select("id", "n", "samples").mapInArrow(run, PATHS)


def next_level(large: DataFrame) -> DataFrame:
    """large(bucket, id, n, used, size, samples) -> the buckets below. A set of which few tokens are off the path goes to a final bucket of such sets too: they may have nothing else in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, ids, n, used, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            bucket, used = bucket.view(_U), used.view(np.uint32)
            s = as_samples(batch.column(5))
            free = (s > 0) & (used[:, None] >> np.arange(SLOTS, dtype=np.uint32) & np.uint32(1) == 0)
            row, slot, below = chosen(bucket, s, free)
            yield path_rows(below, ids[row], n[row], used[row] | np.uint32(1) << slot.astype(np.uint32), False, bucket[row], size[row])
            spent = np.flatnonzero(free.sum(1) <= SPENT)
            if len(spent):
                yield path_rows(mix(bucket[spent] ^ _U(0x5BD1E995)), ids[spent], n[spent], used[spent], True, bucket[spent], size[spent])

    return large.select("bucket", "id", "n", "used", "size", "samples").mapInArrow(run, PATHS)


def without_idle_paths(rows: DataFrame) -> DataFrame:
    """The rows of a level below the first, without those of sets that leave a path: its bucket is over half of the one it split from, and ENOUGH of the set's others there are not."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    sized = stored(rows.join(sizes, "bucket").withColumn("splits", (F.col("size") * 2 <= F.col("whole")) & ~F.col("final")), "sized")
    ways = sized.groupBy("parent", "id").agg(F.count_if("splits").alias("ways"))
    kept = sized.where("size > 1").join(ways, ["parent", "id"]).where(F.col("splits") | F.col("final") | (F.col("ways") < ENOUGH))
    return kept.select(*rows.columns)


def fitting(large: DataFrame, threshold: float) -> DataFrame:
    """large(bucket, n, ...) -> bucket, pairs: at least as many as its pairs of which the smaller set has `threshold` of the larger one's size."""
    bands = large.groupBy("bucket", F.floor(F.log("n") / max(-math.log(threshold), 1e-9)).alias("band")).agg(F.count(F.lit(1)).alias("sets"))
    below = Window.partitionBy("bucket").orderBy("band").rangeBetween(-1, -1)  # a bucket has a few dozen bands
    met = F.col("sets") * (F.col("sets") - 1) / 2 + F.col("sets") * F.coalesce(F.sum("sets").over(below), F.lit(0))
    return bands.withColumn("met", met).groupBy("bucket").agg(F.sum("met").alias("pairs"))


def marked(large: DataFrame, threshold: float) -> DataFrame:
    """large(bucket, id, n, samples, ...) -> the same with `whole_leaf`: whether few pairs of the bucket fit by size, or its sets share most sampled tokens with one of them."""
    token = lambda c, i: F.substring(c, 4 * i + 1, 4)
    none = F.lit(bytes(4))
    terms = [(token("samples", i), token("pivot", i)) for i in range(SLOTS)]
    both = sum(((a == b) & (a != none)).cast("int") for a, b in terms)
    either = sum(((a != none) | (b != none)).cast("int") for a, b in terms)
    pivots = large.groupBy("bucket").agg(F.min_by("samples", "id").alias("pivot"))
    shares = large.join(pivots, "bucket").groupBy("bucket").agg((F.sum(both) / F.sum(either)).alias("share"))
    leaf = (F.col("share") >= ALIKE) | (F.col("pairs") <= FIT * SMALL * SMALL)
    return stored(large.join(shares.join(fitting(large, threshold), "bucket").select("bucket", leaf.alias("whole_leaf")), "bucket"), "marked")


def leaf_buckets(sets: DataFrame, runs: int, threshold: float = 0.8) -> DataFrame:
    """sets(id, n, samples) -> bucket, id, blocks (1: the bucket is compared whole): the leaves of all paths that at least two sets share."""
    rows, leaves = stored(first_level(sets, runs), "paths"), None
    for level in range(LEVELS):
        if level:
            rows = stored(without_idle_paths(rows), "paths")
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("mass")).where("size > 1")
        met = stored(rows.join(sizes, "bucket").select(*rows.columns, "size", "mass"), "met")
        leaf = F.col("final") | (F.col("size") <= SMALL)
        if level:
            leaf = leaf | (F.col("size") * 2 > F.col("whole"))
        if level + 1 == LEVELS:
            leaf = F.lit(True)
        blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("mass") / MASS)).cast("long")
        done = met.where(leaf).select("bucket", "id", blocks.alias("blocks"))
        leaves = done if leaves is None else leaves.unionByName(done)
        large = met.where(~leaf)
        if large.isEmpty():
            break
        told = marked(stored(large.withColumn("blocks", blocks).join(sets.select("id", "samples"), "id"), "large"), threshold)
        leaves = leaves.unionByName(told.where("whole_leaf").select("bucket", "id", "blocks"))
        if (rest := told.where("not whole_leaf")).isEmpty():
            break
        rows = stored(next_level(rest), "paths")
    return leaves


def compare(threshold: float):
    """Rows (group, bucket, id, n, samples, homes, side), sorted by group -> (group, id, partners): the pairs whose samples agree and whose first common leaf this bucket is. homes: all leaves of the set."""

    def pairs_of(sizes: np.ndarray, side: np.ndarray, most: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs x < y whose sizes, ascending, allow the threshold, a few rows at a time; of two blocks the pairs across them only."""
        n = len(side)
        across = bool((side >= 0).any())
        many = np.searchsorted(threshold * sizes, sizes, "right") - np.arange(1, n + 1)
        ends = np.cumsum(many)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - many[lo] + most, "right")))
            rows = np.arange(lo, hi)
            x, y = np.repeat(rows, many[lo:hi]), spread(rows + 1, many[lo:hi])
            lo = hi
            if across:
                keep = side[x] != side[y]
                x, y = x[keep], y[keep]
            yield x, y

    def first_here(homes: pa.ChunkedArray, bucket: int):
        """Of pairs of sets, whether they share no leaf before this bucket."""
        lists = homes.combine_chunks()
        flat, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        of = np.repeat(np.arange(len(lists)), np.diff(bounds))
        before = flat < bucket
        _, rank = np.unique(flat[before], return_inverse=True)
        width = len(rank) + 1
        held = of[before] * width + rank  # ascending: by set, and the leaves of each ascend
        start = np.searchsorted(of[before], np.arange(len(lists) + 1))

        def test(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            many = start[a + 1] - start[a]
            if not len(held) or not many.any():
                return np.ones(len(a), bool)
            asked = np.repeat(b, many) * width + rank[spread(start[a], many)]
            at = np.searchsorted(held, asked)
            hit = held[np.minimum(at, len(held) - 1)] == asked
            return np.bincount(np.repeat(np.arange(len(a)), many), hit, len(a)) == 0

        return test

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["group", "id", "partners"], (pa.int64(), pa.int64(), pa.binary())
        waiting: list[tuple] = []

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*waiting, strict=True), kinds, strict=True)], names=names)

        for t in sorted_runs(batches, "group"):
            ids, at = np.unique(t["id"].to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            order = np.argsort(t["n"].to_numpy()[at], kind="stable")
            ids, t = ids[order], t.take(pa.array(at[order]))
            side = t["side"].to_numpy()
            sizes = t["n"].to_numpy()
            s = as_samples(t["samples"])
            filled = s > 0
            home = None
            kept = []
            for a, b in pairs_of(sizes, side):
                eq = (s[a] == s[b]) & filled[a]
                good = eq.sum(1) >= AGREE * (filled[a] | filled[b]).sum(1)
                if not good.any():
                    continue
                home = home or first_here(t["homes"], t["bucket"][0].as_py())
                a, b = a[good], b[good]
                mine = home(a, b)
                kept.append((a[mine], b[mine]))
            if not kept:
                continue
            a, b = (np.concatenate(z) for z in zip(*kept, strict=True))
            if not len(a):
                continue
            cuts = np.searchsorted(a, np.arange(len(ids) + 1))
            used = np.zeros(len(ids), bool)
            used[a] = used[b] = True
            group = t["group"][0].as_py()
            waiting += [(group, int(ids[i]), ids[b[cuts[i] : cuts[i + 1]]].tobytes()) for i in np.flatnonzero(used).tolist()]
            if len(waiting) > 4096:
                yield told()
                waiting = []
        if waiting:
            yield told()

    return run


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """docs(id, text) -> id, n (size of the set), same (digest of the set, null for an empty one), samples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = shingle_sets(batch.column(1), k)
            same = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int32()), pa.array(same, pa.binary()), pa.array([sample(x).tobytes() for x in sets], pa.binary())], names=["id", "n", "same", "samples"])

    return docs.mapInArrow(tidy(run), "id long, n int, same binary, samples binary")


def overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of the pairs of sets."""
    if len(a) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a.tolist(), b.tolist(), strict=True)], np.int64)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    row = row[shared]
    wide = int(column.max()) + 1 if len(column) else 0
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, wide, 2048):
        p, q = np.searchsorted(column, [lo, lo + 2048])
        m = np.zeros((len(sets), 2048), np.float32)
        m[row[p:q], column[p:q] - lo] = 1
        total += m @ m.T
    return total[a, b].astype(np.int64)


def verify(k: int, threshold: float):
    """Rows (group, id, partners, weight, text), sorted by group, at most two blocks in one -> (id, links, root): the links of each document by weight, and the smallest document linked to it within the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_runs(batches, "group"):
            ids, at = np.unique(t["id"].to_numpy(), return_index=True)
            t = t.take(pa.array(at))
            weights = t["weight"].to_numpy()
            partners = [np.frombuffer(x, np.int64) for x in t["partners"].to_pylist()]
            a = np.repeat(np.arange(len(ids)), [len(x) for x in partners])
            b = np.searchsorted(ids, np.concatenate(partners)) if len(partners) else a
            sets = [x for piece in pieces(iter(t.select(["text"]).combine_chunks().to_batches())) for x in shingle_sets(piece.column(0), k)]
            sizes = np.array([len(x) for x in sets])
            both = overlaps(sets, a, b)
            # as numbers: both / (sum - both) >= threshold
            ok = both >= threshold * (sizes[a] + sizes[b] - both) - 1e-9
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            links = np.bincount(a, weights[b], len(ids)) + np.bincount(b, weights[a], len(ids))
            root = np.arange(len(ids))
            while True:  # smallest linked number, to the fixpoint
                low = root.copy()
                np.minimum.at(low, a, root[b])
                np.minimum.at(low, b, root[a])
                low = low[low]
                if (low == root).all():
                    break
                root = low
            hit = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(links[hit].astype(np.int64)), pa.array(ids[root[hit]])], names=["id", "links", "root"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> id, root: the smallest id of each connected component, by spreading minima and jumping pointers until nothing changes."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("low"))
        least = labels.join(near, "id").select("id", F.least("root", "low").alias("root"), F.col("root").alias("was"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("far"))
        after = stored(least.join(jump, "root", "left").select("id", F.least("root", F.coalesce("far", "root")).alias("root"), "was"), "labels")
        if after.where("root <> was").isEmpty():
            return after.select("id", "root")
        labels = after.select("id", "root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, threshold: float = 0.8, recall: float = RECALL) -> DataFrame:
    """One row a document: key, class_id, copy_of (the smallest document with the same shingles), n_links."""
    spark = docs.sparkSession
    n = parts(spark)
    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    texts = rows.where("id is not null")
    if rows_repeat(rows):  # rows with one id are one document
        texts = texts.groupBy("id").agg(F.min("text").alias("text"))
    one = stored(sketch(texts, k), "sketch")
    groups = stored(one.where("same is not null").groupBy("same").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("n").alias("n"), F.first("samples").alias("samples")), "groups")
    sets = groups.select(F.col("rep").alias("id"), "weight", "n", "samples")

    leaves = leaf_buckets(sets, runs_for(threshold, recall), threshold)
    homes = leaves.groupBy("id").agg(F.sort_array(F.collect_set("bucket")).alias("homes"))  # a few for each run
    # a leaf of several blocks is compared in pairs of blocks
    large = F.col("blocks") > 1
    mine = F.pmod(F.xxhash64("id", "bucket"), F.col("blocks"))
    none = F.lit(-1).cast("long")
    other = F.explode(F.when(large, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(none)))
    dealt = leaves.withColumn("mine", F.when(large, mine).otherwise(none)).withColumn("other", other)
    dealt = dealt.select(
        F.when(large, F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other"))).otherwise(F.col("bucket")).alias("group"),
        "bucket", "id", F.when(F.col("mine") != F.col("other"), F.col("mine")).otherwise(none).alias("side"),
    )
    ready = dealt.join(sets.join(homes, "id").select("id", "n", "samples", "homes"), "id").select("group", "bucket", "id", "n", "samples", "homes", "side")
    ready = ready.repartition(n, "group").sortWithinPartitions("group")
    found = stored(ready.mapInArrow(tidy(compare(threshold)), "group long, id long, partners binary"), "pairs")

    wanted = found.join(sets.select("id", "weight"), "id").join(texts, "id").select("group", "id", "partners", "weight", "text").repartition(n, "group").sortWithinPartitions("group")
    linked = stored(wanted.mapInArrow(tidy(verify(k, threshold)), "id long, links long, root long"), "links")

    roots = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = linked.groupBy("id").agg(F.sum("links").alias("links"))
    classes = groups.select("same", "rep", "weight").join(counted, F.col("rep") == F.col("id"), "left").drop("id").join(roots, F.col("rep") == F.col("id"), "left")
    classes = classes.select("same", "rep", F.coalesce("root", "rep").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
    columns = [F.col("id").alias(key), F.col("root").alias("class_id"), F.col("rep").alias("copy_of"), F.col("links").alias("n_links")]
    # many copies of one text split there: the join's other side has one row a text
    members = one.where("same is not null").select("id", "same").join(classes, "same").select(*columns)
    alone = one.where("same is null").select("id", F.col("id").alias("root"), F.col("id").alias("rep"), F.lit(0).cast("long").alias("links"))
    none_ = rows.where("id is null").select("id", F.col("id").alias("root"), F.col("id").alias("rep"), F.lit(0).cast("long").alias("links"))
    return members.unionByName(alone.unionByName(none_).select(*columns))


def rows_repeat(rows: DataFrame) -> bool:
    """Whether some id has several rows."""
    return not rows.where("id is not null").groupBy("id").count().where("count > 1").isEmpty()


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of docs of one document of each class, all columns as they are: the smallest id; rows with a null id stay."""
    found = near_duplicates(docs, key, text, **how)
    out = found.where(F.col(key) != F.col("class_id")).select(F.col(key).alias("gone_id"))
    return docs.join(out, docs[key] == out["gone_id"], "left_anti")
