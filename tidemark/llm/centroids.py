"""Centroid clustering by weighted deduplication.

Vectors are turned into integers and equal ones grouped with their number, so that Lloyd's rounds run on
distinct vectors: each task assigns its own to the nearest centroid (squared Euclidean distance, ties to the
smaller number) and sums them by their weights, as integers of any length; k times dims sums reach the driver.
Centroids are the exact floors of the sums over the counts, so partitions and order do not bear on them.
Assignments are then joined back to the rows by the vector; copies beyond a part of an average partition are
dealt out over several keys.

Centroids start as the k rows with the smallest SHA-256 of `seed:id`, in that order (repeated rows of one id
by the bytes of their vectors; each is a centroid, of which the first wins).  With fewer rows there are fewer centroids; empty ones
stay where they are.  Vectors of another length, or with null or non-finite components, are left out; rows with a
null id are assigned but never a first centroid (without any other row their cluster is null).  Other columns
are not read, so none can clash; an empty table gives an empty result.  Distances beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, stored
from .kernel import tidy
from .quantised import KIND, products, quantised, unpacked

ROWS = 8192
#: Copies of a vector beyond this part of an average partition are dealt out.
PART = 4


def nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector."""
    side = 2 * max(int(np.abs(q).max(initial=0)), int(np.abs(centroids).max()))
    if q.shape[1] * side * side >= 1 << 62:
        raise OverflowError("squared distances leave 64 bits")
    far = (q * q).sum(1)[:, None] - 2 * products(q, centroids) + (centroids * centroids).sum(1)
    at = far.argmin(1)
    return at, far[np.arange(len(q)), at]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            yield part, unpacked(part.column(0))


def summed(centroids: np.ndarray):
    """(q, n) -> a task's (cluster, place, total): the number of its vectors at place 0, then the sum of each component."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), object)
        for part, q in slices(batches):
            at, _ = nearest(q, centroids)
            n = part.column(1).to_numpy()
            held = np.zeros((k, len(n)), np.int64)
            held[at, np.arange(len(n))] = n
            total[:, 0] += held.sum(1).astype(object)
            total[:, 1:] += products(held, q.T).astype(object)
        own = np.flatnonzero(total[:, 0] != 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(own, dims + 1), pa.int32()), pa.array(np.tile(np.arange(dims + 1), len(own)), pa.int32()), pa.array([Decimal(x) for x in total[own].ravel().tolist()], pa.decimal128(38, 0))],
            names=["cluster", "place", "total"],
        )

    return run


def assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, q in slices(batches):
            at, far = nearest(q, centroids)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(at, pa.int32()), pa.array(far)], names=["q", "n", "cluster", "distance"])

    return run


def moved(distinct: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: the floors of the means of each centroid's vectors, the old place where it has none."""
    sums = distinct.mapInArrow(tidy(summed(centroids)), "cluster int, place int, total decimal(38,0)").groupBy("cluster", "place").agg(F.sum("total").alias("total"))
    out = centroids.astype(object)
    got = {(r["cluster"], r["place"]): int(r["total"]) for r in sums.collect()}  # k x (dims + 1) rows
    for (c, place), total in got.items():
        if place:
            out[c, place - 1] = total // got[c, 0]
    return out.astype(np.int64)


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(key, cluster int, distance long of each row; cluster int, centroid array<long>, n_rows long, inertia decimal of each centroid, empty ones too)."""
    spark = df.sparkSession
    rows = quantised(df, key, vector, scale, dims)
    distinct = stored(rows.groupBy("q").agg(F.count(F.lit(1)).alias("n")), "vectors")
    first = rows.where("id is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256).alias("h"), "q").orderBy("h", "q").limit(k).collect()  # k rows
    kind = "cluster int, centroid array<long>, n_rows long, inertia decimal(38,0)"
    if not first:
        none = F.lit(None)
        return rows.select(F.col("id").alias(key), none.cast("int").alias("cluster"), none.cast("long").alias("distance")), spark.createDataFrame([], kind)
    centroids = np.array([np.frombuffer(r["q"], KIND) for r in first]).astype(np.int64)
    for _ in range(rounds):
        centroids = moved(distinct, centroids)
    found = stored(distinct.mapInArrow(tidy(assigned(centroids)), "q binary, n long, cluster int, distance long"), "assigned")
    each = found.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum(F.col("n").cast("decimal(19,0)") * F.col("distance")).cast("decimal(38,0)").alias("inertia"))
    told = {r["cluster"]: (r["n"], r["inertia"]) for r in each.collect()}  # k rows
    centres = spark.createDataFrame([(i, c, *told.get(i, (0, Decimal(0)))) for i, c in enumerate(centroids.tolist())], kind)
    return joined_back(rows, found, sum(n for n, _ in told.values())).withColumnRenamed("id", key), centres


def joined_back(rows: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """id, cluster, distance of the rows. A vector with more copies than a part of an average partition has as many keys as parts; of such there are at most PART times the partitions."""
    much = max(1, total // (PART * parts(rows.sparkSession)))
    pieces = F.ceil(F.col("n") / F.lit(much)).cast("long")
    hot = found.where(F.col("n") > much).select("q", pieces.alias("pieces"))
    turn = F.when(F.col("pieces").isNotNull(), F.pmod("at", "pieces")).otherwise(0)
    dealt = rows.withColumn("at", F.monotonically_increasing_id()).join(F.broadcast(hot), "q", "left").select("q", turn.alias("turn"), "id")
    copies = F.when(F.col("n") > much, F.sequence(F.lit(0).cast("long"), pieces - 1)).otherwise(F.array(F.lit(0).cast("long")))
    return dealt.join(found.select("q", F.explode(copies).alias("turn"), "cluster", "distance"), ["q", "turn"]).select("id", "cluster", "distance")


def oracle(k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64, seed: int = 1) -> str:
    """The contract's rows in SQL."""
    near = lambda r: (
        f"d{r} AS (SELECT v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance FROM v JOIN c{r} c USING (i) GROUP BY ALL), "
        f"a{r} AS (SELECT vec_id, cluster, distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS t FROM d{r}) WHERE t = 1)"
    )
    steps = [
        f"o AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0)",
        f"v AS (SELECT vec_id, unnest(generate_series(1, {dims})) AS i, floor({scale} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM o)",
        f"s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster FROM o WHERE vec_id IS NOT NULL ORDER BY cluster LIMIT {k})",
        "c0 AS (SELECT cluster, i, x FROM s JOIN v USING (vec_id))",
    ]
    for r in range(rounds):
        steps += [near(r), f"m{r} AS (SELECT cluster, i, floor(sum(x) / count(*))::BIGINT AS x FROM a{r} JOIN v USING (vec_id) GROUP BY ALL)", f"c{r + 1} AS (SELECT cluster, i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (cluster, i))"]
    steps += [near(rounds), f"h AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)"]
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256 FROM a{rounds} JOIN h USING (cluster)"
    )
