"""Vectors of integers: components scaled and floored, packed as 32-bit numbers, and exact inner products of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KIND = "<i4"
#: Products below this are exact in double precision, where matrices are multiplied fastest.
EXACT = 1 << 53


def packed(col: pa.Array, scale: int, dims: int | None) -> tuple[np.ndarray, pa.Array]:
    """(which rows take part, their floor(scale * x) as packed 32-bit numbers)."""
    there = np.flatnonzero(col.is_valid().to_numpy(zero_copy_only=False))
    some = col.take(pa.array(there))
    sizes = pc.list_value_length(some).to_numpy(zero_copy_only=False).astype(np.int64)
    x = some.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    ends = np.cumsum(sizes)
    good = bad[ends] == bad[ends - sizes]
    if dims is not None:
        good &= sizes == dims
    x = np.floor(x[np.repeat(good, sizes)] * scale)
    if len(x) and max(-x.min(), x.max()) >= 1 << 31:
        raise OverflowError(f"a component times {scale} leaves 32 bits")
    bounds = np.concatenate([[0], np.cumsum(sizes[good])]).astype(np.int32) * np.dtype(KIND).itemsize
    return there[good], pa.BinaryArray.from_buffers(pa.binary(), int(good.sum()), [None, pa.py_buffer(bounds), pa.py_buffer(x.astype(KIND))])


def quantised(df: DataFrame, key: str, vector: str, scale: int, dims: int | None = None) -> DataFrame:
    """id long, q binary: the rows whose vector (of `dims` components, if given) holds neither nulls nor non-finite numbers, each component x as floor(scale * x). One beyond 32 bits is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, q = packed(batch.column(1), scale, dims)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), q], names=["id", "q"])

    return df.select(df[key].cast("long").alias("id"), df[vector].alias("vec")).where(F.col("vec").isNotNull()).mapInArrow(run, "id long, q binary")


def unpacked(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Packed vectors of one length as a matrix of 64-bit integers."""
    rows = col.to_pylist()
    return np.frombuffer(b"".join(rows), KIND).astype(np.int64).reshape(len(rows), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner products of the rows of two integer matrices, exact, as 64-bit integers; an error where they might leave these."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a).sum(1, dtype=np.float64).max() * 1.000001) * int(np.abs(b).max())
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 1 << 63:
        raise OverflowError("inner products leave 64 bits")
    return a @ b.T
