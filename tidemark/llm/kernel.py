"""Vectorised word scanning and Rabin-Karp hashing over Arrow string columns.

A *word* is a maximal run of bytes outside 0x20 and 0x09-0x0D.  UTF-8 continuation bytes
never fall in that set, so byte offsets cut code points nowhere.  Nulls count as empty texts.
A word of up to 7 bytes is its own hash (its bytes and their number, mixed by a bijection), so short
words never share one; a longer word has a 64-bit SipHash of its bytes, taken once for each distinct
word.  Windows of words are hashed by a polynomial modulo 2**64 over the hashes of their words, from
prefix sums, in segments of bounded size.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SEGMENT = 1 << 18
_U = np.uint64
_WORD_BASE = 0xD6E8FEB86659FD93
#: Key of the hash of long words; any 16 characters.
_KEY = "0123456789abcdef"
SHORT = 7
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1024, 2 * (0 if have is None else len(have)))
        steps = np.full(size, base, _U)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


@dataclass
class Words:
    """data: the UTF-8 bytes; offsets: n + 1 document bounds; start, end, doc: one entry a word."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    @property
    def docs(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.docs).astype(np.int64)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word; data: other bytes of the same length, such as lower-cased ones."""
        return byte_hashes(self.data if data is None else data, self.start, self.end)


def distinct_strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct strings data[start[i]:end[i]] as bytes, the number of each one's string); strings are ascending and apart."""
    n = len(start)
    bounds = np.empty(2 * n + 1, np.int64)
    bounds[0 : 2 * n : 2], bounds[1 : 2 * n : 2] = start, end
    bounds[2 * n] = end[-1] if n else 0
    every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * n, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = every.take(pa.array(np.arange(0, 2 * n, 2))).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each string data[start[i]:end[i]]: of up to SHORT bytes without collisions, else SipHash."""
    from pandas.util import hash_array

    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    block = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))[start]
    bits = (np.minimum(size, SHORT) << 3).astype(_U)
    out = mix(block & ((_U(1) << bits) - _U(1)) | size.astype(_U) << _U(56))
    long = np.flatnonzero(size > SHORT)
    if len(long):
        strings, which = distinct_strings(data, start[long], end[long])
        out[long] = hash_array(strings, hash_key=_KEY, categorize=False)[which]
    return out


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and n + 1 offsets from 0; nulls become empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    bounds = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    bounds = bounds.astype(np.int64)
    buf = col.buffers()[2] if len(col) else None
    data = np.frombuffer(buf, np.uint8)[bounds[0] : bounds[-1]] if buf is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def scan(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> Words:
    """The words of each document. inside: bytes (by value) that make up a word; by default all but white space."""
    keep = ~SPACE[data] if inside is None else inside[data]
    n = len(data)
    first = np.empty(n, bool)
    last = np.empty(n, bool)
    if n:
        first[0] = last[-1] = True
        np.logical_not(keep[:-1], out=first[1:])
        np.logical_not(keep[1:], out=last[:-1])
        cuts = offsets[(offsets > 0) & (offsets < n)]
        first[cuts] = True
        last[cuts - 1] = True
    start = np.flatnonzero(keep & first)
    end = np.flatnonzero(keep & last) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(data, offsets, start, end, doc)


def words_of(col: pa.Array) -> Words:
    return scan(*text_bytes(col))


def windows(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of every k consecutive words of one document: (index of the first word, hash)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    out = np.empty(n, _U)
    inv = inverse(_WORD_BASE)
    for lo in range(0, n, SEGMENT):
        m = min(SEGMENT, n - lo)
        sums = np.zeros(m + k, _U)
        np.cumsum(hashes[lo : lo + m + k - 1] * powers(_WORD_BASE, m + k - 1), out=sums[1:])
        out[lo : lo + m] = (sums[k:] - sums[:m]) * powers(inv, m)
    at = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :])
    return at, mix(out[at])


def release() -> None:
    """Gives memory that is no longer used back to the system: workers live on between tasks."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *ends: Callable[[], None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, after which `ends` are called and the worker's memory is given back."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for f in ends:
                f()
            release()

    return whole


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the runs starts[i] .. starts[i] + sizes[i] - 1, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most `most` bytes of text each; a longer text is a slice by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(sizes)
        lo = 0
        while lo < batch.num_rows:
            base = total[lo] - sizes[lo]
            hi = max(lo + 1, int(np.searchsorted(total, base + most, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """From a stream sorted by the key, the rows of each key as one table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def aligned(batches: Iterator[pa.RecordBatch], key: str, rows: int = 8192) -> Iterator[pa.Table]:
    """A stream sorted by the key in tables of about `rows` rows that no key is cut by."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            table = pa.Table.from_batches(held)
            keys = table[key].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
            count = len(keys) - cut
    if held:
        yield pa.Table.from_batches(held)
