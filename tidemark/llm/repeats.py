"""Removal of passages that repeat across documents.

Rabin-Karp hashes of every window of k words are counted in Spark, in two rounds.  Texts are dealt once into
chunks by a hash of the row.  First each chunk sends a short print of each distinct window hash to the
hash's bucket, which answers one bit an entry: is the print met more than once?  Of those windows alone
the chunk (the same exchange, used again) then sends two hashes, 128 bits, with the smallest document id of the
chunk, and is told which of them start in a smaller document of another chunk.  So a window that a third of all documents
hold costs a bucket one entry a chunk, not one a document, and windows are told apart by 128 bits
(within a chunk, of some million windows, by 64).  The chunk, used a third time, merges repeated windows into maximal removal intervals.

Null texts have no words.  Rows with the same id do not remove from one another; a null id counts as the
largest.  A text shorter than k words keeps all.  Columns other than id and text are not read, so none can clash;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import Words, mix, release, scan, spread, text_bytes, windows

#: Text bytes of a chunk: at most CHUNK, less for small inputs, so that there are some tasks.
CHUNK, LEAST_CHUNK, SOME_CHUNKS = 8 << 20, 1 << 20, 64
#: Windows of a bucket, about; bytes of text a word, about. Buckets are a power of two, from 2**8 on; 2**31 of them would hold 10**15 windows.
BUCKET, WORD_BYTES, MOST_BITS = 1 << 19, 6, 31
LARGEST = (1 << 63) - 1


class Chunk:
    """The windows of a chunk: at (first word), which (number of its distinct hash); the distinct hashes by first place, grouped by bucket."""

    def __init__(self, table: pa.Table, k: int, bits: int, ids_too: bool = True) -> None:
        ids = table["id"].combine_chunks()
        self.k = k
        self.nulls = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(LARGEST).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        self.ids, self.nulls = ids[order], self.nulls[order]
        data, offsets = text_bytes(table["text"].take(pa.array(order)))
        self.words: Words = scan(data, offsets)
        self.word_hashes = self.words.hashes()
        self.at, hashes = windows(self.word_hashes, self.words.doc, k)
        if not ids_too:  # the distinct hashes will do
            self.hashes = np.unique(hashes)
            self.bucket = self._bucket(self.hashes, bits)
            return
        self.doc = self.words.doc[self.at]
        distinct, self.first, self.which = np.unique(hashes, return_index=True, return_inverse=True)
        bucket = self._bucket(distinct, bits)
        # by bucket and hash, as the distinct hashes are
        self.hashes, self.bucket = distinct, bucket
        self.least = self.ids[self.doc[self.first]]  # by number of the distinct hash

    @staticmethod
    def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
        return (hashes >> np.uint64(64 - bits)).astype(np.int64)

    def blocks(self) -> list[tuple[int, int, int]]:
        """(bucket, from, to) of the distinct hashes."""
        cuts = [0, *(np.flatnonzero(np.diff(self.bucket)) + 1).tolist(), len(self.bucket)]
        return [(int(self.bucket[a]), a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]

    def shared(self, answers: pa.Table, column: str = "shared") -> np.ndarray:
        """Which of the distinct hashes the buckets say are met more than once."""
        out = np.zeros(len(self.hashes), bool)
        told = dict(zip(answers["bucket"].to_pylist(), answers[column].to_pylist(), strict=True))
        for n, a, b in self.blocks():
            if n in told:
                out[a:b] = np.unpackbits(np.frombuffer(told[n], np.uint8), count=b - a).astype(bool)
        return out

    def sent(self, shared: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(bucket, the shared ones of its distinct hashes by first place, so that ids ascend)."""
        return [(n, each[np.argsort(self.first[each], kind="stable")]) for n, a, b in self.blocks() if len(each := a + np.flatnonzero(shared[a:b]))]

    def seconds(self) -> np.ndarray:
        """Another hash of each distinct window."""
        _, hashes = windows(mix(self.word_hashes ^ np.uint64(0xA0761D6478BD642F)), self.words.doc, self.k)
        return hashes[self.first]


def pack_ids(ids: np.ndarray) -> bytes:
    """Ascending ids as the first and the steps, in as few bytes a step as hold the largest."""
    steps = np.diff(ids)
    most = int(steps.max()) if len(steps) else 0
    size = next(s for s in (1, 2, 4, 8) if most < 1 << min(8 * s, 63) or s == 8)
    return bytes([size]) + ids[:1].tobytes() + steps.astype(f"<u{size}").tobytes()


def unpack_ids(raw: bytes) -> np.ndarray:
    size = raw[0]
    first = np.frombuffer(raw, "<i8", 1, 1)
    return np.concatenate([first, first + np.cumsum(np.frombuffer(raw, f"<u{size}", -1, 9).astype(np.int64))])


def print_bytes(windows_in_all: int, bits: int) -> int:
    """Bytes of a print besides the bucket's bits, so that one in some thousand windows that occur once is taken for more."""
    return min(8, max(2, -(-(windows_in_all.bit_length() + 12 - bits) // 8)))


def prints(hashes: np.ndarray, bits: int, width: int) -> np.ndarray:
    """(n, width) bytes: those of each hash after its bucket's bits."""
    low = (hashes << np.uint64(bits)) >> np.uint64(64 - 8 * width)
    return np.ascontiguousarray(low.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]


def send_prints(k: int, bits: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        c = Chunk(table, k, bits, ids_too=False)
        low, blocks = prints(c.hashes, bits, width), c.blocks()
        out = pa.table({"bucket": pa.array([n for n, _, _ in blocks], pa.int64()), "chunk": pa.array([table["chunk"][0].as_py()] * len(blocks), pa.int64()), "prints": pa.array([low[a:b].tobytes() for _, a, b in blocks], pa.binary())})
        release()
        return out

    return run


def answer_prints(width: int):
    """The prints of a bucket, all chunks' -> of each chunk, which are met more than once."""

    def run(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, width) for x in table["prints"]]
        sizes = np.array([len(x) for x in rows])
        full = np.zeros((int(sizes.sum()), 8), np.uint8)
        full[:, :width] = np.concatenate(rows)
        del rows
        found = full.view(np.uint64).ravel()
        ordered = np.sort(found)
        same = ordered[1:] == ordered[:-1]
        many = np.unique(ordered[1:][same])
        at = np.searchsorted(many, found)
        bit = (many[np.minimum(at, len(many) - 1)] == found) if len(many) else np.zeros(len(found), bool)
        ends = np.cumsum(sizes).tolist()
        out = [(c, np.packbits(bit[e - n : e]).tobytes()) for c, e, n in zip(table["chunk"].to_pylist(), ends, sizes.tolist(), strict=True) if bit[e - n : e].any()]
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "bucket": pa.array([table["bucket"][0].as_py()] * len(out), pa.int64()), "shared": pa.array([x[1] for x in out], pa.binary())})

    return run


def send(k: int, bits: int):
    drop = bits // 8

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows or not answers.num_rows:
            return pa.table({"bucket": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()), "hashes": pa.array([], pa.binary()), "ids": pa.array([], pa.binary()), "shared": pa.array([], pa.binary())})
        c = Chunk(texts, k, bits)
        told = dict(zip(answers["bucket"].to_pylist(), answers["shared"].to_pylist(), strict=True))
        low = np.ascontiguousarray(c.hashes).view(np.uint8).reshape(-1, 8)[:, : 8 - drop]
        both = np.hstack([low, np.ascontiguousarray(c.seconds()).view(np.uint8).reshape(-1, 8)])
        out = [(n, both[each].tobytes(), pack_ids(c.least[each]), told[n]) for n, each in c.sent(c.shared(answers))]
        release()
        return pa.table({"bucket": pa.array([x[0] for x in out], pa.int64()), "chunk": pa.array([texts["chunk"][0].as_py()] * len(out), pa.int64()), "hashes": pa.array([x[1] for x in out], pa.binary()), "ids": pa.array([x[2] for x in out], pa.binary()), "shared": pa.array([x[3] for x in out], pa.binary())})

    return run


def answer(bits: int):
    """The windows of a bucket, all chunks' -> of each chunk, which start in a smaller document of another."""
    width = 8 - bits // 8

    def run(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, width + 8) for x in table["hashes"]]
        sizes = np.array([len(x) for x in rows])
        full = np.zeros((int(sizes.sum()), 16), np.uint8)
        stacked = np.concatenate(rows)
        full[:, :width], full[:, 8:] = stacked[:, :width], stacked[:, width:]
        del rows, stacked
        first, second = full.view(np.uint64).T
        ids = np.concatenate([unpack_ids(x.as_py()) for x in table["ids"]])
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        least = np.minimum.reduceat(ids[order], starts)
        bit = np.empty(len(ids), bool)
        bit[order] = np.repeat(least, np.diff([*starts, len(ids)])) < ids[order]
        ends = np.cumsum(sizes).tolist()
        out = [(c, x, np.packbits(bit[e - n : e]).tobytes()) for c, x, e, n in zip(table["chunk"].to_pylist(), table["shared"].to_pylist(), ends, sizes.tolist(), strict=True) if bit[e - n : e].any()]
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "bucket": pa.array([table["bucket"][0].as_py()] * len(out), pa.int64()), "shared": pa.array([x[1] for x in out], pa.binary()), "bits": pa.array([x[2] for x in out], pa.binary())})

    return run


def cut(k: int, bits: int, with_text: bool):
    """Of a chunk and the answers to it, one row a document."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(texts, k, bits)
        words = c.words
        told = dict(zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist(), strict=True))
        elsewhere = np.zeros(len(c.hashes), bool)  # by number of the distinct hash
        for n, each in c.sent(c.shared(answers)):
            if n in told:
                elsewhere[each] = np.unpackbits(np.frombuffer(told[n], np.uint8), count=len(each)).astype(bool)
        repeated = c.at[elsewhere[c.which] | (c.ids[c.doc] > c.least[c.which])] if len(c.at) else c.at
        steps = np.zeros(len(words.start) + 1, np.int32)
        np.add.at(steps, repeated, 1)
        np.add.at(steps, repeated + k, -1)
        gone = np.cumsum(steps)[:-1] > 0
        # maximal intervals: runs of removed words of one document
        new = gone & np.concatenate([[True], ~gone[:-1] | (words.doc[1:] != words.doc[:-1])])[: len(gone)]
        last = gone & np.concatenate([~gone[1:] | (words.doc[1:] != words.doc[:-1]), [True]])[: len(gone)]
        counts = words.counts()
        first_word = np.cumsum(counts) - counts
        a, b = np.flatnonzero(new), np.flatnonzero(last) + 1
        of = words.doc[a]
        bounds = pa.array(np.searchsorted(of, np.arange(words.docs + 1)), pa.int32())
        spans = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays([pa.array((a - first_word[of]).astype(np.int64)), pa.array((b - first_word[of]).astype(np.int64))], ["start", "end"]))
        columns = {
            "id": pa.array(np.where(c.nulls, 0, c.ids), pa.int64(), mask=c.nulls),
            "n_words": pa.array(counts),
            "n_removed": pa.array(np.bincount(words.doc[gone], minlength=words.docs).astype(np.int64)),
            "removed": spans,
        }
        if with_text:
            stay = np.flatnonzero(~gone)
            sizes = words.end[stay] - words.start[stay] + 1
            index = spread(words.start[stay], sizes)
            kept = words.data[np.minimum(index, len(words.data) - 1)] if len(index) else np.zeros(0, np.uint8)
            ends = np.cumsum(sizes)
            kept[ends - 1] = 0x20
            per = np.concatenate([[0], ends])[np.searchsorted(words.doc[stay], np.arange(words.docs + 1))]
            raw = kept.tobytes()
            columns["kept_text"] = pa.array([raw[x : max(x, y - 1)].decode() for x, y in zip(per[:-1].tolist(), per[1:].tolist(), strict=True)], pa.string())
        release()
        return pa.table(columns)

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 13, with_text: bool = True) -> DataFrame:
    """One row a document: key, n_words, n_removed, removed (intervals of word numbers, end exclusive), kept_text (kept words joined by a space).

    A word goes if a window of k words of its document covers it that also starts in a document with a
    smaller id.  The key must be integral.
    """
    total = docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    size = min(CHUNK, max(LEAST_CHUNK, total // SOME_CHUNKS))
    chunks = max(1, -(-total // size))
    bits = min(MOST_BITS, max(8, (total // WORD_BYTES // BUCKET).bit_length()))
    texts = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text")).withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))  # by the text too: rows without an id are dealt out
    width = print_bytes(total // WORD_BYTES, bits)
    chunked = texts.groupBy("chunk")
    met = chunked.applyInArrow(send_prints(k, bits, width), "bucket long, chunk long, prints binary")
    shared = met.groupBy("bucket").applyInArrow(answer_prints(width), "chunk long, bucket long, shared binary")
    sent = chunked.cogroup(shared.groupBy("chunk")).applyInArrow(send(k, bits), "bucket long, chunk long, hashes binary, ids binary, shared binary")
    answers = sent.groupBy("bucket").applyInArrow(answer(bits), "chunk long, bucket long, shared binary, bits binary")
    schema = "id long, n_words long, n_removed long, removed array<struct<start: long, end: long>>" + ", kept_text string" * with_text
    return chunked.cogroup(answers.groupBy("chunk")).applyInArrow(cut(k, bits, with_text), schema).withColumnRenamed("id", key)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT doc_id, ws, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM w),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h FROM t WHERE i + 12 <= len(ws)),
m AS (SELECT h, min(doc_id) AS least FROM g GROUP BY h),
r AS (SELECT g.doc_id, g.i FROM g JOIN m USING (h) WHERE m.least < g.doc_id),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i FROM r),
k AS (SELECT t.doc_id, count(*) FILTER (WHERE c.i IS NOT NULL) AS n_removed,
  string_agg(t.word, ' ' ORDER BY t.i) FILTER (WHERE c.i IS NULL) AS kept
  FROM t LEFT JOIN c ON c.doc_id = t.doc_id AND c.i = t.i GROUP BY t.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""
