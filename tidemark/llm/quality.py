"""Quality rules: fixed measures of every text and a likelihood ratio of hashed n-grams.

The ratio compares two multinomials over hashed byte n-grams (n = 3): one counted over the trusted
documents (labelled good), one over the whole raw corpus, both with add-one smoothing.  A document's
score is its mean log ratio, so long and short texts compare; it is kept if the score reaches a fixed
threshold and no base rule fails it.  All counts cover all documents; ratios are rounded to 2**-20 and
summed as integers, so the verdict depends on neither batching nor order.

Null and empty texts have no words: base_failed.  Without a single trusted document there is no
ratio: the base rules alone decide.  Repeated rows are counted and judged as often as they come; a null id is never
trusted.  judge_quality reads the key and the text only, keep_good passes all columns on as they are, whatever their
names.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fits, sum_blocks
from .kernel import SPACE, mix, pieces, scan, text_bytes, tidy, windows

BITS = 14
BUCKETS = 1 << BITS
BLOCKS = 16
#: Mean log ratio (natural) below which a document is rejected.
THRESHOLD = -0.5
SCALE = 1 << 20
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Trusted ids up to this many are broadcast (some 10 MB); more are joined by a shuffle.
MOST_BROADCAST = 300_000

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the byte trigram that starts at each byte, whether it lies within one document)."""
    n = max(len(data) - 2, 0)
    d = data.astype(np.uint32)
    bucket = ((d[:n] << 16 | d[1 : n + 1] << 8 | d[2 : n + 2]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    inside = np.ones(n, bool)
    cuts = offsets[1:-1]
    for back in (1, 2):
        at = cuts - back
        inside[at[(at >= 0) & (at < n)]] = False
    return bucket.astype(np.int64), inside


def base_measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    words = scan(data, offsets)
    at, hashes = windows(words.hashes(), words.doc, 3)
    _, which, times = np.unique(hashes ^ mix(words.doc[at].astype(np.uint64)), return_inverse=True, return_counts=True)
    twice = at[times[which] > 1] if len(at) else at
    covered = np.zeros(len(words.start), bool)
    for k in range(3):
        covered[twice + k] = True
    raw = data.tobytes()
    lines = np.zeros(words.docs, np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        each = raw[a:b].split(b"\n")
        if len(each) > 1:
            each = [x for x in each if x.strip(b" \t\n\x0b\x0c\r")]
            lines[i] = len(each) - len(set(each))
    return {
        "n_words": words.counts(),
        "word_chars": per_doc(~SPACE[data] & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_doc(SYMBOLS[data], offsets),
        "n_dup_lines": lines,
        "n_repeat_words": np.bincount(words.doc[covered], minlength=words.docs).astype(np.int64),
    }


def count_ngrams(docs: DataFrame, text: str, trusted: str) -> tuple[np.ndarray, np.ndarray]:
    """(target counts, raw counts) of all hashed n-grams of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in pieces(batches):
            data, offsets = text_bytes(batch.column(0))
            good = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            bucket, inside = ngrams(data, offsets)
            sums[1] += np.bincount(bucket[inside], minlength=BUCKETS)
            of_good = np.repeat(good, np.diff(offsets))[: len(bucket)]
            sums[0] += np.bincount(bucket[inside & of_good], minlength=BUCKETS)
        if sums.any():
            cut = sums.reshape(2 * BLOCKS, -1)
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"block": pa.array(range(2 * BLOCKS), pa.int32()), "part": pa.array([part] * 2 * BLOCKS, pa.int32()), "sums": pa.array([x.tobytes() for x in cut], pa.binary())})

    counted = docs.select(F.col(text).alias("text"), F.col(trusted).alias("good")).mapInArrow(tidy(run), "block int, part int, sums binary")
    sums = np.zeros((2 * BLOCKS, BUCKETS // BLOCKS), np.int64)
    for r in sum_blocks(counted).collect():  # 32 rows, however large the corpus
        sums[r["block"]] = np.frombuffer(r["sums"], np.int64)
    return tuple(sums.reshape(2, BUCKETS))


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray | None:
    """The fixed-point log ratio of each bucket, or None without any trusted n-gram."""
    if not target.sum():
        return None
    ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return np.rint(ratio * SCALE).astype(np.int64)


def trusted(labels: DataFrame) -> DataFrame:
    """good_id of the documents all of whose labels say quality 1."""
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select(F.col("doc_id").alias("good_id"))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray | None:
    """The ratios. Few trusted ids are broadcast and all texts read once; many are joined, so that only trusted texts are shuffled, and all texts read again for the raw counts."""
    texts, good = docs.select(docs[key].alias("id"), docs[text].alias("text")), trusted(labels)
    if fits(good, MOST_BROADCAST):
        marked = texts.join(F.broadcast(good), F.col("id") == F.col("good_id"), "left").select("text", F.col("good_id").isNotNull().alias("good"))
        return log_ratios(*count_ngrams(marked, "text", "good"))
    target, _ = count_ngrams(texts.join(good, F.col("id") == F.col("good_id"), "left_semi").select("text", F.lit(True).alias("good")), "text", "good")
    _, raw = count_ngrams(texts.select("text", F.lit(False).alias("good")), "text", "good")
    return log_ratios(target, raw)


def verdicts(data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray | None, threshold: float = THRESHOLD) -> dict[str, np.ndarray]:
    out = base_measures(data, offsets)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    if ratios is None:
        out["log_ratio"] = np.zeros(len(offsets) - 1)
    else:
        bucket, inside = ngrams(data, offsets)
        padded = np.zeros(len(data), np.int64)
        padded[: len(bucket)] = np.where(inside, ratios[bucket], 0)
        count = np.maximum(np.diff(offsets) - 2, 1)
        out["log_ratio"] = per_doc(padded, offsets) / count / SCALE
    out["kept"] = ~out["base_failed"] & (out["log_ratio"] >= threshold)
    return out


def judge_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: the key, the base measures, base_failed, kept, log_ratio."""
    ratios = learn(docs, labels, key, text)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio"]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, log_ratio double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = verdicts(*text_bytes(batch.column(1)), ratios, threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[x]) for x in names)], names=[key, *names])

    return docs.select(docs[key], docs[text].alias("text")).mapInArrow(tidy(run), schema)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are kept, all columns as they are."""
    ratios = learn(docs, labels, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            found = verdicts(*text_bytes(batch.column(batch.schema.get_field_index(text))), ratios, threshold)
            yield batch.filter(pa.array(found["kept"]))

    return docs.mapInArrow(tidy(run), docs.schema)
