"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other; each linear model (logistic, L2) sees the document's
features and the probabilities of the categories before it.  In training those probabilities are out of
fold, features chosen within each fold's training part too, so that later models learn from what earlier ones say
of documents they have not seen.  Features
are the presence of words, of their first 3 to 6 bytes and of runs of marks, hashed, lower-cased; for each
category those most telling by chi-square are used, which a document holds or not, however long it is.

The labels table has two flags, so the registered chain has two categories: low quality, then toxic.

Training uses a bounded sample of labelled documents: at most `sample` of them (those of the smallest seeded hash of
the id; default SAMPLE), and of these, in that order, as many as have `sample_bytes` of text together (default
SAMPLE_BYTES, at least one).  Every document is scored on its whole text.  Null and empty texts have no features.  A category
that the sample holds never, or always, is predicted at that rate; without labels all
probabilities are 0.  Repeated rows are scored each; of a labelled id with several texts the smallest is trained on, and
several labels of one document count as their maximum.  Other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .kernel import mix, pieces, scan, text_bytes, tidy

SAMPLE, SAMPLE_BYTES, FOLDS, FEATURES, LEAST = 5000, 32 << 20, 5, 512, 4
#: Chi-square below which a feature tells nothing (a thousandth of such would, by chance).
TELLING = 10.83
#: Probability from which a category holds.
THRESHOLD = 0.3
PREFIXES = (3, 4, 5, 6)
#: Registered categories, in the order of the chain, as conditions on labels(quality, toxic).
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))
_U = np.uint64

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), 0x5F, *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
MARK = np.zeros(256, bool)
MARK[[x for x in range(0x21, 0x7F) if not WORD[x]]] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of U+00C0 to U+00DE."""
    out = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    if len(data) > 1:
        latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][latin] |= 0x20
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, documents) of every occurrence of a feature, kind after kind."""
    low = lowered(data)
    words = scan(low, offsets, WORD)
    yield words.hashes(), words.doc
    size = words.end - words.start
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    code = np.zeros(len(size), _U)
    for k in range(max(PREFIXES)):
        code = code << _U(8) | padded[words.start + k]
        if k + 1 in PREFIXES:
            long = size > k + 1
            yield mix(code[long] << _U(8) | _U(k + 1)), words.doc[long]
    marks = scan(low, offsets, MARK)
    yield marks.hashes() ^ _U(0x5555), marks.doc


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, l2: float = 2e-4, steps: int = 150) -> np.ndarray:
    """Weights of a logistic model, the last for a constant, by accelerated gradients."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    rate = 4.0 / max(1.0, float((x * x).sum(1).mean()))
    w, v = np.zeros(x.shape[1], np.float64), np.zeros(x.shape[1], np.float64)
    for i in range(steps):
        ahead = w + i / (i + 3) * v
        slope = x.T @ (sigmoid(x @ ahead) - y).astype(np.float32) / len(y)
        slope[:-1] += l2 * ahead[:-1]
        new = ahead - rate * slope
        w, v = new, new - w
    return w


@dataclass
class Chain:
    """Per category: name, hashes of its features (ascending), weights of these, of the categories before it and of the constant."""

    names: list[str]
    hashes: list[np.ndarray]
    weights: list[np.ndarray]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, categories) probabilities."""
        docs = len(offsets) - 1
        known = np.unique(np.concatenate(self.hashes)) if self.hashes else np.zeros(0, _U)
        maybe = np.zeros(1 << 20, bool)
        maybe[(known >> _U(44)).astype(np.int64)] = True
        hits = []
        for h, doc in features(data, offsets):
            near = maybe[(h >> _U(44)).astype(np.int64)]
            h, doc = h[near], doc[near]
            at = np.searchsorted(known, h)
            ok = known[np.minimum(at, len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)
            hits.append(doc[ok] * max(len(known), 1) + at[ok])
        hits = np.unique(np.concatenate(hits))
        doc, which = hits // max(len(known), 1), hits % max(len(known), 1)
        out = np.zeros((docs, len(self.names)))
        for c, (own, w) in enumerate(zip(self.hashes, self.weights, strict=True)):
            by_known = np.zeros(max(len(known), 1))
            by_known[np.searchsorted(known, own)] = w[: len(own)]
            total = np.bincount(doc, by_known[which], docs) + out[:, :c] @ w[len(own) : len(own) + c] + w[-1]
            out[:, c] = sigmoid(total)
        return out


def telling(doc: np.ndarray, column: np.ndarray, y: np.ndarray, use: np.ndarray, features_: int) -> np.ndarray:
    """The features (columns, ascending) that tell y best by chi-square in the documents of `use`."""
    held = use[doc]
    times = np.bincount(column[held], minlength=features_)
    a = np.bincount(column[held], y[doc[held]], features_)
    n, t = float(use.sum()), y[use].sum()
    b, left, right = times - a, t - a, (n - t) - (times - a)
    chi = n * (a * right - b * left) ** 2 / np.maximum(times * (n - times) * t * (n - t), 1)
    chi[times < LEAST] = -1
    return np.sort(np.argsort(-chi, kind="stable")[: min(FEATURES, int((chi >= TELLING).sum()))])


def presence(doc: np.ndarray, column: np.ndarray, best: np.ndarray, docs: int, features_: int) -> np.ndarray:
    place = np.full(features_, -1)
    place[best] = np.arange(len(best))
    x = np.zeros((docs, len(best)), np.float32)
    ok = place[column] >= 0
    x[doc[ok], place[column[ok]]] = 1
    return x


def train(doc: np.ndarray, hashes: np.ndarray, labels: np.ndarray, names: list[str], seed: int = 1) -> Chain:
    """doc, hashes: the distinct features of the training documents; labels: (documents, categories)."""
    docs = len(labels)
    chain = Chain(names, [], [])
    fold = np.random.default_rng(seed).permutation(docs) % FOLDS
    distinct, column = np.unique(hashes, return_inverse=True)
    before = np.zeros((docs, 0), np.float32)
    for c in range(len(names)):
        y = labels[:, c].astype(np.float64)
        if docs == 0 or y.min() == y.max():
            rate = float(np.clip(y.mean() if docs else 0.0, 1e-9, 1 - 1e-9))
            chain.hashes.append(np.zeros(0, _U))
            chain.weights.append(np.concatenate([np.zeros(c), [np.log(rate / (1 - rate))]]))
            before = np.hstack([before, np.full((docs, 1), rate, np.float32)])
            continue
        out = np.zeros((docs, 1), np.float32)
        for f in range(FOLDS):
            use = fold != f
            best = telling(doc, column, y, use, len(distinct))
            x = np.hstack([presence(doc, column, best, docs, len(distinct)), before])
            w = fit(x[use], y[use])
            out[~use, 0] = sigmoid(x[~use] @ w[:-1] + w[-1])
        best = telling(doc, column, y, np.ones(docs, bool), len(distinct))
        chain.hashes.append(distinct[best])
        chain.weights.append(fit(np.hstack([presence(doc, column, best, docs, len(distinct)), before]), y))
        before = np.hstack([before, out])
    return chain


def learn(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Chain:
    names = [n for n, _ in categories]
    flags: list[Column] = [F.max(F.coalesce(F.expr(c), F.lit(False)).cast("int")).alias(n) for n, c in categories]
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(*flags)
    turn = F.xxhash64("label_id", F.lit(17))
    some = told.orderBy(turn, "label_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = text_bytes(batch.column(0))
            n = len(offsets) - 1
            pairs = [np.stack([doc.astype(_U), h]) for h, doc in features(data, offsets)]
            both = np.concatenate(pairs, axis=1)
            order = np.lexsort((both[1], both[0]))
            both = both[:, order]
            new = np.ones(both.shape[1], bool)
            new[1:] = (both[:, 1:] != both[:, :-1]).any(0)
            both = both[:, new]
            cuts = np.searchsorted(both[0], np.arange(n + 1, dtype=_U))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([both[1, a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], names=[*names, "id", "hashes"])

    joined = docs.select(docs[key].alias("id"), docs[text].alias("text")).join(F.broadcast(some), F.col("id") == F.col("label_id"))
    # one row a document of the sample, at most `sample` rows in all
    kept = stored(joined.groupBy("id", "label_id", *names).agg(F.min("text").alias("text")), "sample")
    sizes = kept.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"), turn.alias("turn")).orderBy("turn", "id").toArrow()
    within = int(np.searchsorted(np.cumsum(sizes["size"].to_numpy().astype(np.int64)), sample_bytes, "right"))
    if within < sizes.num_rows:
        last = sizes.slice(max(within, 1) - 1, 1).to_pylist()[0]
        kept = kept.where((turn < last["turn"]) | (turn == last["turn"]) & (F.col("id") <= last["id"]))
    kind = docs.schema[key].dataType.simpleString()
    rows = kept.select("text", *names, "id").mapInArrow(tidy(run), ", ".join(f"`{n}` int" for n in names) + f", id {kind}, hashes binary")
    got = rows.toArrow()
    got = got.take(pa.array(np.argsort(got["id"].to_numpy(), kind="stable")))
    each = [np.frombuffer(x, _U) for x in got["hashes"].to_pylist()]
    doc = np.repeat(np.arange(len(each)), [len(x) for x in each])
    hashes = np.concatenate(each) if each else np.zeros(0, _U)
    return train(doc, hashes, np.stack([got[n].to_numpy() for n in names], axis=1) if len(each) else np.zeros((0, len(names))), names)


def score(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: key, p_<category> of each, is_<category> (the probability reaches the threshold)."""
    chain = learn(docs, labels, categories, key, text, sample, sample_bytes)
    names = [f"p_{n}" for n in chain.names]
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            p = chain.predict(*text_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(p[:, i])) for i in range(len(names)))], names=[key, *names])

    found = docs.select(docs[key], docs[text].alias("text")).mapInArrow(tidy(run), f"`{key}` {kind}, " + ", ".join(f"`{n}` double" for n in names))
    return found.select("*", *[(F.col(f"p_{n}") >= threshold).alias(f"is_{n}") for n in chain.names])
