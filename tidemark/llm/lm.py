"""Language-model scores of whole texts.

Two models learn from the documents whose crc32(id as text) mod 7 is not 2.

Word model (base): add-one unigram over lower-cased words and one end a document.  Texts that a task encodes
one after the other make a chunk; each chunk sends its distinct word hashes with their training counts to the
hash's bucket, and gets the sums back, so a frequent word costs a bucket one entry a chunk.

Attention model: one layer of causal self-attention over byte-level subword ids, trained in numpy.  The OWN
most frequent ids have an embedding each, rarer ones share that of their kind (last byte, leading space).
Keys and values are the embeddings themselves: with one head, a matrix for keys is a factor of that for queries, and one for
values of the outputs'.  It predicts first a family of kinds, or the end, then the kind, then the id: each kind has outputs for its MEMBERS - 1 most frequent ids
and one for the others, of which P(id | others) are counts.  The model starts as a unigram model.  Every window of every training text is trained on:
texts, as ids, are dealt into units of about UNIT bytes by a hash of the row and units into rounds; in a round each
unit trains from the same parameters, its texts in the order of their hash, and Spark sums the parameters, as
integers weighted by windows, to their mean, from which the next round starts.  So neither the input's
partitions nor the order of its rows bear on the model.

Texts are scored in groups of STEP predictions that see the STEP inputs before the group too, many groups at
once under a causal mask: each token is scored once, with STEP to 2 * STEP - 1 tokens of context (less only at
the start of a text); then one end.

Nulls count as empty texts, whose only token is the end; rows with a null id are trained on.  Repeated rows
count each.  Other columns are not read.  An empty table gives an empty result; a table without training texts is scored by
the model as it starts.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Coder
from .common import parts, stored, sum_blocks
from .kernel import pieces, release, scan, spread, text_bytes, tidy
from .repeats import BUCKET, CHUNK, LEAST_CHUNK, MOST_BITS, SOME_CHUNKS, WORD_BYTES

PARTS, HELD = 7, 2
STEP, WIDTH = 16, 16
#: Kinds of subwords: 32 of the last byte, with or without a leading space.
KINDS = 64
#: Kinds of a family: eight last bytes that follow one another have two; the end is a family of its own.
FAMILY = 8
#: Ids with an embedding of their own; outputs of a kind, the last of which stands for its rarer ids.
OWN, MEMBERS = 4096, 32
#: The bias of an output that stands for nothing.
NOTHING = -50.0
#: Bytes of text a unit, rounds at most, units a round at most (beyond that units grow).
UNIT, ROUNDS, MOST_UNITS = 6 << 20, 3, 4096
#: Steps that a unit trains at least, windows a step, learning rate of each round.
LEAST_STEPS, BATCH = 120, 1024
RATES = (0.05, 0.03, 0.01)
#: Of the parameters as integers, and the bits of the lower of the two numbers that their sums are kept in: both stay within 64 bits
#: up to 2**36 windows a unit and 2**60 in all.
SCALE, LARGEST, LIMB = 1 << 20, 60.0, 24
GROUPS = 1024
#: Logarithms below this in size need no maximum taken off before their exponentials, in 32 bits.
MODERATE = 40.0
BLOCKS = 16
#: Bytes of text encoded at a time.
PIECE = 4 << 20
_U = np.uint64


class Subwords(Coder):
    """Ids of a tokenizer file; the pieces by the tokenizer's own library, special strings as ordinary text."""

    def __init__(self, path: str, ranks: str) -> None:
        import base64

        import tiktoken

        super().__init__(path)
        self.added, self.split_added = {}, None
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.library = tiktoken.Encoding("own", pat_str=self.pattern.pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        last = [x[-1] | 0x20 if 0x41 <= x[-1] <= 0x5A else x[-1] for x in (s or b"\0" for s in self.strings)]
        kind = [b - 0x61 if 0x61 <= b <= 0x7A else 26 + (b & 3) if b >= 0x80 else 30 if 0x30 <= b <= 0x39 else 31 for b in last]
        sizes = np.array([len(s) for s in self.strings], np.int64)
        self.sizes, self.begins, self.flat = sizes, np.cumsum(sizes) - sizes, np.frombuffer(b"".join(self.strings), np.uint8)
        self.kinds = np.array([2 * k + s.startswith(b" ") for k, s in zip(kind, self.strings, strict=True)], np.int64)

    def ids_of(self, word: str) -> bytes:
        return array("i", self.library(word)).tobytes()

    def all_of(self, strings: pa.Array, encode: Callable[[str], bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As the pieces one by one, but those between two places where texts are cut go to the library as one text."""
        data, bounds = text_bytes(strings)
        first, last = bounds[:-1], bounds[1:] - 1
        ends = data[last]
        joined = (data[first] == 0x20) & (last > first)
        joined &= (ends >= 0x21) & (ends <= 0x7E) | (ends >= 0x80) & (data[last - 1] >= 0xC3) & (data[last - 1] <= 0xDF)
        own = np.flatnonzero(~joined)
        flat, few = super().all_of(strings.take(pa.array(own)), encode)
        data, bounds = text_bytes(strings.filter(pa.array(joined)))
        ids = np.array(self.library(data.tobytes().decode()), np.int32)
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), bounds, "right")
        sizes = np.empty(len(joined), np.int64)
        sizes[own], sizes[joined] = few, np.diff(cuts)
        order = np.argsort(joined, kind="stable")  # the pieces as they are encoded
        starts = np.empty(len(sizes), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate([flat, ids])[spread(starts, sizes)], sizes

    def texts_of(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts that were encoded."""
        ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        out = np.empty(int(ends[-1]), np.uint8)
        for lo in range(0, len(ids), 1 << 17):  # places take eight times the bytes
            some = ids[lo : lo + (1 << 17)]
            out[ends[lo] : ends[lo + len(some)]] = self.flat[spread(self.begins[some], self.sizes[some])]
        return out, ends[bounds]


@functools.lru_cache(maxsize=1)
def subwords(path: str, ranks: str) -> Subwords:
    return Subwords(path, ranks)


def held_out(ids: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % PARTS == HELD for i in ids.to_pylist()], bool)


# ---- the attention model


@dataclass
class Vocabulary:
    """What the training counts of the ids (whose last entry counts texts, as ends) make of them.

    row: the embedding of each id, then of the end; slot: its output, MEMBERS a kind, the end a kind of its own; within: log10 P(id | slot); family, kind, member: log P of the families, of the kinds of each and of the outputs of each kind.
    """

    row: np.ndarray
    slot: np.ndarray
    within: np.ndarray
    family: np.ndarray
    kind: np.ndarray
    member: np.ndarray

    @property
    def rows(self) -> int:
        return OWN + KINDS + 2

    @property
    def pad(self) -> int:
        return self.rows - 1

    @staticmethod
    def of(counts: np.ndarray, kinds: np.ndarray) -> Vocabulary:
        n = len(kinds)
        order = np.argsort(-counts[:n], kind="stable")
        row = np.append(OWN + kinds, OWN + KINDS)
        own = order[:OWN]
        row[own] = np.arange(len(own))
        # the place of each id among those of its kind, most frequent first
        by = order[np.argsort(kinds[order], kind="stable")]
        place = np.empty(n, np.int64)
        place[by] = np.arange(n) - np.searchsorted(kinds[by], kinds[by])
        slot = np.append(kinds * MEMBERS + np.minimum(place, MEMBERS - 1), KINDS * MEMBERS)
        mass = counts + 0.5
        total = np.bincount(slot, mass, (KINDS + 1) * MEMBERS)
        member = total.reshape(KINDS + 1, MEMBERS)
        kind = np.append(member.sum(1), np.zeros(FAMILY - 1)).reshape(-1, FAMILY)
        family = kind.sum(1)

        def logs(x: np.ndarray, whole: np.ndarray) -> np.ndarray:
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.fmax(np.log(x) - np.log(whole), NOTHING).astype(np.float32)

        return Vocabulary(row, slot, np.log10(mass / total[slot]), logs(family, mass.sum()), logs(kind, family[:, None]), logs(member, member.sum(1, keepdims=True)))


def shapes(v: Vocabulary) -> dict[str, tuple[int, ...]]:
    families, kinds = len(v.family), len(v.member)
    return {"e": (v.rows, WIDTH), "q": (WIDTH, WIDTH), "r": (2 * STEP,), "o": (2 * WIDTH, families), "b": (families,), "f": (families, 2 * WIDTH, FAMILY), "g": (families, FAMILY), "m": (kinds, 2 * WIDTH, MEMBERS), "c": (kinds, MEMBERS)}


def start(v: Vocabulary, seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {n: rng.normal(0, 0.3, s).astype(np.float32) if n in "eq" else np.zeros(s, np.float32) for n, s in shapes(v).items()}
    p["b"][:], p["g"][:], p["c"][:] = v.family, v.kind, v.member
    return p


def flatten(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in p.values()]).astype(np.float64)


def unflatten(x: np.ndarray, v: Vocabulary) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for n, s in shapes(v).items():
        size = int(np.prod(s))
        out[n] = x[at : at + size].reshape(s).astype(np.float32)
        at += size
    return out


def laid_out(ids: np.ndarray, bounds: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs as embeddings, outputs to predict, -1 for none, where each group of 2 * STEP inputs begins, its document): inputs are the end as a start, then the text; predictions are the text, then the end."""
    sizes = np.diff(bounds) + 1
    many = -(-sizes // STEP)
    room = (many + 1) * STEP
    base = np.cumsum(room) - room
    keys = np.full(int(room.sum()), v.pad, np.int32)
    goal = np.full(int(room.sum()), -1, np.int32)
    place = np.arange(len(ids)) + np.repeat(base + STEP - bounds[:-1], np.diff(bounds))
    keys[base + STEP] = v.row[-1]
    keys[place + 1] = v.row[ids]  # an input stands one place after its own prediction, the last one where the end is predicted
    goal[place] = v.slot[ids]
    goal[base + STEP + sizes - 1] = v.slot[-1]
    first = np.repeat(base, many) + STEP * (np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many))
    return keys, goal, first, np.repeat(np.arange(len(sizes)), many)


def groups(keys: np.ndarray, goal: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(groups, 2 * STEP) inputs and (groups, STEP) predictions of the groups that begin at `first`."""
    at = first[:, None] + np.arange(2 * STEP)
    return keys[at], goal[at[:, STEP:]]


RELATIVE = np.arange(STEP)[:, None] + STEP - np.arange(2 * STEP)  # of query and key; below 0: later
CAUSAL = RELATIVE >= 0
RELATIVE = np.where(CAUSAL, RELATIVE, 0)


def attend(q: np.ndarray, x: np.ndarray, bias: np.ndarray, pads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(exponentials, their sums, mixed inputs) of queries (groups, STEP, WIDTH) over inputs (groups, 2 * STEP, WIDTH), which are both keys and values; bias holds the relative places, -inf for later ones; pads: which inputs are padding. Every query sees an input that is none."""
    w = q @ x.transpose(0, 2, 1)
    w += bias
    some = np.flatnonzero(pads.any(1))
    if len(some):
        w[some] += np.where(pads[some], np.float32(-np.inf), np.float32(0))[:, None, :]
    e, total, _ = raised(w.reshape(-1, 2 * STEP))
    e, total = e.reshape(w.shape), total.reshape(*w.shape[:2], 1)
    mixed = e @ x
    mixed /= total
    return e, total, mixed


def row_sums(x: np.ndarray) -> np.ndarray:
    return (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], x.dtype)).reshape(*x.shape[:-1], 1)


def relative_bias(r: np.ndarray) -> np.ndarray:
    return np.where(CAUSAL, r[RELATIVE], np.float32(-np.inf)).astype(np.float32)


def raised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """(exponentials of each row of what it has above `top`; their sum; top: 0, or each row's largest where sizes call for it)."""
    if x.size and x.max() < MODERATE:
        e = np.exp(x)
        total = row_sums(e)
        if total.min() > np.exp(-MODERATE):
            return e, total, 0.0
    top = x.max(1, keepdims=True)
    e = np.exp(x - top)
    return e, row_sums(e), top


def exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(exponentials of each row, perhaps of what it has above its largest; their sum; the logarithm of the exponentials' sum)."""
    e, total, top = raised(x)
    return e, total, (top + np.log(total))[:, 0]


def softmax(x: np.ndarray) -> None:
    """In place."""
    e, total, _ = raised(x)
    np.divide(e, total, out=x)


def spans_of(sorted_groups: np.ndarray, many: int) -> list[tuple[int, int, int]]:
    """(group, from, to) of each group that has rows."""
    cuts = np.searchsorted(sorted_groups, np.arange(many + 1)).tolist()
    return [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]


def by_kind(slots: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]]]:
    """(order of the rows by kind, in that order for families, kinds and members: (the group of each row, its choice within it, (group, from, to)))."""
    kinds = (slots // MEMBERS).astype(np.uint8)
    order = np.argsort(kinds, kind="stable")
    kinds, members = kinds.take(order).astype(np.int64), slots.take(order) % MEMBERS
    families = kinds // FAMILY
    return order, [
        (np.zeros(len(kinds), np.int64), families, [(0, 0, len(kinds))]),
        (families, kinds % FAMILY, spans_of(families, KINDS // FAMILY + 1)),
        (kinds, members, spans_of(kinds, KINDS + 1)),
    ]


def levels(p: dict[str, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights and biases of each group's choices: families, kinds of a family, members of a kind."""
    return [(p["o"][None], p["b"][None]), (p["f"], p["g"]), (p["m"], p["c"])]


def choices(z: np.ndarray, weights: np.ndarray, biases: np.ndarray, group: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The logits of each row's choices, up to their sum."""
    d = np.empty((len(z), biases.shape[1]), z.dtype)
    for i, a, b in spans:
        np.matmul(z[a:b], weights[i], out=d[a:b])
    d += biases.take(group, axis=0) if len(biases) > 1 else biases
    return d


def train_step(p: dict[str, np.ndarray], keys: np.ndarray, goal: np.ndarray, pad: int) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of the predictions and its slopes."""
    many = len(keys)
    root = np.float32(WIDTH**0.5)
    x = p["e"].take(keys, axis=0)
    z = np.empty((many, STEP, 2 * WIDTH), x.dtype)  # of each prediction: what attention mixes, the input
    z[:, :, WIDTH:] = x[:, STEP:]
    xq = np.ascontiguousarray(x[:, STEP:]).reshape(-1, WIDTH)
    q = (xq @ (p["q"] / root)).reshape(many, STEP, WIDTH)
    e, total, mixed = attend(q, x, relative_bias(p["r"]), keys == pad)
    z[:, :, :WIDTH] = mixed
    target = goal.ravel()
    real = np.flatnonzero(target >= 0)
    order, each = by_kind(target.take(real))
    real = real.take(order)
    z = z.reshape(-1, 2 * WIDTH).take(real, axis=0)
    n, rows = max(len(real), 1), np.arange(len(real))
    g, loss, dz = {}, 0.0, np.zeros_like(z)
    part, ones, share = np.empty_like(z), np.ones(len(real), z.dtype), z.dtype.type(1 / n)
    for (w, c), names, (group, choice, spans) in zip(levels(p), ("ob", "fg", "mc"), each, strict=True):
        d = choices(z, w, c, group, spans)
        d, total_d, _ = raised(d)
        total_d *= z.dtype.type(n)
        d /= total_d
        at = rows * d.shape[1] + choice
        hit = d.ravel().take(at)
        loss -= float(np.log(np.maximum(hit * n, 1e-20)).sum())
        d.ravel()[at] = hit - share
        gw, gc = np.zeros_like(w), np.zeros_like(c)
        for i, a, b in spans:
            np.matmul(z[a:b].T, d[a:b], out=gw[i])
            np.matmul(ones[a:b], d[a:b], out=gc[i])
            np.matmul(d[a:b], w[i].T, out=part[a:b])
        dz += part
        g[names[0]], g[names[1]] = (x.reshape(p[k].shape) for x, k in zip((gw, gc), names, strict=True))
    all_dz = np.zeros((many * STEP, 2 * WIDTH), dz.dtype)
    all_dz[real] = dz
    dm = np.ascontiguousarray(all_dz[:, :WIDTH]).reshape(many, STEP, WIDTH)
    dm /= total
    ds = dm @ x.transpose(0, 2, 1)
    ds -= row_sums(dm * mixed)
    ds *= e
    g["r"] = np.bincount(RELATIVE.ravel(), ds.sum(0).ravel(), 2 * STEP).astype(x.dtype)
    dq = (ds @ x).reshape(-1, WIDTH)
    dq /= root
    g["q"] = xq.T @ dq
    dx = ds.transpose(0, 2, 1) @ q
    dx += e.transpose(0, 2, 1) @ dm
    dx[:, STEP:] += (all_dz[:, WIDTH:] + dq @ p["q"].T).reshape(many, STEP, WIDTH)
    # slopes of equal inputs are summed
    at, dx = keys.ravel().astype(np.int64), dx.reshape(-1, WIDTH)
    g["e"] = np.empty_like(p["e"])
    for i in range(WIDTH):
        g["e"][:, i] = np.bincount(at, dx[:, i], len(p["e"]))
    g["e"][pad] = 0
    return loss / n, g


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01) -> None:
        self.p, self.rate, self.n = p, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in p.items()}
        self.s = {k: np.zeros_like(x) for k, x in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        """The slopes' arrays are used up."""
        self.n += 1
        a, b = np.float32(self.rate / (1 - 0.9**self.n)), np.float32(1 / (1 - 0.99**self.n))
        for k, x in g.items():
            m, s = self.m[k], self.s[k]
            m *= np.float32(0.9)
            m += np.float32(0.1) * x
            x *= x
            x *= np.float32(0.01)
            s *= np.float32(0.99)
            s += x
            np.multiply(s, b, out=x)
            np.sqrt(x, out=x)
            x += np.float32(1e-6)
            np.divide(m, x, out=x)
            x *= a
            self.p[k] -= x


class Scorer:
    """log10 probabilities by a trained model."""

    def __init__(self, p: dict[str, np.ndarray], v: Vocabulary) -> None:
        self.vocabulary = v
        self.x = p["e"]
        self.q = p["e"] @ (p["q"] / np.float32(WIDTH**0.5))
        self.bias = relative_bias(p["r"])
        self.levels = levels(p)

    def logs(self, keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """log P of the output slots[i] at each prediction of the groups, in order; 0 where it is -1."""
        x = self.x.take(keys, axis=0)
        z = np.empty((len(keys), STEP, 2 * WIDTH), x.dtype)
        z[:, :, WIDTH:] = x[:, STEP:]
        z[:, :, :WIDTH] = attend(self.q.take(keys[:, STEP:], axis=0), x, self.bias, keys == self.vocabulary.pad)[2]
        real = np.flatnonzero(slots >= 0)
        order, each = by_kind(slots.take(real))
        real = real.take(order)
        z = z.reshape(-1, 2 * WIDTH).take(real, axis=0)
        rows, hit = np.arange(len(real)), np.zeros(len(real))
        for (w, c), (group, choice, spans) in zip(self.levels, each, strict=True):
            d = choices(z, w, c, group, spans)
            hit += d.ravel().take(rows * d.shape[1] + choice)
            hit -= exponentials(d)[2]
        out = np.zeros(len(slots))
        out[real] = hit
        return out

    def score(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each text the log10 probability of its ids and the end."""
        v, docs = self.vocabulary, len(bounds) - 1
        doc = np.repeat(np.arange(docs), np.diff(bounds))
        total = np.bincount(doc, v.within[ids], docs).astype(np.float64)
        *laid, first, of = laid_out(ids, bounds, v)
        for lo in range(0, len(first), GROUPS):
            keys, goal = groups(*laid, first[lo : lo + GROUPS])
            each = self.logs(keys, goal.ravel()) / np.log(10)
            total += np.bincount(of[lo : lo + GROUPS], each.reshape(-1, STEP).sum(1), docs)
        return total


class Trainer:
    """Adam's steps over a stream of windows, each taken at least once."""

    def __init__(self, p: dict[str, np.ndarray], v: Vocabulary, rate: float, seed: int) -> None:
        self.p = {k: x.copy() for k, x in p.items()}
        self.vocabulary = v
        self.adam = Adam(self.p, rate)
        self.rng = np.random.default_rng(seed)
        self.steps = self.windows = 0
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.first: list[tuple[np.ndarray, np.ndarray]] = []  # the windows of the first LEAST_STEPS steps

    def step(self, keys: np.ndarray, goal: np.ndarray) -> None:
        self.adam.step(train_step(self.p, keys, goal, self.vocabulary.pad)[1])
        self.steps += 1

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> None:
        *laid, first, _ = laid_out(ids, bounds, self.vocabulary)
        for lo in range(0, len(first), 8 * BATCH):
            self.add(*groups(*laid, first[lo : lo + 8 * BATCH]))

    def add(self, keys: np.ndarray, goal: np.ndarray, last: bool = False) -> None:
        """Trains on what waits and these in random order; fewer than a step's wait for more, unless they are the last."""
        self.windows += len(keys)
        self.waiting.append((keys.astype(np.int16), goal.astype(np.int16)))
        have = sum(len(k) for k, _ in self.waiting)
        if not have or have < 8 * BATCH and not last:
            return
        keys, goal = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        order = self.rng.permutation(have)
        whole = have if last else have // BATCH * BATCH
        for a in range(0, whole, BATCH):
            at = order[a : min(a + BATCH, whole)]
            if self.steps < LEAST_STEPS:
                self.first.append((keys[at], goal[at]))
            self.step(keys[at], goal[at])
        self.waiting = [(keys[order[whole:]], goal[order[whole:]])]

    def finish(self) -> None:
        self.add(np.zeros((0, 2 * STEP), np.int16), np.zeros((0, STEP), np.int16), last=True)
        if self.windows and self.steps < LEAST_STEPS:
            keys, goal = (np.concatenate(x) for x in zip(*self.first, strict=True))
            while self.steps < LEAST_STEPS:
                at = self.rng.integers(0, len(keys), BATCH)
                self.step(keys[at], goal[at])

    def sums(self) -> np.ndarray:
        return weighted(flatten(self.p), self.windows)


def weighted(params: np.ndarray, windows: int) -> np.ndarray:
    """The windows, then the parameters as integers, times the windows: their upper and then their lower bits."""
    whole = np.rint(np.clip(params, -LARGEST, LARGEST) * SCALE).astype(np.int64) * windows
    return np.concatenate([[windows], whole >> LIMB, whole & ((1 << LIMB) - 1)])


def averaged(sums: np.ndarray) -> np.ndarray:
    """The parameters of a sum of `weighted`, of whatever size."""
    upper, lower = np.split(sums[1:].astype(object), 2)
    return ((upper * (1 << LIMB) + lower) / (int(sums[0]) * SCALE)).astype(np.float64)


CODED = "kind int, slot long, place long, id long, chunk long, ids binary, block int, part int, sums binary"
TEXT, COUNT, WORDS = range(3)


def coded(rows: DataFrame, path: str, ranks: str, units: int, bits: int, size: int) -> DataFrame:
    """rows(id, text, place) -> of all texts TEXT rows (slot: unit, null for those held out; place, id, chunk, ids); COUNT rows of the training texts (sums: counts of ids, texts, words); WORDS rows of all texts (chunk; block: bucket; ids: distinct hashes of lower-cased words; sums: their counts in training texts).

    A chunk is texts of a task that follow one another, of at most `size` bytes or one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = subwords(path, ranks)
        counts = np.zeros(len(code.strings) + 2, np.int64)
        part = TaskContext.get().partitionId()
        chunk, filled = part << 32, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def made(kind: int, n: int, **columns: pa.Array) -> pa.RecordBatch:
            kinds = {"kind": pa.int32(), "slot": pa.int64(), "place": pa.int64(), "id": pa.int64(), "chunk": pa.int64(), "ids": pa.binary(), "block": pa.int32(), "part": pa.int32(), "sums": pa.binary()}
            columns |= {"kind": pa.array([kind] * n, pa.int32()), "part": pa.array([part] * n, pa.int32())}
            return pa.RecordBatch.from_pydict({k: columns.get(k, pa.nulls(n, t)) for k, t in kinds.items()})

        def words() -> pa.RecordBatch:
            distinct, which = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            known = np.bincount(which, np.concatenate([n for _, n in held]), len(distinct)).astype(np.int64)
            spans = in_buckets(distinct, bits)
            n = len(spans)
            return made(WORDS, n, chunk=pa.array([chunk] * n, pa.int64()), block=pa.array([i for i, _, _ in spans], pa.int32()), ids=pa.array([low_bytes(distinct[a:b], bits) for _, a, b in spans], pa.binary()), sums=pa.array([pack_counts(known[a:b]) for _, a, b in spans], pa.binary()))

        for batch in pieces(batches, most=min(size, PIECE)):
            data, offsets = text_bytes(batch.column(1))
            if filled and filled + len(data) > size:
                yield words()
                chunk, filled, held = chunk + 1, 0, []
            filled += len(data)
            ids, bounds = code.encode_all(data, offsets)
            learn = ~held_out(batch.column(0))
            counts[:-2] += np.bincount(ids[np.repeat(learn, np.diff(bounds))], minlength=len(counts) - 2)
            found = scan(lowered(data), offsets)
            counts[-2:] += learn.sum(), found.counts()[learn].sum()
            distinct, which = np.unique(found.hashes(), return_inverse=True)
            held.append((distinct, np.bincount(which, learn[found.doc], len(distinct))))
            place = batch.column(2).to_numpy()
            raw = as_raw(ids, len(code.strings))
            yield made(TEXT, batch.num_rows, slot=pa.array(place % units, mask=~learn), place=pa.array(place), id=batch.column(0), chunk=pa.array([chunk] * batch.num_rows, pa.int64()), ids=pa.array([raw[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary()))
        if held:
            yield words()
        if counts.any():
            cut = np.array_split(counts, BLOCKS)
            yield made(COUNT, BLOCKS, block=pa.array(range(BLOCKS), pa.int32()), sums=pa.array([x.tobytes() for x in cut], pa.binary()))

    return rows.mapInArrow(tidy(run, lambda: subwords(path, ranks).forget()), CODED)


def in_buckets(distinct: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of ascending hashes; buckets without a word are left out, so that rows never outnumber words."""
    cuts = [*np.searchsorted(distinct, np.arange(1 << bits, dtype=_U) << _U(64 - bits)).tolist(), len(distinct)]
    return [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]


def low_bytes(hashes: np.ndarray, bits: int) -> bytes:
    """Of each hash what its bucket does not tell."""
    return np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, : 8 - bits // 8].tobytes()


def from_low_bytes(rows: pa.ChunkedArray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(the hashes of one bucket's rows without the bytes that are left out, how many each row has)."""
    width = 8 - bits // 8
    low = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, width) for x in rows]
    sizes = np.array([len(x) for x in low])
    full = np.zeros((int(sizes.sum()), 8), np.uint8)
    full[:, :width] = np.concatenate(low)
    return full.view(_U).ravel(), sizes


def as_raw(ids: np.ndarray, many: int) -> np.ndarray:
    return ids.astype("<u4" if many + 2 > 1 << 16 else "<u2")


def from_raw(rows: list[bytes], many: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of the texts."""
    kind = np.dtype("<u4" if many + 2 > 1 << 16 else "<u2")
    sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // kind.itemsize
    return np.frombuffer(b"".join(rows), kind).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)


def kinds_of_words(texts: DataFrame, bits: int) -> int:
    """How many distinct words the training texts have: each bucket of hashes counts its own."""

    def count(t: pa.Table) -> pa.Table:
        known = np.concatenate([unpack_counts(x.as_py()) for x in t["sums"]]) > 0
        return pa.table({"n": pa.array([len(np.unique(from_low_bytes(t["ids"], bits)[0][known]))], pa.int64())})

    found = texts.where(F.col("kind") == WORDS).select("block", "ids", "sums").groupBy("block").applyInArrow(count, "n long")
    return found.agg(F.sum("n")).first()[0] or 0


def collected(rows: DataFrame) -> np.ndarray | None:
    """The sum of (block, part, sums), of a fixed size."""
    got = sum_blocks(rows.select("block", "part", "sums")).collect()  # BLOCKS rows
    return np.concatenate([np.frombuffer(r["sums"], np.int64) for r in sorted(got, key=lambda r: r["block"])]) if got else None


@dataclass
class Learnt:
    """Parameters and vocabulary of the attention model; tokens and kinds of the word model's training words, with ends."""

    params: dict[str, np.ndarray]
    vocabulary: Vocabulary
    tokens: int
    kinds: int
    ends: int


def rounds_of(total: int) -> int:
    return max(1, min(ROUNDS, -(-total // UNIT)))


def coded_texts(docs: DataFrame, path: str, ranks: str, total: int, bits: int, size: int = CHUNK) -> DataFrame:
    """docs(id, text), of `total` bytes -> what `coded` makes of them, stored."""
    rounds = rounds_of(total)
    each = max(1, min(MOST_UNITS, -(-total // (UNIT * rounds))))
    # a row's place in the order of training; equal rows are alike
    place = F.pmod(F.xxhash64("text", "id"), F.lit((1 << 62) - 1))
    return stored(coded(docs.select("id", "text", place.alias("place")), path, ranks, rounds * each, bits, size), "coded")


def train(docs: DataFrame, path: str, ranks: str, total: int, bits: int) -> Learnt:
    """docs(id, text), of `total` bytes -> both models' training, over all training texts."""
    return learn(coded_texts(docs, path, ranks, total, bits), path, ranks, rounds_of(total), bits)


def learn(texts: DataFrame, path: str, ranks: str, rounds: int, bits: int) -> Learnt:
    """The same of texts that are coded."""
    spark = texts.sparkSession
    code = subwords(path, ranks)
    counts = collected(texts.where(F.col("kind") == COUNT))
    counts = np.zeros(len(code.strings) + 2, np.int64) if counts is None else counts
    v = Vocabulary.of(counts[:-1], code.kinds)
    p = start(v)
    ends, words = int(counts[-2]), int(counts[-1])
    for turn in range(rounds if ends else 0):
        units = texts.where((F.col("kind") == TEXT) & (F.pmod("slot", F.lit(rounds)) == turn)).select("slot", "place", "ids")
        units = units.repartition(parts(spark), "slot").sortWithinPartitions("slot", "place", "ids")
        sums = collected(units.mapInArrow(tidy(units_trained(p, v, RATES[turn], len(code.strings))), "block int, part int, sums binary"))
        if sums is not None:
            p = unflatten(averaged(sums), v)
    return Learnt(p, v, words + ends, kinds_of_words(texts, bits) + (ends > 0), ends)


def units_trained(p: dict[str, np.ndarray], v: Vocabulary, rate: float, many: int):
    """Rows (slot, place, ids) sorted by slot and place -> (block, part, sums), one set a unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, slot = None, None

        def told() -> pa.RecordBatch:
            trainer.finish()
            cut = np.array_split(trainer.sums(), BLOCKS)
            return pa.RecordBatch.from_pydict({"block": pa.array(range(BLOCKS), pa.int32()), "part": pa.array([slot % (1 << 30)] * BLOCKS, pa.int32()), "sums": pa.array([x.tobytes() for x in cut], pa.binary())})

        # rows are counted off from the start of a unit, so that batches do not bear on the steps
        for rows in counted_off(batches, "slot", 64):
            if rows["slot"][0].as_py() != slot:
                if trainer is not None:
                    yield told()
                slot = rows["slot"][0].as_py()
                trainer = Trainer(p, v, rate, slot)
            trainer.texts(*from_raw(rows["ids"].to_pylist(), many))
        if trainer is not None:
            yield told()

    return run


def counted_off(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """A stream sorted by the key in tables of `rows` rows of one key, the last of each key shorter."""
    held: list[pa.RecordBatch] = []
    count, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        at = 0
        while at < len(keys):
            if held and keys[at] != last:
                yield pa.Table.from_batches(held)
                held, count = [], 0
            last = keys[at]
            end = min(int(np.searchsorted(keys, last, "right")), at + rows - count)
            held.append(batch.slice(at, end - at))
            count += end - at
            at = end
            if count == rows:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held)


# ---- the word model


def pack_counts(x: np.ndarray) -> bytes:
    """A byte a count; 255 says that the count is among the long ones, which follow."""
    long = x >= 255
    return len(x).to_bytes(4, "little") + np.where(long, 255, x).astype(np.uint8).tobytes() + x[long].astype("<i8").tobytes()


def unpack_counts(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    out = np.frombuffer(raw, np.uint8, n, 4).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<i8", -1, 4 + n)
    return out


def answer(bits: int):
    """WORDS rows of a bucket -> for each the counts of its words in all training texts."""

    def run(table: pa.Table) -> pa.Table:
        hashes, sizes = from_low_bytes(table["ids"], bits)
        distinct, which = np.unique(hashes, return_inverse=True)
        counts = np.concatenate([unpack_counts(x.as_py()) for x in table["sums"]])
        back = np.bincount(which, counts, len(distinct)).astype(np.int64)[which]
        ends = np.cumsum(sizes)
        return pa.table({"chunk": table["chunk"], "bucket": table["block"], "counts": pa.array([pack_counts(back[e - s : e]) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary())})

    return run


def some_texts(bounds: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """(from, to) of texts of at most `most` ids together; a longer text is alone."""
    lo = 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def judge(path: str, ranks: str, learnt: Learnt):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        code = subwords(path, ranks)
        ids, bounds = from_raw(texts["ids"].to_pylist(), len(code.strings))
        data, offsets = code.texts_of(ids, bounds)
        words = scan(lowered(data), offsets)
        # the chunk's distinct words in the order in which they were sent
        which = np.unique(words.hashes(), return_inverse=True)[1]
        order = np.argsort(answers["bucket"].to_numpy())
        counts = np.concatenate([np.zeros(0, np.int64), *(unpack_counts(answers["counts"][i].as_py()) for i in order.tolist())])
        below = np.log10(learnt.tokens + learnt.kinds + 1.0)
        each = np.log10(counts + 1.0) - below
        doc, docs = words.doc, words.docs
        base = np.bincount(doc, each[which], docs) + (np.log10(learnt.ends + 1.0) - below)
        known = np.bincount(doc, counts[which] > 0, docs).astype(np.int64) + (learnt.ends > 0)
        tokens, held = words.counts() + 1, held_out(texts["id"])
        del data, words, which, doc, each, counts
        scorer = Scorer(learnt.params, learnt.vocabulary)
        scores = []
        for lo, hi in some_texts(bounds):
            scores.append(scorer.score(ids[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]))
        release()
        return pa.table({
            "id": texts["id"], "held_out": pa.array(held), "n_tokens": pa.array(tokens), "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(docs, learnt.tokens, np.int64)), "base_score": pa.array(base), "score": pa.array(np.concatenate(scores)),
        })

    return run


def score_texts(docs: DataFrame, path: str, ranks: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    total = texts.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    size = min(CHUNK, max(LEAST_CHUNK, total // SOME_CHUNKS))
    bits = min(MOST_BITS, max(8, (total // WORD_BYTES // BUCKET).bit_length()))
    known = coded_texts(texts, path, ranks, total, bits, size)
    learnt = learn(known, path, ranks, rounds_of(total), bits)
    dealt = known.where(F.col("kind") == TEXT).select("id", "chunk", "ids")
    sent = known.where(F.col("kind") == WORDS).select("block", "chunk", "ids", "sums")
    answers = sent.groupBy("block").applyInArrow(answer(bits), "chunk long, bucket int, counts binary")
    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(judge(path, ranks, learnt), schema).withColumnRenamed("id", key)
