"""Byte-level BPE encoding and decoding.

Encoding merges by a priority queue of merge ranks over a doubly linked list of symbols; queue
entries whose pair has changed since they were pushed are skipped as stale.  Decoding concatenates
the vocabulary strings of the ids.  Texts are cut only before a space that follows a character that
is no white space: no pre-token crosses such a place, so the pieces can be encoded one
by one; equal pieces of a batch are encoded once.  Nulls and empty texts give no ids; texts are whole however long; repeated rows give
repeated rows; columns other than the key and the text are not read, so none can clash; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .kernel import pieces, spread, text_bytes, tidy

#: Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens of at most LONG_PIECE characters remembered within a task, about 250 bytes each, twice over: a full memory becomes the old one, and what is met again moves over.
REMEMBERED = 120_000
#: Text bytes encoded at a time, and ids spelled out at a time.
BATCH, SPELLED = 4 << 20, 1 << 18
#: Marks that are neither letters, digits, white space nor apostrophes.
PLAIN_MARKS = ".,!?;:%$&*#|"
LONG_PIECE = 64


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable ones stand for themselves, the others follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


def refuse_others(spec: dict, path: str) -> None:
    """Raises unless the file asks for exactly what is built here: byte-level BPE on PATTERN's pre-tokens of the text as it is."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = {
        "a byte-level BPE model": model.get("type", "BPE") == "BPE" and not model.get("byte_fallback") and not model.get("dropout") and not model.get("ignore_merges"),
        "no prefix or suffix of subwords": not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"),
        "no normalizer": not spec.get("normalizer"),
        "byte-level pre-tokens": before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space"),
        "plain added tokens": not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])),
    }
    if missing := [k for k, ok in plain.items() if not ok]:
        raise ValueError(f"{path} is not a tokenizer file of this kind: it lacks {', '.join(missing)}")


class Coder:
    """Encoder and decoder of one tokenizer file (JSON with a byte-level BPE model)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        refuse_others(spec, path)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        self.byte_ids = [vocab[c] for c in symbols]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        # (left << 20 | right) -> rank << 20 | merged id
        # ranks count from 1, so that no entry is 0
        self.ranks = {vocab[a] << 20 | vocab[b]: i << 20 | vocab[a + b] for i, (a, b) in enumerate(pairs, 1)}
        self.byte_pairs = [self.ranks.get(a << 20 | b, 0) for a in self.byte_ids for b in self.byte_ids]
        self.strings: list[bytes] = [b""] * (max(chain(vocab.values(), (t["id"] for t in spec["added_tokens"]))) + 1)
        for s, i in vocab.items():
            self.strings[i] = bytes(back[c] for c in s)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s, i in self.added.items():
            self.strings[i] = s.encode()
        self.split_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.pattern = regex.compile(PATTERN)
        self.names = Ragged([b"%d," % i for i in range(len(self.strings))])
        self.spelled = Ragged(self.strings)
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def merge(self, raw: bytes) -> list[int]:
        """The ids of one pre-token.

        A queue entry is one integer, rank, merged id and place from the top; due[i] is the entry
        that holds for the pair that starts at place i now, so any other entry of i is stale.
        """
        n = len(raw)
        ids = list(map(self.byte_ids.__getitem__, raw))
        if n == 1:
            return ids
        rank = self.ranks.get
        shift = 24 if n < 1 << 24 else 48
        place = (1 << shift) - 1
        first = self.byte_pairs
        due = [e << shift | i if (e := first[x << 8 | y]) else 0 for i, (x, y) in enumerate(pairwise(raw))]
        due.append(0)
        queue = [e for e in due if e]
        if not queue:
            return ids
        heapify(queue)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while queue:
            e = heappop(queue)
            i = e & place
            if due[i] != e:
                continue  # stale
            j = after[i]
            new = ids[i] = e >> shift & 0xFFFFF
            ids[j] = -1
            due[i] = due[j] = 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                got = rank(new << 20 | ids[k])
                if got is not None:
                    e = due[i] = got << shift | i
                    heappush(queue, e)
            h = before[i]
            if h >= 0:
                got = rank(ids[h] << 20 | new)
                if got is not None:
                    e = due[h] = got << shift | h
                    heappush(queue, e)
                else:
                    due[h] = 0
        return [x for x in ids if x >= 0]

    def word(self, text: str) -> bytes:
        """The ids of one pre-token, remembered."""
        got = self.words.get(text)
        if got is None:
            got = self.old_words.get(text) or self.ids_of(text)
            if len(text) <= LONG_PIECE:
                if len(self.words) >= REMEMBERED:
                    self.old_words, self.words = self.words, {}
                self.words[text] = got
        return got

    def ids_of(self, word: str) -> bytes:
        return np.array(self.merge(word.encode("utf-8", "replace")), np.int32).tobytes()

    def forget(self) -> None:
        self.words, self.old_words = {}, {}

    def piece(self, text: str) -> bytes:
        """The ids of a text that holds no added token."""
        got = self.words.get(text)
        if got is not None or not text:
            return got or b""
        if text[0] == " ":
            # a space, letters and perhaps plain marks: the pattern's matches without the pattern
            body = text[1:]
            if body.isalpha():
                return self.word(text)
            core = body.rstrip(PLAIN_MARKS)
            if core.isalpha():
                cut = len(core) + 1
                return self.word(text[:cut]) + self.word(text[cut:])
        return b"".join(map(self.word, self.pattern.findall(text)))

    def with_added(self, text: str) -> bytes:
        """The ids of a text that may hold added tokens: their strings give their ids, as the vocabulary's library does by default."""
        if self.split_added is None or not any(x in text for x in self.added):
            return self.piece(text)
        out: list[bytes] = []
        at = 0
        for m in self.split_added.finditer(text):
            out += [self.piece(text[at : m.start()]), np.int32(self.added[m[0]]).tobytes()]
            at = m.end()
        return b"".join([*out, self.piece(text[at:])])

    def encode_all(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and n + 1 bounds of the texts in it."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        cut = data == 0x20
        cut[0] = False
        marked = (data >= 0x21) & (data <= 0x7E)
        # the end of a code point of two bytes from U+00C0 on, none of which is white space
        marked[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
        cut[1:] &= marked[:-1]
        full = offsets[:-1][offsets[:-1] < offsets[1:]]
        if any(" " in x for x in self.added):
            cut[:] = False  # a cut could fall into such a token
        cut[full] = True
        start = np.flatnonzero(cut)
        # equal pieces, byte for byte, are encoded once
        tiles = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(start, n)), pa.py_buffer(data)).dictionary_encode()
        strings, which = tiles.dictionary, tiles.indices.to_numpy()
        raw = data.tobytes()
        encode = self.with_added if any(x.encode() in raw for x in self.added) else self.piece
        del raw, tiles, cut, marked
        flat, sizes = self.all_of(strings, encode)
        each = sizes[which]
        ids = flat[spread((np.cumsum(sizes) - sizes)[which], each)]
        total = np.concatenate([[0], np.cumsum(each)])
        return ids, total[np.searchsorted(start, offsets)]

    def all_of(self, strings: pa.Array, encode: Callable[[str], bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all pieces, how many each has)."""
        table = list(map(encode, strings.to_numpy(zero_copy_only=False).tolist()))
        return np.frombuffer(b"".join(table), np.int32), np.fromiter(map(len, table), np.int64, len(table)) >> 2

    def encode(self, text: str | None) -> list[int]:
        data = np.frombuffer((text or "").encode(), np.uint8)
        return self.encode_all(data, np.array([0, len(data)]))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.spelled.joined(np.asarray(ids, np.int64)).tobytes().decode("utf-8", "replace")


class Ragged:
    """Byte strings by number, to be joined many at a time."""

    def __init__(self, strings: list[bytes]) -> None:
        self.sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, which: np.ndarray) -> np.ndarray:
        return self.data[spread(self.starts[which], self.sizes[which])]

    def texts(self, which: np.ndarray, bounds: np.ndarray) -> Iterator[list[np.ndarray]]:
        """The joined strings of each run which[bounds[i]:bounds[i + 1]], in parts of bounded size."""
        i, docs = 0, len(bounds) - 1
        while i < docs:
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + SPELLED, "right")) - 1)
            if j == i + 1:
                yield [self.joined(which[a : min(a + SPELLED, bounds[j])]) for a in range(bounds[i], bounds[j], SPELLED)]
            else:
                part = self.joined(which[bounds[i] : bounds[j]])
                at = np.concatenate([[0], np.cumsum(self.sizes[which[bounds[i] : bounds[j]]])])[bounds[i : j + 1] - bounds[i]]
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    yield [part[a:b]]
            i = j


@functools.lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One coder a worker process and file."""
    return Coder(path)


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row a document: the key, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded text); with_ids: also the ids themselves.

    `path` is the tokenizer file, which every executor must be able to open.  Null texts count as empty.
    """
    fields = [docs.schema[key].simpleString().split(":", 1)[1]]
    schema = f"`{key}` {fields[0]}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in pieces(batches, most=BATCH):
            ids, bounds = c.encode_all(*text_bytes(batch.column(1)))
            digests, decoded = [], []
            for parts in c.names.texts(ids, bounds):
                digest = hashlib.sha256()
                for i, x in enumerate(parts, 1):
                    digest.update(x[:-1] if i == len(parts) else x)  # no comma after the last
                digests.append(digest.hexdigest())
            for parts in c.spelled.texts(ids, bounds):
                raw = b"".join(x.tobytes() for x in parts)
                try:
                    raw.decode()
                except UnicodeDecodeError:
                    raw = raw.decode("utf-8", "replace").encode()
                decoded.append(hashlib.sha256(raw).hexdigest())
            columns = [batch.column(0), pa.array(np.diff(bounds)), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)))
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])

    return docs.select(docs[key], docs[text].alias("text")).mapInArrow(tidy(run, lambda: coder(path).forget()), schema)
