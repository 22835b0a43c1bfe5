"""Secret scans through a trigram inverted index.

From every rule's regular expression a Boolean trigram query is derived: which trigrams each match
must hold, as ands and ors.  The index is sharded by document and lives as long as its shard is scanned: each batch of texts builds postings
(trigram -> documents) of the trigrams that some rule asks for, over ASCII lower-cased bytes; the
queries intersect and unite postings, and only candidate documents are searched with the regex.
Rules without mandatory trigrams scan every text.  Nothing is shuffled, so one hot source or a large
group of copies weighs no more than its bytes.

Spans are code points, end exclusive; null and empty texts have none.  Matches of a rule are leftmost
and do not overlap; those that fail the rule's length test are dropped after matching.  Spans that start at one
place come in the order of the rules.  Repeated rows are scanned each; an empty table gives an empty result; scan_secrets
reads the key and the text only, redact passes all columns on, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernel import pieces, text_bytes, tidy


@dataclass(frozen=True)
class Rule:
    """kind; pattern; group and least: the shortest length of that group; flags of re."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = 0


#: The kinds of the registered query, in their order.
BASE_RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, re.ASCII),
    Rule("hex", r"[0-9a-f]+", 0, 24, re.ASCII),
)
#: What the method adds: keys and tokens of other well-known forms.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(-----END [A-Z ]*PRIVATE KEY-----)?", 0, 1, re.ASCII),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, re.ASCII),
    Rule("prefixed", r"(gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})", 0, 1, re.ASCII),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]+:[^\s/:@]+@", 0, 1, re.ASCII),
)

# A trigram query: True (every text may match), a trigram code, or ("and" | "or", queries).


def _join(kind: str, queries: list) -> object:
    if kind == "and":
        queries = [q for q in queries if q is not True]
    elif any(q is True for q in queries):
        return True
    queries = list(dict.fromkeys(queries))
    if not queries:
        return True
    return queries[0] if len(queries) == 1 else (kind, tuple(queries))


def _of_string(s: bytes) -> object:
    return _join("and", [s[i] << 16 | s[i + 1] << 8 | s[i + 2] for i in range(len(s) - 2)])


def _lower(code: int) -> bytes:
    return chr(code).encode("utf-8", "surrogatepass").lower()


def trigram_query(pattern: str, flags: int = 0, most: int = 32) -> object:
    """The query that every text with a match of the pattern satisfies, over ASCII lower-cased UTF-8."""

    def sequence(nodes) -> tuple[set[bytes] | None, object]:
        """(the exact strings the nodes may match or None if not few, the query)."""
        found: list = []
        run: set[bytes] = {b""}

        def close() -> None:
            nonlocal run
            found.append(_join("or", [_of_string(s) for s in run]))
            run = {b""}

        whole = True
        for op, av in nodes:
            exact, query = node(op, av)
            if exact is not None and len(run) * len(exact) <= most:
                run = {a + b for a in run for b in exact}
            else:
                whole = False
                close()
                found.append(query)
                if exact is not None and len(exact) <= most:
                    run = set(exact)
        exact = run if whole else None
        close()
        return exact, _join("and", found)

    def node(op, av) -> tuple[set[bytes] | None, object]:
        if op is C.LITERAL:
            # without ASCII, other letters may fold to this one
            return (None, True) if flags & re.IGNORECASE and not flags & re.ASCII else ({_lower(av)}, True)
        if op is C.IN:
            if all(o is C.LITERAL for o, _ in av) and len(av) <= 4 and not (flags & re.IGNORECASE and not flags & re.ASCII):
                return {_lower(v) for _, v in av}, True
            return None, True
        if op is C.SUBPATTERN:
            return sequence(av[-1])
        if op is C.BRANCH:
            each = [sequence(x) for x in av[1]]
            if all(e is not None for e, _ in each) and sum(len(e) for e, _ in each) <= most:
                exact = set().union(*(e for e, _ in each))
                return exact, _join("or", [_of_string(s) for s in exact])
            return None, _join("or", [_join("and", [q, *([_join("or", [_of_string(s) for s in e])] if e is not None else [])]) for e, q in each])
        if op in (C.MAX_REPEAT, C.MIN_REPEAT, getattr(C, "POSSESSIVE_REPEAT", None)):
            low, high, inner = av
            exact, query = sequence(inner)
            if low == 0:
                return ({b""} | exact, True) if high == 1 and exact is not None and len(exact) < most else (None, True)
            if low == high == 1:
                return exact, query
            if exact is not None and len(exact) == 1 and low <= 8:
                (s,) = exact
                return ({s * low}, True) if low == high else (None, _of_string(s * low))
            return None, _join("and", [query, *([_join("or", [_of_string(s) for s in exact])] if exact is not None else [])])
        if op is C.AT:
            return {b""}, True
        return None, True

    exact, query = sequence(_parser.parse(pattern, flags))
    return query if exact is None else _join("and", [query, _join("or", [_of_string(s) for s in exact])])


def trigrams_of(query: object) -> set[int]:
    if query is True:
        return set()
    if isinstance(query, tuple):
        return set().union(*(trigrams_of(q) for q in query[1]))
    return {query}


def postings(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> dict[int, np.ndarray]:
    """The index of a batch: trigram -> documents that hold it, ascending. wanted: by code, whether some rule asks for the trigram."""
    low = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data).astype(np.uint32)
    if len(low) < 3:
        return {}
    codes = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
    at = np.flatnonzero(wanted[codes])
    doc = np.searchsorted(offsets, at, "right") - 1
    inside = at + 3 <= offsets[doc + 1]
    both = np.unique(codes[at[inside]].astype(np.int64) << 32 | doc[inside])
    code, doc = both >> 32, both & 0xFFFFFFFF
    cuts = np.flatnonzero(np.diff(code)) + 1
    return {int(c[0]): d for c, d in zip(np.split(code, cuts), np.split(doc, cuts), strict=True) if len(c)}


def candidates(query: object, index: dict[int, np.ndarray], docs: int) -> np.ndarray:
    """Documents that satisfy the query."""
    if query is True:
        return np.arange(docs)
    if not isinstance(query, tuple):
        return index.get(query, np.zeros(0, np.int64))
    each = [candidates(q, index, docs) for q in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(each))
    each.sort(key=len)
    out = each[0]
    for x in each[1:]:
        out = np.intersect1d(out, x, assume_unique=True)
    return out


class Scanner:
    """Compiled rules and their queries."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        self.compiled = [re.compile(r.pattern, r.flags) for r in rules]
        # a run of one class that must be long is searched for at that length at once: the same matches
        for i, r in enumerate(rules):
            if r.group == 0 and r.least > 1 and re.fullmatch(r"\[[^\]]+\]\+", r.pattern):
                self.compiled[i] = re.compile(f"{r.pattern[:-1]}{{{r.least},}}", r.flags)
        self.wanted = np.zeros(1 << 24, bool)
        for q in self.queries:
            self.wanted[list(trigrams_of(q))] = True

    def spans(self, col: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule number, end), sorted."""
        out: list[list] = [[] for _ in range(len(col))]
        data, offsets = text_bytes(col)
        index = postings(data, offsets, self.wanted)
        for n, (rule, query, found) in enumerate(zip(self.rules, self.queries, self.compiled, strict=True)):
            for d in candidates(query, index, len(col)).tolist():
                if offsets[d] == offsets[d + 1]:
                    continue
                text = col[d].as_py()
                for m in found.finditer(text):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[d].append((m.start(), n, m.end()))
        for x in out:
            x.sort()
        return out


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", base: tuple[Rule, ...] = BASE_RULES, more: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """One row a document: the key, n_<kind> of each base kind, base_sha256 (of `kind:start:end` of the base spans, by start, then kind as listed, joined by commas), spans (all of them, joined likewise)."""
    rules = (*base, *more)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {''.join(f'n_{r.kind} long, ' for r in base)}base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in pieces(batches):
            found = scanner.spans(batch.column(1))
            told = [[f"{rules[n].kind}:{a}:{b}" for a, n, b in x] for x in found]
            basic = [[s for s, (_, n, _) in zip(t, x, strict=True) if n < len(base)] for t, x in zip(told, found, strict=True)]
            counts = [pa.array([sum(n == i for _, n, _ in x) for x in found], pa.int64()) for i in range(len(base))]
            digests = pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in basic], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, pa.array([",".join(x) for x in told], pa.string())], names=[key, *(f"n_{r.kind}" for r in base), "base_sha256", "spans"])

    return docs.select(docs[key], docs[text].alias("text")).mapInArrow(tidy(run), schema)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", length: str | None = "n_chars") -> DataFrame:
    """docs with every span replaced by the mark (spans that touch or overlap become one); null texts stay null; length: a column that then holds the new number of code points."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner((*BASE_RULES, *MORE_RULES))
        for batch in pieces(batches, text):
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            changed = {}
            for i, spans in enumerate(scanner.spans(batch.column(at))):
                if not spans:
                    continue
                out, pos = [], 0
                merged: list[list[int]] = []
                for a, _, b in spans:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                for a, b in merged:
                    out += [texts[i][pos:a], mark]
                    pos = b
                changed[i] = texts[i] = "".join([*out, texts[i][pos:]])
            if changed:
                columns = batch.columns
                columns[at] = pa.array(texts, batch.column(at).type)
                if length and (n := batch.schema.get_field_index(length)) >= 0:
                    sizes = batch.column(n).to_pylist()
                    for i, x in changed.items():
                        sizes[i] = len(x)
                    columns[n] = pa.array(sizes, batch.column(n).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(tidy(run), schema)
