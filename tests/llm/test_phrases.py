"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, most, covered):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, 5):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        over = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    over[p[i : i + m]] = max(over[p[i : i + m]], a)
        rows = []
        for p, a in candidates.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * over[p] < covered * a:
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n + 1, p.decode(), -a, l, r, words[lang], -s) for n, (s, a, p, l, r) in enumerate(sorted(rows)[:most])]
    return sorted(out)


def mined(spark, rows, least=3, most=2000, covered=80):
    docs = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(4)
    got = phrases.collocations(docs, least, most, covered)
    return sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(rng, n):
    words = ["Alpha", "beta", "gamma", "déjà", "x y", "of", "the", "#1", "Ünder", "longer-than-seven-bytes", "longer-than-seven-bytez", "-"]
    joints = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "!", "\r", "\x0b", " "]
    text = lambda: "".join(rng.choice(words) + rng.choice(joints) for _ in range(rng.randrange(60)))
    return [(rng.choice(["en", "fr", None, "und"]), text()) for _ in range(n)]


@pytest.mark.parametrize("most", [2000, 5])
def test_collocations_equal_a_plain_count(spark, most):
    rng = random.Random(most)
    rows = corpus(rng, 300)
    rows += [("en", "strong tea of the strong tea of the house " * 3)] * 200 + [("en", None), (None, ""), ("fr", " \t\n.")]  # copies
    rows.append(("de", "one two " * 40_000))  # a long text, one hot phrase that overlaps itself
    assert mined(spark, rows, 3, most) == plain(rows, 3, most, 80)


def test_least_counts_are_met_over_all_chunks(spark):
    rows = [("en", f"rare pair w{i}") for i in range(30)] + [("en", f"one less v{i}") for i in range(29)]
    assert [r[2:4] for r in mined(spark, rows, 30)] == [("rare pair", 30)]
    assert mined(spark, rows, 300) == []  # beyond a byte a count
    assert mined(spark, []) == []


def test_ties_go_to_the_first_cut_and_the_smaller_phrase(spark):
    rows = [("en", "b a. a b. c d e")] * 4
    got = mined(spark, rows, 4)
    assert got == plain(rows, 4, 2000, 80) and [r[2] for r in got] == ["c d e", "a b", "b a"]


def test_clashing_columns(spark):
    docs = spark.createDataFrame([("a b", "en")] * 3, "text string, lang string").select("*", *[F.lit(1).alias(c) for c in ("phrase", "chunk", "n", "size", "bucket", "rank", "score", "a")])
    assert [tuple(r) for r in phrases.collocations(docs, 3).collect()] == [("en", 1, "a b", 3, 3, 3, 6, 1000000)]


def test_a_chunk_counts_the_intervals_of_its_suffix_array():
    texts = ["a b a b a b. a", "b a b", None]
    c = phrases.Chunk(pa.table({"lang": pa.chunked_array([["en", "en", "fr"]]), "text": pa.chunked_array([texts])}))
    got = {}
    for n in range(1, 5):
        which = np.flatnonzero(c.length == n)
        if len(which):
            got |= dict(zip(c.phrases(which)[1].to_pylist(), c.count[which].tolist(), strict=True))
    assert got == {"a": 5, "b": 5, "a b": 4, "b a": 3, "a b a": 2, "b a b": 3, "a b a b": 2, "b a b a": 1}
    assert len(np.unique(c.hash)) == len(c.hash)
