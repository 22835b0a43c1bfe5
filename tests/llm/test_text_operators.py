import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, jaccard, kernel, lm, mixing, quality, queries, repeats, secrets, toxicity, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, chunk string, kept string, gone_id long, mix_turn int"
EDGE = [None, "", " ", "\n\n", "a", "é\u3000b", "x " * 40, "\x1c\x1d", "word" * 3000, "<|endoftext|> a  b"]


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t), 7, "c", "k", 9, 3) for i, t in zip(ids, texts, strict=True)], DOCS)


def thue_morse(n, first="a"):
    """Of n letters: with the other first letter, a word that many hashes by polynomials cannot tell from it."""
    other = {"a": "b", "b": "a"}
    out = first
    while len(out) < n:
        out += "".join(other[c] for c in out)
    return out


def sentences(seed, n, shared=0.3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(300)]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(10, 40))] for _ in range(6)]
    out = []
    for _ in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 120))]
        if rng.random() < shared:
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        out.append(rng.choice([" ", "\n", "\t"]).join(words))
    return out + rng.sample(out, n // 5)


def test_words_and_hashes():
    texts = [*EDGE, *sentences(1, 30)]
    w = kernel.words_of(pa.array(texts))
    want = [(d, x) for d, t in enumerate(texts) for x in WORD.findall(t or "")]
    raw = w.data.tobytes()
    assert [(int(d), raw[a:b].decode()) for d, a, b in zip(w.doc, w.start, w.end, strict=True)] == want
    by = {}
    for (_, x), h in zip(want, w.hashes().tolist(), strict=True):
        assert by.setdefault(x, h) == h
    assert len(set(by.values())) == len(by)
    at, h = kernel.windows(w.hashes(), w.doc, 3)
    seen = {}
    for i, x in zip(at.tolist(), h.tolist(), strict=True):
        assert seen.setdefault(tuple(want[i + k][1] for k in range(3)), x) == x
    # segments and batching change nothing
    kernel.SEGMENT, old = 16, kernel.SEGMENT
    try:
        assert (kernel.words_of(pa.array(texts)).hashes() == w.hashes()).all()
        assert (kernel.windows(w.hashes(), w.doc, 3)[1] == h).all()
    finally:
        kernel.SEGMENT = old
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    assert [t for b in kernel.pieces(iter([batch]), most=50) for t in b.column(0).to_pylist()] == texts


def test_urls(spark):
    given = ["http://A.Example.com/en/1?x#y", "https://www.example.com/en/", "ftp://example.com/fr/", "http://x.net/es/a", "http://net/fr/", "http://notnet/fr/", "nourl", None, "http://", "http://b.net", "http://x.org/a://b.com/", "http://h.com:80/en/", "http://com/en?", "http://é.com/ü"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate([*given, given[0]])] + [(0, given[0], "h", "r"), (None, given[0], "h", "r")], "page_id long, url string, host string, rule string")
    got = sorted((r["page_id"] is None, r["page_id"] or 0, r["host"], r["path"], r["rule"], r["verdict"]) for r in queries.urls.judge(pages, spark.createDataFrame(urls.CONTRACT_RULES, urls.RULES)).collect())

    def one(u):
        rest = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for h, p, v in urls.CONTRACT_RULES if ("." + host).endswith("." + h) and path.startswith(p)]
        return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")

    want = [(r["page_id"] is None, r["page_id"] or 0, *one(r["url"])) for r in pages.collect()]
    assert got == sorted(want)
    urls.MOST_BROADCAST, old = 0, urls.MOST_BROADCAST
    try:
        again = queries.urls.judge(pages, spark.createDataFrame(urls.CONTRACT_RULES, urls.RULES))
        assert sorted((r["page_id"] is None, r["page_id"] or 0, r["host"], r["path"], r["rule"], r["verdict"]) for r in again.collect()) == got
    finally:
        urls.MOST_BROADCAST = old
    assert queries.urls.judge(pages.limit(0), spark.createDataFrame([], urls.RULES)).count() == 0
    none = queries.urls.judge(pages, spark.createDataFrame([], urls.RULES), default="block")
    assert {r["verdict"] for r in none.collect()} == {"block"}


def test_urls_with_many_shapes_of_rules(spark):
    rng = random.Random(21)
    deep = ".".join("abcdefghijkl")  # more labels than a key holds
    hosts = ["a.b", "b", "x.a.b", deep, "z." + deep, "y.z." + deep[2:], "ü.b"]
    paths = ["", "/", "/p", "/p/q", "/" + "r" * 300, "/" + "r" * 299 + "s", "/é"]
    rules = [(rng.choice(hosts), p, v) for p in paths for v in ("allow", "block") for _ in range(3)] + [("", "/", "block"), (None, "/", "block"), ("a.b", None, "block"), ("a.b", "/", None)]
    urls_ = [f"http://{h}{p}{rng.choice(['', 'x', '?q'])}" for h in hosts for p in paths]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, spark.createDataFrame(rules, urls.RULES)).collect()}
    for i, u in enumerate(urls_):
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if h and p is not None and v and ("." + host).endswith("." + h) and path.startswith(p)]
        assert got[i] == ((max(fits)[3], max(fits)[2]) if fits else (None, "allow")), u


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    rng = random.Random(2)
    letters = [*"abT zé\n\t'12!?½漢\U0001f600", "\x1c", "\x85", "\u00a0", "\u3000", "\u200b", "<|endoftext|>", "'ll", "'s", "  "]
    texts = [*EDGE, *sentences(3, 20), *("".join(rng.choices([*letters, " ", " "], k=rng.randint(0, 40))) for _ in range(400)), "the " * 50_000]
    texts += [thue_morse(n, c) for n in (1024, 2048, 4096) for c in "ab"]
    got = {r["doc_id"]: r for r in bpe.encode_decode(documents(spark, texts), queries.tokenizer_path(), with_ids=True).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_decode(documents(spark, []), queries.tokenizer_path()).count() == 0
    c = bpe.coder(queries.tokenizer_path())
    assert c.decode([c.byte_ids[0xC3], c.byte_ids[0x28]]) == "\ufffd("


def removed(rows, k=13):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        for a in range(len(w) - k + 1):
            key = tuple(w[a : a + k])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in words:
        gone = {a + b for a in range(len(w) - k + 1) if least[tuple(w[a : a + k])] < i for b in range(k)}
        out.append((i, len(w), len(gone), " ".join(x for a, x in enumerate(w) if a not in gone)))
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_repeats_equal_brute_force(spark, small, monkeypatch):
    texts = [*EDGE, *sentences(5, 60, 0.6), "same " * 40, "same " * 40]
    texts += [f"{thue_morse(n, c)} and twelve more words that both of these texts share word by word" for n in (1024, 2048, 4096) for c in "ab"]
    ids = [*range(len(texts) - 1), 3]  # an id twice
    if small:
        monkeypatch.setattr(repeats, "CHUNK", 3000)
        monkeypatch.setattr(repeats, "LEAST_CHUNK", 10)
    got = repeats.remove_repeats(documents(spark, texts, ids)).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == removed(list(zip(ids, texts, strict=True)))
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:], strict=False))
    assert repeats.remove_repeats(documents(spark, [])).count() == 0
    assert repeats.remove_repeats(documents(spark, [None, "a"], [None, 1])).count() == 2


def shingles(t, k=5):
    w = WORD.findall(t or "")
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def near_texts():
    rng = random.Random(8)
    base = [[rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 90))] for _ in range(25)]
    common = "this passage is in very many of the documents here".split()
    out = []
    for b in base:
        for _ in range(rng.choice([1, 1, 3, 8])):
            w = list(b)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = "changed" + str(rng.randint(0, 9))
            out.append(" ".join(w + common * (rng.random() < 0.5)))
    strange = [" ".join([thue_morse(n, c), "x", thue_morse(n, c), "y", thue_morse(n, c)]) for n in (1024, 2048, 4096) for c in "ab"]
    return [*out, *out[:10], None, "", " ", "a b", "a b", "a  b", "a b c", *strange]


@pytest.mark.parametrize("small,block,mass", [(256, 1024, 1 << 21), (3, 1024, 300), (2, 3, 1 << 21)])
def test_jaccard_equals_brute_force(spark, small, block, mass, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "MASS", mass)
    texts = near_texts()
    sets = [shingles(t) for t in texts]
    n = len(texts)
    links = [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        for i in range(n):
            root[i] = min([root[i], *(root[j] for j in links[i])])
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(documents(spark, texts), recall=0.99999).collect()}
    assert got == {i: (root[i], len(links[i])) for i in range(n)}
    if small == 256:
        kept = jaccard.keep_one(documents(spark, texts))
        assert kept.columns == documents(spark, []).columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in range(n) if root[i] == i)


def test_a_common_passage_costs_levels_not_squares(spark, monkeypatch):
    """Texts that share only a passage part from one another below it; near copies among them are found."""
    monkeypatch.setattr(jaccard, "SMALL", 8)
    rng = random.Random(12)
    passage = "a passage that a great many of these documents hold word by word from its first to its last one".split()
    own = [[f"w{rng.randint(0, 10**6)}" for _ in range(30)] for _ in range(150)]
    texts = [" ".join(w + passage) for w in own] + [" ".join([*w[:-1], "other", *passage]) for w in own[:20]]
    rows = jaccard.sketch(documents(spark, texts).select(F.col("doc_id").alias("id"), "text"), 5)
    leaves = jaccard.leaf_buckets(rows.select("id", "n", "samples"), 4)
    sizes = [r["count"] for r in leaves.groupBy("bucket").count().collect()]
    assert max(sizes) <= 40  # of 170 that share the passage
    got = {r["doc_id"]: r["class_id"] for r in jaccard.near_duplicates(documents(spark, texts)).collect()}
    assert got == {i: i if i < 150 else i - 150 for i in range(170)}
    # near copies by the dozen are not split, which would only multiply them
    copies = [" ".join([*own[0], *passage, f"v{i}"]) for i in range(60)]
    rows = jaccard.sketch(documents(spark, copies).select(F.col("doc_id").alias("id"), "text"), 5)
    assert jaccard.leaf_buckets(rows.select("id", "n", "samples"), 4).count() <= 60 * 4 * 8
    assert {(r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(documents(spark, copies)).collect()} == {(0, 59)}


def test_texts_of_many_sizes_are_not_split_below_a_passage(spark, monkeypatch):
    """Few pairs of a large bucket can be near copies if its sizes are far apart: it is compared, and makes no rows of paths."""
    monkeypatch.setattr(jaccard, "SMALL", 8)
    rng = random.Random(13)
    passage = "a passage that a great many of these documents hold word by word from its first to its last one".split()
    own = [[f"w{rng.randint(0, 10**6)}" for _ in range(int(10 * 1.1**i))] for i in range(50)]
    texts = [" ".join(w + passage) for w in own] + [" ".join([*w[:-1], "other", *passage]) for w in own[10:]]
    split = []
    below = jaccard.next_level
    monkeypatch.setattr(jaccard, "next_level", lambda large: split.append(large.count()) or below(large))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(documents(spark, texts), recall=0.99999).collect()}
    sets = [shingles(t) for t in texts]
    links = [[j for j in range(90) if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(90)]
    assert got == {i: (min([i, *links[i]]), len(links[i])) for i in range(90)}
    assert not split


def test_jaccard_edges(spark):
    assert jaccard.near_duplicates(documents(spark, [])).count() == 0
    # of rows with one id the smallest text counts, for the classes and the links alike
    twice = documents(spark, ["b " * 9, "a c d e f g h", "a c d e f g h", "b " * 9], [5, 5, 6, 7])
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(twice).collect()) == [(5, 5, 1), (6, 5, 1), (7, 7, 0)]
    rows = jaccard.near_duplicates(documents(spark, ["a b c d e f", "a b c d e f", "x", None], [1, 1, None, 2])).collect()
    assert sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"]) for r in rows) == [(0, 0, 0), (1, 1, 0), (2, 2, 0)]


def test_shortages_go_to_siblings_first(spark):
    rows = [(i, "web", "en", "s1", 10) for i in range(10)] + [(100 + i, "web", "fr", "s2", 10) for i in range(100)] + [(300 + i, "books", "en", "s3", 10) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, n_tokens long")
    got = mixing.mix(docs, mixing.LEVELS, {"domain": {"web": 1, "books": 1}}, epochs=2, percent=50)
    sums = {(r["domain"], r["lang"]): r["n"] for r in got.groupBy("domain", "lang").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("n")).collect()}
    # 1050 tokens, 525 a domain (of which whole documents of 10 fit); the short language gives its 62 to its sibling
    assert sums == {("web", "en"): 200, ("web", "fr"): 320, ("books", "en"): 520}
    assert {r["copies"] for r in got.where("source = 's1'").collect()} == {2}
    assert mixing.mix(docs, mixing.LEVELS, {}, seed=1).where("copies > 0").count() != 0
    assert mixing.mix(docs.limit(0), mixing.LEVELS, {}).count() == 0


def test_wide_families_are_shared_alike(spark):
    rng = random.Random(31)
    rows = [(p, f"c{i}", rng.choice([0, 1, 1, 2, 5]), rng.choice([0, 7, 7, 100, rng.randint(0, 5000)]), b) for p, b in (("a", 20_000), ("b", 999_999), ("c", 0), ("d", 17)) for i in range(60)]
    nodes = spark.createDataFrame(rows, "parent string, child string, weight long, cap long, budget long").withColumn("weight", F.when(F.col("cap") > 0, F.col("weight")).otherwise(0)).withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0))
    most = nodes.groupBy("parent").agg(F.sum("cap").alias("most"))
    nodes = nodes.join(most, "parent").withColumn("budget", F.least("budget", "most")).drop("most")
    told = lambda df: sorted((r["parent"], r["child"], r["given"], r["cap"], r["budget"]) for r in df.collect())
    narrow, wide = (told(mixing.share(nodes, ["parent"], "child", w)) for w in (False, True))
    assert narrow == wide and all(0 <= g <= c for _, _, g, c, _ in narrow)
    given, budgets = Counter(), {}
    for p, _, g, _, b in narrow:
        given[p] += g
        budgets[p] = b
    assert given == budgets
    one = nodes.where("parent = 'a'").drop("parent")
    assert [sorted((r["child"], r["given"]) for r in mixing.share(one, [], "child", w).collect()) for w in (False, True)] == [[(c, g) for p, c, g, _, _ in narrow if p == "a"]] * 2


def test_mixture_ranges_and_nulls(spark, monkeypatch):
    texts = [*sentences(4, 200), None, ""]
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 11 == 0 else f"src{i % 3}", 1, 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_turn int, copies int")
    wide = {r["doc_id"]: r["copies"] for r in mixing.mix_documents(docs).collect()}
    monkeypatch.setattr(mixing, "RANGE", 3)
    assert {r["doc_id"]: r["copies"] for r in mixing.mix_documents(docs).collect()} == wide and len(wide) == len(texts)
    out = mixing.mixture(docs)
    assert out.columns == docs.columns and Counter(r["doc_id"] for r in out.collect()) == {k: v for k, v in wide.items() if v}


def base_of(t):
    w = WORD.findall(t or "")
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit), failed


def test_quality(spark):
    good = [t for t in sentences(6, 80) if len(t) > 400]
    junk = [" ".join(w + random.Random(i).choice(["###", "$$$", "%%%"]) for w in t.split()) for i, t in enumerate(good[:20])]
    texts = [*EDGE, *good, *junk, "a b c " * 30, "line one\nline one\n\n \x1f\nline one"]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(len(EDGE) <= i < len(EDGE) + len(good)), 0) for i in range(0, len(texts), 2)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.judge_quality(docs, labels).collect()}
    assert len(got) == len(texts)
    ratios = quality.learn(docs, labels)
    # the two counts, one n-gram at a time
    bucket = lambda raw, k: ((raw[k] << 16 | raw[k + 1] << 8 | raw[k + 2]) * 2654435761 % 2**32) >> (32 - quality.BITS)
    raws = [(t or "").encode() for t in texts]
    trusted = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    every = Counter(bucket(raw, k) for raw in raws for k in range(len(raw) - 2))
    target = Counter(bucket(raw, k) for i, raw in enumerate(raws) if i in trusted for k in range(len(raw) - 2))
    n, m, size = sum(every.values()), sum(target.values()), 1 << quality.BITS
    for b in (*list(every)[:300], 0, 1, 2):
        want = math.log((target[b] + 1) / (m + size)) - math.log((every[b] + 1) / (n + size))
        assert abs(int(ratios[b]) / quality.SCALE - want) < 2 / quality.SCALE
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base_of(t)
        raw = (t or "").encode()
        buckets = [((raw[k] << 16 | raw[k + 1] << 8 | raw[k + 2]) * 2654435761 % 2**32) >> (32 - quality.BITS) for k in range(len(raw) - 2)]
        assert math.isclose(r["log_ratio"], sum(int(ratios[b]) for b in buckets) / max(len(buckets), 1) / quality.SCALE, abs_tol=1e-9)
        assert r["kept"] == (not r["base_failed"] and r["log_ratio"] >= quality.THRESHOLD)
    assert not any(got[i]["kept"] for i in range(len(EDGE) + len(good), len(EDGE) + len(good) + len(junk)))
    assert all(got[i]["kept"] or got[i]["base_failed"] for i in range(len(EDGE), len(EDGE) + len(good)))
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in got.items() if r["kept"])
    assert quality.judge_quality(documents(spark, []), labels).count() == 0
    alone = {r["doc_id"]: r["kept"] for r in quality.judge_quality(docs, labels.limit(0)).collect()}
    assert alone == {i: not r["base_failed"] for i, r in got.items()}
    quality.MOST_BROADCAST, old = 0, quality.MOST_BROADCAST
    try:
        assert (quality.learn(docs, labels) == ratios).all()
    finally:
        quality.MOST_BROADCAST = old


def spans_of(t):
    out = []
    for n, (p, g, least) in enumerate([(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6), (r"AKIA[A-Z0-9]+", 0, 20), (r"[0-9a-f]+", 0, 24)]):
        out += [(m.start(), n, m.end()) for m in re.finditer(p, t or "") if m.end(g) - m.start(g) >= least]
    return sorted(out)


def test_secrets(spark):
    key = "AKIA" + "Z" * 16
    texts = [*EDGE, f'é token = "{"a1" * 20}" and {key}', "PassWord:abc secret=abcdef", "API_KEY='x' api_key: longenough1", "f" * 23, "f" * 24 + "g" + "0" * 30, key[:-1], "tokentoken=secret=123456", "no secrets here " * 500, '"secret":"password=abcdefgh"', "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + "." + "c" * 20, "http://u:pw@h", "ghp_" + "A" * 36]
    names = [r.kind for r in (*secrets.BASE_RULES, *secrets.MORE_RULES)]
    got = {r["doc_id"]: r for r in secrets.scan_secrets(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = spans_of(t)
        r = got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(n == k for _, n, _ in want) for k in range(3)), t
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{names[n]}:{a}:{b}" for a, n, b in want).encode()).hexdigest()
        told = [x for x in r["spans"].split(",") if x]
        assert [x for x in told if x.split(":")[0] in names[:3]] == [f"{names[n]}:{a}:{b}" for a, n, b in want]
    assert got[len(texts) - 1]["spans"] == "prefixed:0:40" and got[len(texts) - 3]["spans"].startswith("jwt:0:")
    # all spans are those of plain searches of every text by every rule
    texts2 = [*texts, "-----BEGIN RSA PRIVATE KEY-----\nAbc+/=\n-----END RSA PRIVATE KEY-----", "x -----BEGIN PRIVATE KEY-----abc", "postgres://me:pw0@db/x https://a:b@c http://a/b:c@d", "xoxb-0123456789-x sk_live_" + "a1" * 8, "gho_" + "Z9" * 18 + " AKIA" + "7" * 16, "ghp_short"]
    ids = [*range(len(texts2) - 1), 0]
    rows = secrets.scan_secrets(documents(spark, texts2, ids)).collect()
    want = Counter()
    for i, t in zip(ids, texts2, strict=True):
        spans = [(m.start(), n, m.end()) for n, rule in enumerate((*secrets.BASE_RULES, *secrets.MORE_RULES)) for m in re.finditer(rule.pattern, t or "", rule.flags) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        want[i, ",".join(f"{names[n]}:{a}:{b}" for a, n, b in sorted(spans))] += 1
    assert Counter((r["doc_id"], r["spans"]) for r in rows) == want
    assert any("private_key" in x for _, x in want) and sum("url_password" in x for _, x in want) == 2
    assert secrets.scan_secrets(documents(spark, [])).count() == 0 and secrets.redact(documents(spark, [])).count() == 0
    out = secrets.redact(documents(spark, texts))
    assert out.columns == documents(spark, []).columns
    red = {r["doc_id"]: r for r in out.collect()}
    assert red[0]["text"] is None and all(not spans_of(r["text"]) for r in red.values())
    assert all(r["n_chars"] == len(r["text"]) for r in red.values() if r["text"] is not None)


def test_trigram_queries_never_lose_a_match():
    q = secrets.trigram_query(r"AKIA[A-Z0-9]+")
    assert secrets.trigrams_of(q) == {int.from_bytes(x, "big") for x in (b"aki", b"kia")}
    assert secrets.trigram_query(r"[0-9a-f]+") is True and secrets.trigram_query(r"token", re.IGNORECASE) is True
    rng = random.Random(0)
    texts = ["".join(rng.choices("abcABC ", k=rng.randint(0, 14))) for _ in range(600)]
    for p in ("abc", "(abc|bca)a?b", "a(bc)+a", "(abca){2}", "abc?a", "ab[ac]b", "(a|b)cab*a", "a.cab"):
        rule = secrets.Rule("x", p, flags=re.ASCII | re.IGNORECASE)
        found = secrets.Scanner((rule,)).spans(pa.array(texts))
        assert [[(a, b) for a, _, b in x] for x in found] == [[m.span() for m in re.finditer(p, t, re.ASCII | re.IGNORECASE)] for t in texts], p


def test_lm_base_and_probabilities(spark):
    texts = [*EDGE, *sentences(9, 80), thue_morse(1024), thue_morse(1024, "b"), "same words"]
    ids = [*range(len(texts) - 1), 3]  # an id twice
    docs = documents(spark, [*texts, "no id"], [*ids, None])
    paths = queries.tokenizer_path(), queries.tokenizer_path("byte_bpe_50k.tiktoken")
    rows = lm.score_texts(docs, *paths).collect()
    got = {(r["doc_id"], r["n_tokens"]): r for r in rows}
    lower = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")] + [None]
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    every = [*zip(ids, texts, strict=True), (None, "no id")]
    counts = Counter(w for i, t in every if not is_held(i) for w in lower(t))
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(every)
    for i, t in every:
        w = lower(t)
        r = got[i, len(w)]
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (is_held(i), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r["score"] < 0
    # neither the order nor the partitions of the rows bear on the scores
    again = lm.score_texts(docs.repartition(7, "text"), *paths).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["n_tokens"])
    assert np.allclose([r["score"] for r in sorted(again, key=key)], [r["score"] for r in sorted(rows, key=key)], rtol=1e-6)
    assert lm.score_texts(documents(spark, []), *paths).count() == 0
    alone = next(i for i in range(99) if is_held(i))
    (r,) = lm.score_texts(documents(spark, ["only held out"], [alone]), *paths).collect()
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] < 0


@pytest.fixture(scope="module")
def small_model():
    code = lm.subwords(queries.tokenizer_path(), queries.tokenizer_path("byte_bpe_50k.tiktoken"))
    rng = np.random.default_rng(1)
    v = lm.Vocabulary.of(rng.zipf(1.5, len(code.strings) + 1), code.kinds)
    p = {k: x + rng.normal(0, 0.4, x.shape).astype(np.float32) for k, x in lm.start(v).items()}
    p["c"][lm.start(v)["c"] == lm.NOTHING] = lm.NOTHING
    return code, v, p


def test_lm_probabilities_sum_to_one_over_all_ids_and_the_end(small_model):
    code, v, p = small_model
    s = lm.Scorer(p, v)
    context = np.random.default_rng(2).integers(0, 50000, 37)
    *laid, first, _ = lm.laid_out(context, np.array([0, 37]), v)
    keys, goal = lm.groups(*laid, first[1:2])
    slots = np.unique(v.slot)
    which = np.full((len(slots), lm.STEP), -1)
    which[:, 5] = slots
    chance = np.exp(s.logs(np.repeat(keys, len(slots), 0), which.ravel()).reshape(len(slots), -1)[:, 5])
    of_slot = dict(zip(slots.tolist(), chance.tolist(), strict=True))
    total = sum(of_slot[a] * 10**b for a, b in zip(v.slot.tolist(), v.within.tolist(), strict=True))
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_lm_scores_are_causal_and_the_steps_follow_the_slope(small_model):
    code, v, p = small_model
    s = lm.Scorer(p, v)
    rng = np.random.default_rng(3)
    context = rng.integers(0, 50000, 37)
    base = s.score(context, np.array([0, 37]))[0]
    # batching and neighbours change nothing, and two subwords that change places change the score
    both = s.score(np.concatenate([context, context[:20]]), np.array([0, 37, 37, 57]))
    assert np.allclose(both, [base, s.score(context[:0], np.array([0, 0]))[0], s.score(context[:20], np.array([0, 20]))[0]], rtol=1e-5)
    order = np.argsort(v.row[context])[:2]  # ids with embeddings of their own
    other = context.copy()
    other[order] = other[order[::-1]]
    assert abs(s.score(other, np.array([0, 37]))[0] - base) > 1e-3
    # one step's loss by the training code and by the scorer
    *laid, first, _ = lm.laid_out(context, np.array([0, 37]), v)
    keys, goal = lm.groups(*laid, first)
    wide = {k: x.astype(np.float64) for k, x in p.items()}
    loss, slope = lm.train_step(wide, keys, goal, v.pad)
    assert math.isclose(-loss * 38 / math.log(10), base - v.within[context].sum() - v.within[-1], rel_tol=1e-4)
    for name, x in wide.items():
        at = np.unravel_index(np.argsort(-np.abs(slope[name]), axis=None)[:3], x.shape)
        for place in zip(*at, strict=True):
            before, ends = x[place], []
            for step in (1e-4, -1e-4):
                x[place] = before + step
                ends.append(lm.train_step(wide, keys, goal, v.pad)[0])
            x[place] = before
            assert math.isclose((ends[0] - ends[1]) / 2e-4, slope[name][place], rel_tol=0.02, abs_tol=1e-4), name


def test_lm_trains_on_every_window_and_weighs_by_windows(spark, small_model, monkeypatch):
    code, v, p = small_model
    monkeypatch.setattr(lm, "LEAST_STEPS", 5)
    monkeypatch.setattr(lm, "BATCH", 16)
    seen = Counter()
    monkeypatch.setattr(lm, "train_step", lambda p, keys, goal, pad: (seen.update(k.tobytes() for k in keys.astype(np.int16)), (0.0, {}))[1])
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 50000, rng.integers(0, 300)) for _ in range(40)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    trainer = lm.Trainer(p, v, 0.01, 0)
    for lo in range(0, 40, 7):
        trainer.texts(np.concatenate(texts[lo : lo + 7]), bounds[lo : lo + 8][: len(texts[lo : lo + 7]) + 1] - bounds[lo])
    trainer.finish()
    *laid, first, _ = lm.laid_out(np.concatenate(texts), bounds, v)
    want = Counter(k.tobytes() for k in lm.groups(*laid, first)[0].astype(np.int16))
    assert trainer.windows == len(first) and seen == want
    monkeypatch.undo()
    # units are weighed by their windows
    one, two = (lm.Trainer(p, v, 0.01, i) for i in (1, 2))
    one.windows, two.windows = 3, 1
    two.p = {k: x + 1 for k, x in two.p.items()}
    sums = one.sums() + two.sums()
    clipped = np.clip(lm.flatten(p), -lm.LARGEST, lm.LARGEST)
    assert sums[0] == 4 and np.allclose(lm.averaged(sums), clipped + 0.25, atol=1e-5)
    # rows are counted off alike, however the stream is cut
    table = pa.table({"slot": pa.array([0] * 70 + [1] * 130), "x": pa.array(range(200))})
    for size in (1, 64, 200):
        cut = [t["x"].to_pylist() for t in lm.counted_off(iter(table.to_batches(max_chunksize=size)), "slot", 64)]
        assert [len(x) for x in cut] == [64, 6, 64, 64, 2] and sum(cut, []) == list(range(200))


def test_lm_encodes_every_text_once(spark):
    """The first encoding keeps every text, held out or not, and gives its bytes back, so that scoring needs no second one."""
    paths = queries.tokenizer_path(), queries.tokenizer_path("byte_bpe_50k.tiktoken")
    texts = [*sentences(23, 40), "  A b\u00e9\t\U0001f600 <|endoftext|>\n\n", "", None, "x" * 300]
    docs = documents(spark, texts).select(F.col("doc_id").alias("id"), "text")
    kept = lm.coded_texts(docs, *paths, 10**4, 8, 3).where(F.col("kind") == lm.TEXT).toArrow()
    code = lm.subwords(*paths)
    ids, cuts = lm.from_raw(kept["ids"].to_pylist(), len(code.strings))
    back, ends = code.texts_of(ids, cuts)
    got = {i: back[a:b].tobytes().decode() for i, a, b in zip(kept["id"].to_pylist(), ends[:-1], ends[1:], strict=True)}
    assert got == {i: t or "" for i, t in enumerate(texts)}
    assert [x is None for x in kept["slot"].to_pylist()] == lm.held_out(kept["id"]).tolist()


def test_lm_encodes_the_pieces_of_a_batch_in_few_calls(monkeypatch):
    """Pieces go to the library together, and the ids are those of each text by itself."""
    code = lm.Subwords(queries.tokenizer_path(), queries.tokenizer_path("byte_bpe_50k.tiktoken"))
    alone, calls = code.library, []
    monkeypatch.setattr(code, "library", lambda t: calls.append(t) or alone(t))
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab Z'st  \t\n1.\u00e9 \u0301\u65e5\U0001f600 -", k=rng.randint(0, 60))) for _ in range(2000)] + ["", "  x", "x  ", " \u00e9 \u00e9"]
    ids, bounds = code.encode_all(*kernel.text_bytes(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [alone(t) for t in texts]
    calls.clear()
    code.encode_all(*kernel.text_bytes(pa.array([f"the {i} words of {rng.random()} texts" for i in range(500)])))
    assert len(calls) < 20


def test_lm_sends_each_chunks_words_when_it_encodes(spark):
    """The first pass sends the distinct words of every text with their counts in training texts, so that no second one looks for them."""
    paths = queries.tokenizer_path(), queries.tokenizer_path("byte_bpe_50k.tiktoken")
    docs = documents(spark, [*sentences(29, 60), None, "Same same SAME words"]).select(F.col("doc_id").alias("id"), "text").repartition(3)
    texts = docs.toArrow()
    for size in (40, 10**6):
        rows = lm.coded_texts(docs, *paths, 10**4, 8, size).toArrow()
        words, kept = (rows.filter(pa.array(rows["kind"].to_numpy() == k)) for k in (lm.WORDS, lm.TEXT))
        of = dict(zip(kept["id"].to_pylist(), kept["chunk"].to_pylist(), strict=True))
        want = Counter()
        for i, t in zip(texts["id"].to_pylist(), texts["text"].to_pylist(), strict=True):
            found = kernel.words_of(pa.array([(t or "").lower()]))
            for h in found.hashes().tolist():
                want[of[i], h] += not lm.held_out(pa.array([i]))[0]
        got = {}
        for r in words.to_pylist():
            low, _ = lm.from_low_bytes(pa.chunked_array([pa.array([r["ids"]], pa.binary())]), 8)
            for h, n in zip(low.tolist(), lm.unpack_counts(r["sums"]).tolist(), strict=True):
                got[r["chunk"], h | r["block"] << 56] = n
        assert got == dict(want)
        assert (len(set(of.values())) > 10) == (size == 40)
    known = {h for (_, h), n in want.items() if n}
    assert lm.kinds_of_words(lm.coded_texts(docs, *paths, 10**4, 8), 8) == len(known)


@pytest.mark.parametrize("size", [1.0, 30.0, 200.0])
def test_lm_exponentials_of_any_size(size):
    x = np.random.default_rng(5).normal(0, size, (500, 33)).astype(np.float32)
    x[3] -= np.float32(500)
    x[:, 7] = lm.NOTHING
    wide = x.astype(np.float64)
    top = wide.max(1, keepdims=True)
    logs = top + np.log(np.exp(wide - top).sum(1, keepdims=True))
    assert np.allclose(lm.exponentials(x)[2], logs[:, 0], rtol=1e-5, atol=1e-4)
    lm.softmax(x)
    assert np.allclose(x, np.exp(wide - logs), rtol=1e-3, atol=1e-6)


def test_lm_beats_unigrams_and_bigrams_on_held_out_texts(spark):
    paths = queries.tokenizer_path(), queries.tokenizer_path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    table = docs.toArrow()
    code = lm.subwords(*paths)
    held = lm.held_out(table["id"])
    (ids, bounds), (asked, cuts) = (code.encode_all(*kernel.text_bytes(table.filter(pa.array(x))["text"])) for x in (~held, held))
    total = int(sum(len((t or "").encode()) for t in table["text"].to_pylist()))
    learnt = lm.train(docs, *paths, total, 8)
    own = lm.Scorer(learnt.params, learnt.vocabulary).score(asked, cuts).sum()
    # both with the end of a text as one more id
    n = len(code.strings)
    with_ends = lambda x, c: np.insert(np.append(x, n) if len(c) > 1 else x, c[1:-1], n)
    line, test = np.append(n, with_ends(ids, bounds)), np.append(n, with_ends(asked, cuts))
    one = (np.bincount(line[1:], minlength=n + 1) + 1) / (len(line) + n)
    unigram = np.log10(one[test[1:]]).sum()
    pairs = Counter(zip(line[:-1].tolist(), line[1:].tolist(), strict=True))
    first = np.bincount(line[:-1], minlength=n + 1)
    # a bigram over the same ids, smoothed towards the unigram by the weight that serves it best
    seen = np.array([pairs[a, b] for a, b in zip(test[:-1].tolist(), test[1:].tolist(), strict=True)])
    bigram = max(np.log10((seen + w * one[test[1:]]) / (first[test[:-1]] + w)).sum() for w in (10, 50, 200, 1000))
    assert own > bigram > unigram, (own, bigram, unigram)


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(5)
    clean = [t for t in sentences(11, 400, 0) if t.strip()]
    texts = [t if i % 4 else t + " " + rng.choice(["badword", "Uglyword!", "evilstem" + rng.choice("abcdef") * 2]) for i, t in enumerate(clean)]
    docs = documents(spark, [*texts, *EDGE])
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, len(texts) // 2)] + [(None, 1, 1), (10**6, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert len(got) == len(texts) + len(EDGE)
    held = range(len(texts) // 2, len(texts))
    wrong = [i for i in held if got[i]["is_toxic"] != (i % 4 == 0)]
    assert len(wrong) <= 0.02 * len(held), wrong
    assert not any(got[len(texts) + i]["is_toxic"] for i in range(len(EDGE)))
    assert toxicity.score(documents(spark, []), labels).count() == 0
    assert {r["p_toxic"] < 1e-6 for r in toxicity.score(docs, labels.limit(0)).collect()} == {True}
    # repeated rows are scored each and alike; of an id with several texts the smallest is trained on, whatever the order
    twice = documents(spark, [*texts, texts[0], "zzz " + texts[4]], [*range(len(texts)), 0, 4])
    again = toxicity.score(twice.repartition(5), labels).collect()
    assert len(again) == len(texts) + 2
    by = {}
    for r in again:
        by.setdefault(r["doc_id"], []).append(r["p_toxic"])
    assert len(by[0]) == 2 and by[0][0] == by[0][1] and all(abs(by[i][0] - got[i]["p_toxic"]) < 1e-9 for i in range(5, 60))
    # the sample is bounded by bytes too
    small = toxicity.learn(docs, labels, sample_bytes=1)
    assert [len(h) for h in small.hashes] == [0, 0]


def test_the_chain_equals_a_plain_one():
    """Features, folds and weights against a chain written out document by document."""
    rng = np.random.default_rng(8)
    docs, kinds = 240, 40
    holds = rng.random((docs, kinds)) < 0.3
    names = np.sort(rng.integers(1, 1 << 62, kinds).astype(np.uint64))
    first = (holds[:, 0] | holds[:, 1]).astype(int)
    second = ((first == 1) & holds[:, 2] | holds[:, 3]).astype(int)
    labels = np.stack([first, second], axis=1)
    doc, which = np.nonzero(holds)
    chain = toxicity.train(doc, names[which], labels, ["one", "two"])

    def best_of(use, y):
        told = []
        for f in range(kinds):
            a, b = sum(holds[use, f] & (y[use] == 1)), sum(holds[use, f] & (y[use] == 0))
            c, d = sum(~holds[use, f] & (y[use] == 1)), sum(~holds[use, f] & (y[use] == 0))
            n = a + b + c + d
            chi = n * (a * d - b * c) ** 2 / max((a + b) * (n - a - b) * (a + c) * (n - a - c), 1)
            if chi >= toxicity.TELLING and a + b >= toxicity.LEAST:
                told.append(f)
        return told

    fold = np.random.default_rng(1).permutation(docs) % toxicity.FOLDS
    before = np.zeros((docs, 0))
    for c in range(2):
        y = labels[:, c]
        out = np.zeros((docs, 1))
        for f in range(toxicity.FOLDS):
            use = fold != f
            x = np.hstack([holds[:, best_of(use, y)].astype(float), before])
            w = toxicity.fit(x[use].astype(np.float32), y[use].astype(float))
            out[~use, 0] = 1 / (1 + np.exp(-(x[~use] @ w[:-1] + w[-1])))
        every = best_of(np.ones(docs, bool), y)
        assert chain.hashes[c].tolist() == names[every].tolist()
        w = toxicity.fit(np.hstack([holds[:, every].astype(float), before]).astype(np.float32), y.astype(float))
        assert np.allclose(chain.weights[c], w, atol=1e-4)
        before = np.hstack([before, out])
    # the second model leans on what the first one says
    assert chain.weights[1][len(chain.hashes[1])] != 0
