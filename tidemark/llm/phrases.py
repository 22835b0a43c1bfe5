"""Phrases of words that belong together, mined from suffix arrays.

Texts are dealt into chunks.  A chunk numbers its words, sorts the places of its words by the next LONGEST of them with
prefix doubling (one word, two, four), and reads n-grams and their counts off the intervals of common
prefixes.  Counts are merged by key in two rounds.  First each chunk sends a short print and a bounded count of
each of its n-grams to the print's bucket, which answers one bit an entry: can the n-gram reach the least count in
all?  Those n-grams alone are then sent as words and merged exactly; a print that two n-grams share costs a
row, never a result.  Cuts, containment and ranks are joins and windows over the n-grams that are frequent.

Texts are lower-cased (A-Z), cut at `[.,;:!?\\x0A-\\x0D]` into pieces, and those into words `[^\\x20\\x09]+`.  Everything is per
language; a null one is `und`.  Null and empty texts have no words.  Repeated rows count as often as they come: rows are
dealt by their place, so that copies spread over the chunks.  A long text is in one chunk, whole.  Other columns are not read, so none
can clash; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, stored
from .kernel import SPACE, byte_hashes, distinct_strings, mix, release, scan, text_bytes

#: Text bytes of a chunk: at most CHUNK, less for small inputs, so that there are some tasks.
CHUNK, LEAST_CHUNK, SOME_CHUNKS = 6 << 20, 1 << 18, 64
#: N-grams of a bucket, about; bytes of text an n-gram, about. Buckets are a power of two.
BUCKET, GRAM_BYTES, MOST_BITS = 1 << 19, 2, 31
#: Bytes of a print besides its bucket's bits.
WIDTH = 4
LONGEST = 4
UNKNOWN = "und"
#: Languages' candidates are ranked in so many parts before they are ranked together.
SALTS = 256
_U = np.uint64
_STEPS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
INSIDE = ~(SPACE | SEPARATOR)


def dense(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones, from their order."""
    out = np.empty(len(keys), np.int64)
    ordered = keys[order]
    out[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])[: len(keys)])
    return out


class Chunk:
    """A chunk's n-grams: length, first place and count of each, by length and then in the order of the suffix array."""

    def __init__(self, table: pa.Table) -> None:
        data, offsets = text_bytes(table["text"])
        data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data).astype(np.uint8)
        words = scan(data, offsets, INSIDE)
        coded = table["lang"].combine_chunks().dictionary_encode()
        self.langs = coded.dictionary
        self.lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.doc]
        self.per_lang = np.bincount(self.lang, minlength=len(self.langs))
        strings, self.word = distinct_strings(data, words.start, words.end)
        self.word = self.word.astype(np.int64)
        self.strings = pa.array(strings, pa.large_binary()).cast(pa.large_string())
        piece = np.cumsum(SEPARATOR[data], dtype=np.int32)[words.start] if len(words.start) else np.zeros(0, np.int32)
        n = len(self.word)
        # words from here to the end of the piece, LONGEST at most
        more = np.zeros(n, bool)
        more[:-1] = (piece[1:] == piece[:-1]) & (words.doc[1:] == words.doc[:-1])
        left = np.ones(n, np.int64)
        for _ in range(LONGEST - 1):
            left[:-1] = np.where(more[:-1], np.minimum(left[1:] + 1, LONGEST), 1)
        kinds = len(strings) + 1
        one = self.lang * kinds + self.word + 1
        two = one * kinds + np.where(left > 1, self.later(1, self.word + 1), 0)
        two = dense(two, np.argsort(two))
        four = two * (int(two.max(initial=0)) + 2) + np.where(left > 2, self.later(2, two + 1), 0)
        order = np.argsort(four)  # the suffix array
        a, b = order[:-1], order[1:]
        far = np.minimum(left[a], left[b])
        third = self.later(2, self.word + 1)
        same = [one[a] == one[b], (two[a] == two[b]) & (far > 1)]
        same += [same[1] & (far > 2) & (third[a] == third[b]), (four[a] == four[b]) & (far > 3)]
        # hashes of the words' bytes, so that all chunks agree; word by word over all places
        far = mix(byte_hashes(*_joined(self.langs)) + _STEPS[0])[self.lang]
        word = byte_hashes(*_joined(self.strings))[self.word]
        lengths, places, counts, hashes = [], [], [], []
        for size in range(1, LONGEST + 1):
            far = mix(far ^ (word * _STEPS[size - 1]))
            word = self.later(1, word)
            new = np.concatenate([[True], ~same[size - 1]])[:n]
            long = np.flatnonzero(left[order] >= size)
            starts = np.flatnonzero(new[long])
            places.append(order[long[starts]])
            counts.append(np.diff(np.append(starts, len(long))))
            lengths.append(np.full(len(starts), size, np.int8))
            hashes.append(mix(far[places[-1]] + _U(size)))
        self.length, self.place, self.count, self.hash = map(np.concatenate, (lengths, places, counts, hashes))

    def later(self, steps: int, values: np.ndarray) -> np.ndarray:
        return np.concatenate([values[steps:], np.zeros(min(steps, len(values)), values.dtype)])

    def phrases(self, which: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """(lang, phrase) of these n-grams, which must be of one length."""
        size = int(self.length[which[0]])
        place = self.place[which]
        each = [self.strings.take(pa.array(self.word[place + j])) for j in range(size)]
        told = each[0] if size == 1 else pc.binary_join_element_wise(*each, pa.scalar(" ", pa.large_string()))
        return self.langs.take(pa.array(self.lang[place])), told.cast(pa.string())


def _joined(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, bounds = text_bytes(strings)
    return data, bounds[:-1], bounds[1:]


def _cuts(hashes: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of ascending hashes."""
    bucket = (hashes >> _U(64 - bits)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    return [(int(bucket[a]), a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]


def _kind(least: int) -> np.dtype:
    return np.dtype(next(k for k, most in (("u1", 255), ("<u2", 65535), ("<u8", 1 << 62)) if least <= most))


def send_prints(least: int, bits: int):
    """Of a chunk -> (bucket, chunk, prints, counts up to `least`)."""

    def run(table: pa.Table) -> pa.Table:
        c = Chunk(table)
        order = np.argsort(c.hash)
        hashes = c.hash[order]
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
        counts = np.minimum(np.add.reduceat(c.count[order], starts), least).astype(_kind(least)) if len(starts) else np.zeros(0, _kind(least))
        hashes = hashes[starts]
        low = ((hashes << _U(bits)) >> _U(64 - 8 * WIDTH)).astype(f"<u{WIDTH}")
        blocks, chunk = _cuts(hashes, bits), table["chunk"][0].as_py()
        del c
        release()
        return pa.table({"bucket": pa.array([n for n, _, _ in blocks], pa.int64()), "chunk": pa.array([chunk] * len(blocks), pa.int64()), "prints": pa.array([low[a:b].tobytes() for _, a, b in blocks], pa.binary()), "counts": pa.array([counts[a:b].tobytes() for _, a, b in blocks], pa.binary())})

    return run


def answer_prints(least: int):
    """The prints of a bucket, all chunks' -> of each chunk, which have `least` together."""

    def run(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x.as_buffer(), f"<u{WIDTH}") for x in table["prints"]]
        ends = np.cumsum([len(x) for x in rows])
        found = np.concatenate(rows)
        counts = np.concatenate([np.frombuffer(x.as_buffer(), _kind(least)) for x in table["counts"]])
        order = np.argsort(found)
        ordered = found[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        enough = np.add.reduceat(counts[order], starts, dtype=np.int64) >= least
        bit = np.empty(len(found), bool)
        bit[order] = np.repeat(enough, np.diff(np.append(starts, len(found))))
        out = [(c, np.packbits(x).tobytes()) for c, x in zip(table["chunk"].to_pylist(), np.split(bit, ends[:-1]), strict=True) if x.any()]
        bucket = table["bucket"][0].as_py()
        release()
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "bucket": pa.array([bucket] * len(out), pa.int64()), "bits": pa.array([x[1] for x in out], pa.binary())})

    return run


GRAMS = "lang string, phrase string, size int, n long"


def send_phrases(bits: int):
    """A chunk and the answers to it -> (lang, phrase, size, n) of its n-grams that may be frequent, and of size 0 the number of words of each language."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "size": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
        c = Chunk(texts)
        order = np.argsort(c.hash)
        hashes = c.hash[order]
        new = np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)]
        hashes = hashes[new]
        told = dict(zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist(), strict=True))
        keep = np.zeros(len(hashes), bool)
        for n, a, b in _cuts(hashes, bits):
            if n in told:
                keep[a:b] = np.unpackbits(np.frombuffer(told[n], np.uint8), count=b - a).astype(bool)
        which = np.sort(order[keep[np.cumsum(new) - 1]])
        out = [pa.table({"lang": c.langs, "phrase": pa.nulls(len(c.langs), pa.string()), "size": pa.array([0] * len(c.langs), pa.int32()), "n": pa.array(c.per_lang)})]
        for size in range(1, LONGEST + 1):
            own = which[c.length[which] == size]
            if len(own):
                lang, phrase = c.phrases(own)
                out.append(pa.table({"lang": lang, "phrase": phrase, "size": pa.array(np.full(len(own), size), pa.int32()), "n": pa.array(c.count[own])}))
        del c, hashes, order
        release()
        return pa.concat_tables(out)

    return run


def frequent_phrases(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, phrase, size, n: all phrases of up to LONGEST words that occur `least` times in texts of a language; and of size 0, without a phrase, how many words it has."""
    total = docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    size = min(CHUNK, max(LEAST_CHUNK, total // SOME_CHUNKS))
    bits = min(MOST_BITS, max(8, (total // GRAM_BYTES // BUCKET).bit_length()))
    chunk = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, -(-total // size))))
    texts = docs.select(F.coalesce(docs[lang].cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(docs[text], F.lit("")).alias("text")).withColumn("chunk", chunk)
    chunked = texts.groupBy("chunk")
    sent = chunked.applyInArrow(send_prints(least, bits), "bucket long, chunk long, prints binary, counts binary")
    answers = sent.groupBy("bucket").applyInArrow(answer_prints(least), "chunk long, bucket long, bits binary")
    found = chunked.cogroup(answers.groupBy("chunk")).applyInArrow(send_phrases(bits), GRAMS)
    return found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where((F.col("size") == 0) | (F.col("n") >= least))


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, covered: int = 80, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `most` phrases of 2 to LONGEST words of each language by score, then a, then phrase.

    a, l, r: how often the phrase occurs, and the two parts of its lowest-scoring cut; score floor(2,000,000 a / (l + r)); n the
    words of the language.  A phrase is left out if a longer candidate that holds its words occurs in `covered` per cent of its places.
    """
    all_ = stored(frequent_phrases(docs, least, text, lang), "phrases")
    grams = all_.where("size > 0").select("lang", "phrase", "size", "n")
    words = all_.where("size = 0").select("lang", F.col("n").alias("n_words"))
    longer = grams.where("size > 1").withColumn("w", F.split("phrase", " "))
    # every cut, with its two parts
    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = longer.withColumn("k", k).select("lang", "phrase", "size", F.col("n").alias("a"), "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    count = lambda name, of: grams.select("lang", F.col("phrase").alias(name), F.col("n").alias(of))
    cuts = cuts.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr("2000000BD * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    # what lies within a longer candidate, and how often the most frequent of these occurs
    spans = [(a, m) for m in range(2, LONGEST) for a in range(1, LONGEST - m + 2)]
    inside = F.explode(F.array_distinct(F.filter(F.array(*[F.when(F.col("size") >= a + m - 1, F.when(F.col("size") > m, part(F.lit(a), F.lit(m)))) for a, m in spans]), lambda x: x.isNotNull())))
    held = longer.where("size > 2").select("lang", inside.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    kept = scored.join(held, ["lang", "phrase"], "left").where(F.col("most").isNull() | (wide("most") * 100 < wide("a") * covered))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(min(SALTS, parts(docs.sparkSession)))))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("n_words").alias("n"), "score")


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
q AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(ps) AS x FROM p)),
t AS (SELECT lang, w, generate_subscripts(w, 1) AS i FROM q WHERE len(w) > 0),
c AS (SELECT lang, count(*) AS n FROM t GROUP BY lang),
g AS MATERIALIZED (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f FROM t, (VALUES (1), (2), (3), (4)) s(size) WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30),
d AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS w FROM g WHERE size > 1),
k AS MATERIALIZED (SELECT lang, phrase, f, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:size], ' ') AS y FROM d, (VALUES (1), (2), (3)) s(k) WHERE k < size),
s AS (SELECT k.lang, k.phrase, k.f AS a, k.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * k.f) // (x.f + y.f))::BIGINT AS score FROM k JOIN g x ON x.lang = k.lang AND x.phrase = k.x JOIN g y ON y.lang = k.lang AND y.phrase = k.y),
m AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS t FROM s),
h AS (SELECT d.lang, array_to_string(d.w[a:a + m - 1], ' ') AS phrase, max(f) AS most FROM d, (VALUES (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)) v(a, m) WHERE a + m - 1 <= size AND m < size GROUP BY ALL),
e AS (SELECT m.lang, m.phrase, m.a, m.l, m.r, m.score FROM m LEFT JOIN h ON h.lang = m.lang AND h.phrase = m.phrase WHERE t = 1 AND (most IS NULL OR 100 * most < 80 * a)),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e)
SELECT z.lang, rank::INT AS rank, phrase, a, l, r, n, score FROM z JOIN c USING (lang) WHERE rank <= 2000
"""
