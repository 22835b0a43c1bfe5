from collections import Counter

import corpus_pipeline
from tidemark.llm import bpe, jaccard, mixing, quality, queries
from tidemark.llm.common import stored, table

from .test_text_operators import DOCS, base_of, sentences, shingles, spans_of

DATA = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, DATA, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], DATA), f"test-{name}"))
        if name != "encoding":
            assert seen[-1].columns == docs.columns
    rows = [{r["doc_id"]: r for r in x.collect()} for x in seen[:4]]
    good = {r["doc_id"] for r in quality.judge_quality(docs, table(spark, DATA, "labels")).where("kept").collect()}
    assert set(rows[1]) == good and 0 < len(good) < len(rows[0])
    # of every two near duplicates at most one stays, and nothing else goes
    sets = {i: shingles(r["text"]) for i, r in rows[1].items()}
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    kept = sorted(rows[2])
    assert not any(near(a, b) for i, a in enumerate(kept) for b in kept[:i])
    classes = {r["doc_id"]: r["class_id"] for r in jaccard.near_duplicates(seen[1]).collect()}
    assert set(kept) == set(classes.values())
    assert set(rows[3]) == set(rows[2]) and not any(spans_of(r["text"]) for r in rows[3].values())
    assert all(rows[3][i]["text"] == rows[2][i]["text"] for i in rows[2] if not spans_of(rows[2][i]["text"]) and "[SECRET]" not in rows[3][i]["text"])
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_documents(seen[3]).where("copies > 0").collect()}
    assert Counter(r["doc_id"] for r in seen[4].collect()) == copies and max(copies.values()) <= 2
    coder = bpe.coder(queries.tokenizer_path())
    for r in seen[5].collect():
        assert coder.decode(r["ids"]) == rows[3][r["doc_id"]]["text"] and r["n_tokens"] == len(r["ids"])
    assert seen[5].count() == seen[4].count()


def test_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "encoding"]
    found = queries.queries()
    assert [n.split("_")[0] for n in found] == [f"op{i}" for i in range(1, 14)] and set(queries.oracle_sql()) <= set(found)
    assert list(corpus_pipeline.queries()) == ["pipeline"]


def test_edges_of_the_whole_run(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows and ids, clashing columns, empty tables."""
    good = [t for t in sentences(41, 60, 0) if len(t.split()) > 60 and not base_of(t)[5]]
    long = " ".join(f"{w}{i}" for i, w in enumerate(" ".join(good).split() * 8))
    rows = [(i, t, "en", f"src{i % 3}", len(t), 1, "c", "k", 9, 2) for i, t in enumerate(good)]
    secret = good[0] + " password = hunter2hunter2"
    rows += [(900, secret, None, None, None, None, None, None, None, None), (901, None, "en", "src1", None, 1, "c", "k", 9, 2), (902, "", "en", "src1", 0, 1, "c", "k", 9, 2)]
    rows += [rows[1], (1, good[2], "fr", "src0", 5, 1, "c", "k", 9, 2), (None, good[3] + " tail", "en", "src2", 3, 1, "c", "k", 9, 2), (903, long, "en", "src2", len(long), 1, "c", "k", 9, 2)]
    folder = str(tmp_path / "data")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, len(good), 2)] + [(None, 1, 1), (3, None, None), (5, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    out = corpus_pipeline.run(spark, folder).collect()
    coder = bpe.coder(queries.tokenizer_path())
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], set()).add(coder.decode(r["ids"]))
    assert by and not {901, 902} & set(by)
    texts = {t for each in by.values() for t in each}
    assert not any(spans_of(t) for t in texts) and {len(t) for t in by.get(903, {long})} == {len(long)}
    known = {t for _, t, *_ in rows if t}
    assert all(t in known or "[SECRET]" in t for t in texts)
    # of near duplicates with an id at most one stays
    sets = [(i, shingles(t)) for i, each in by.items() if i is not None for t in each]
    assert not any(a < b and len(x & y) >= 0.8 * len(x | y) for a, x in sets for b, y in sets if x and y and (a, b) != (1, 1))
    none = str(tmp_path / "none")
    spark.createDataFrame([], DOCS).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0
