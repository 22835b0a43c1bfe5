"""Commits of several tables, lists of gone rows, the index, compaction, and syncs that fail on the way."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.model import Column, EntityConfig, TableSchema
from tidemark.operators import integrity
from tidemark.operators.optionsets import SUFFIX
from tidemark.plans import workflow
from tidemark.sources import store as storage
from tidemark.sources.catalog import store_schemas
from tidemark.sources.store import Conflict, Store

from .test_workflow import raw

KIND = "k string, valid_from string, valid_to string"


def told(df):
    return sorted(map(repr, df.collect()))


def made(spark, *rows):
    return spark.createDataFrame(rows, KIND)


def test_tables_of_a_transaction_change_together(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.write("a", spark.range(1))
    one, other = store.transaction(), store.transaction()
    one.commit("a", append={"all": spark.range(1, 2)})
    one.commit("b", {"all": spark.range(5)})
    one.commit("b", append={"all": spark.range(5, 6)}, note="n")
    assert store.tables() == ["a"] and store.read("a").count() == 1  # nothing is seen yet
    other.commit("c", {"all": spark.range(2)})
    other.publish()  # a writer of another table is no conflict
    one.publish()
    assert store.tables() == ["a", "b", "c"] and [store.read(t).count() for t in "abc"] == [2, 6, 2] and store.note("b") == "n"
    late = store.transaction()
    late.commit("b", {"all": spark.range(1)}, base=store.number("b"))
    late.commit("d", {"all": spark.range(1)})
    store.commit("b", append={"all": spark.range(1)})
    with pytest.raises(Conflict):
        late.publish()
    assert not store.exists("d") and store.read("b").count() == 7


def test_staged_changes_follow_what_others_wrote(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.write("sum", spark.range(1))
    tx = store.transaction()
    tx.stage("sum", lambda: tx.commit("sum", {"all": store.read("sum").union(spark.range(7, 8))}, base=store.number("sum")))
    store.commit("sum", append={"all": spark.range(1, 2)})
    tx.publish()
    assert sorted(r[0] for r in store.read("sum").collect()) == [0, 1, 7]


def test_dropped_rows_and_compaction_in_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "BUCKET_ROWS", 20)
    store = Store(spark, str(tmp_path / "store"))
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("2024").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))
    store.commit("t", {"open": rows.repartition(3)}, key="k")
    for n in range(4):
        out = store.read("t", "open", places=True).where(f"k % 6 = {n}")
        store.commit("t", append={"closed": out.drop(*storage.WHERE).withColumn("valid_to", F.lit("2025"))}, drop={"open": out})
    left = {str(i) for i in range(200) if i % 6 > 3}
    same = lambda: {r["k"] for r in store.read("t", "open").collect()} == left and store.read("t", "closed").count() == 134
    assert same() and not store.compact("t", "closed") and store.compact("t", "open") and same()
    open_ = store.state("t").of_part("open")
    assert len(open_) == open_[0].of == 4 and not store.state("t").of_part("open", gone=True)
    assert [r["k"] for r in store.read("t", "open", key="5").collect()] == ["5"] and len(store.folders("t", "open", key="5")) == 1
    keys = spark.createDataFrame([("5",), ("11",), ("6",)], "id string")
    assert {r["k"] for r in store.read("t", "open", keys=keys).collect()} == {"5", "11"}
    # rows go from buckets, too; lists of gone rows are joined
    for k in ("5", "11", "4", "10", "16", "22"):
        store.commit("t", drop={"open": store.read("t", "open", key=k, places=True)})
        left.remove(k)
    assert same() and store.compact("t", "open", most=1) and len(store.state("t").of_part("open", gone=True)) == 1 and same()
    assert store.vacuum("t", older=-1) > 0 and same()


def test_only_folders_that_can_match_are_opened(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    tx = store.transaction()
    day = lambda n: f"2024-{n // 28 + 1:02}-{n % 28 + 1:02}"
    for n in range(100):  # keys of all folders interleave, so bounds alone tell nothing of them
        tx.commit("t", append={"closed": made(spark, *((f"{j:04}", day(n), day(n + 1)) for j in range(n, 2000, 97)))}, key="k")
    tx.commit("t", append={"open": made(spark, *((f"{j:04}", day(101), None) for j in range(100)))}, key="k")
    tx.publish()
    plain = spark.read.schema(KIND).parquet(*[f"{store.root}/t/{f.name}" for f in store.state("t").folders])
    opened = lambda df: len({os.path.dirname(f) for f in df.inputFiles()})
    assert opened(store.read("t")) == 101
    history = store.read("t", key="0050")
    assert told(history) == told(plain.where("k = '0050'")) and opened(history) <= 4  # of which two hold it
    then = store.read("t", at=day(40))
    assert told(then) == told(plain.where(f"valid_from <= '{day(40)}' and (valid_to is null or valid_to > '{day(40)}')")) and opened(then) == 1
    now = store.read("t", key="0050", is_open=True)
    assert told(now) == told(plain.where("k = '0050' and valid_to is null")) and opened(now) == 1
    assert store.read("t", key="none").count() == 0 and store.folders("t", since=store.number("t")) == []


DAY = {1: "2024-01-01", 2: "2024-02-01"}
SHIPS = EntityConfig("ship", "ships")
SCHEMA = TableSchema("ship", [Column("shipid", "TEXT", "Edm.Guid", False), Column("title", "TEXT", "Edm.String"), Column("loads", "TEXT", "Edm.String"), Column("flag", "INTEGER", "Edm.Int32"), Column("modifiedon", "TEXT", "Edm.DateTimeOffset")], "shipid")


@pytest.fixture
def one_partition(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def ships(spark, day, ids, loads, flag):
    return raw(spark, *({"shipid": f"s{i}", "title": f"{day}", "loads": loads, f"loads{SUFFIX}": loads.translate(str.maketrans("123,", "ABC;")), "flag": flag, f"flag{SUFFIX}": f"F{flag}", "modifiedon": DAY[day]} for i in ids))


def sync(store, records, day):
    begun, runs = workflow._begin(store, [SHIPS])
    return workflow._sync_one(store, SHIPS, runs["ships"], begun, lambda tx: workflow.load_batch(store, SHIPS, SCHEMA, records, DAY[day], mode="fixed", into=tx))


def whole(store):
    """All tables but the log, and the state without its times."""
    out = {t: told(store.read(t)) for t in store.tables() if t not in (workflow.LOG, workflow.STATE)}
    return out | {"_blank": told(store.read("_junction_ships_loads", "_blank")), "state": told(store.read(workflow.STATE).drop("last_sync_time")), "next": store.note("ships")}


def test_a_batch_that_fails_at_any_step_leaves_nothing_behind(spark, tmp_path, monkeypatch, one_partition):
    first = Store(spark, str(tmp_path / "first"))
    sync(first, ships(spark, 1, range(6), "1,2", 1), 1)
    second = ships(spark, 2, range(3, 9), "2,3", 2)
    shutil.copytree(first.root, tmp_path / "calm")
    calm = Store(spark, str(tmp_path / "calm"))
    sync(calm, second, 2)
    want, put, publish = whole(calm), Store._put, Store._publish
    assert len(want["ships"]) == 12 and len(want["_junction_ships_loads"]) == 24
    steps, own = 0, ("ships", "_optionset", "_junction_ships_loads")
    while True:
        count = [0]

        def breaks(f):
            def one(self, first_arg, *rest, **named):
                count[0] += 1
                if count[0] == steps + 3:  # the two first writes mark the begin
                    raise OSError("the disk is full")
                return f(self, first_arg, *rest, **named)

            return one

        root = str(tmp_path / f"broken{steps}")
        shutil.copytree(first.root, root)
        store = Store(spark, root)
        with monkeypatch.context() as m:
            m.setattr(Store, "_put", breaks(put))
            m.setattr(Store, "_publish", breaks(publish))
            try:
                sync(store, second, 2)
                failed = False
            except OSError:
                failed = True
        if not failed:
            break
        if steps > 0:  # the batch is not there, in no table
            assert [store.number(t) for t in own] == [first.number(t) for t in own] and store.read(workflow.STATE).where("state = 'failed'").count() == 1
        sync(store, second, 2)
        assert whole(store) == want, steps
        steps += 3  # every third step: begun, written, staged and published
    assert steps >= 10 and whole(store) == want


def test_records_that_come_in_one_task_are_dealt_out(spark, tmp_path, monkeypatch):
    parts = []

    def counted(df):
        out = storage.checkpointed(df)
        if "raw" in out.columns:
            parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(workflow, "checkpointed", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sync(Store(spark, str(tmp_path / "store")), ships(spark, 1, range(200), "1,2", 1).coalesce(1), 1) == (200, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts == [4]


def test_a_few_changes_write_as_little_whatever_the_table_holds(spark, tmp_path):
    wrote = []
    for n in (200, 4000):
        store = Store(spark, str(tmp_path / f"s{n}"))
        sync(store, ships(spark, 1, range(n), "1,2", 1), 1)
        before = {f.name for t in store.tables() for f in store.state(t).folders}
        assert sync(store, ships(spark, 2, range(50), "3", 2), 2) == (0, 50)
        size = lambda t, f: sum(os.path.getsize(os.path.join(d, x)) for d, _, names in os.walk(f"{store.root}/{t}/{f.name}") for x in names)  # noqa: E731, B023
        wrote.append(sum(size(t, f) for t in store.tables() for f in store.state(t).folders if f.name not in before))
        assert store.read("ships").count() == n + 50 and store.read("ships", "open").count() == n
    assert wrote[1] < 1.3 * wrote[0]


def test_each_closure_round_reads_what_the_round_before_brought(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    edges, read = [("t", "ref", "u", "id")], {}
    row = lambda *refs: spark.createDataFrame([(r,) for r in refs], "ref string")
    store.write("t", row("a", "b", None))
    ids = lambda: (x := workflow.new_references(store, edges, "u", read)) and sorted(r[0] for r in x.collect())
    assert ids() == ["a", "b"] and ids() is None
    before = store.number("t")
    store.commit("t", append={"all": row("b", "c")})
    assert [f.rows for f in store.folders("t", since=before)] == [2] and ids() == ["b", "c"] and ids() is None


def test_declared_nullability_outlives_the_files(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.commit("ships", {"open": spark.createDataFrame([], storage.entity_schema(SCHEMA))}, key="shipid")
    sync(store, ships(spark, 1, range(2), "1", 1), 1)
    found = {c.name: c.nullable for c in store_schemas(store)["ships"].columns}
    assert not found["shipid"] and found["title"]


def test_references_followed_up_equal_the_full_check(spark, tmp_path, one_partition):
    rng, store = random.Random(4), Store(spark, str(tmp_path / "store"))
    edges = [("tasks", "owner", "people", "id"), ("tasks", "owner", "teams", "id"), ("people", "boss", "people", "id"), ("tasks", "place", "places", "code")]
    kinds = {"tasks": "row_id long, id string, owner string, place string", "people": "row_id long, id string, boss string", "teams": "row_id long, id string", "places": "row_id long, code long"}
    for t, kind in kinds.items():
        store.commit(t, {"open": spark.createDataFrame([], kind)}, note="1", key=kind.split(", ")[1].split()[0])
    pick = lambda p: rng.choice([None, *(f"{p}{i}" for i in range(12))])
    some = {"tasks": lambda i: (i, f"k{i}", rng.choice([pick("p"), pick("t")]), rng.choice([None, "1", "2", "30"])), "people": lambda i: (i, f"p{rng.randrange(12)}", pick("p")), "teams": lambda i: (i, f"t{rng.randrange(12)}"), "places": lambda i: (i, rng.choice([1, 2, 3]))}
    for batch in range(7):
        for t in rng.sample(sorted(some), rng.randrange(0, 4) if batch else 2):
            first = int(store.note(t))
            rows = [some[t](first + n) for n in range(rng.randrange(1, 5))]
            gone = store.read(t, "open", places=True).where(f"row_id % 3 = {batch % 3}")  # some close: they stay, as closed versions
            store.commit(t, append={"open": spark.createDataFrame(rows, kinds[t]), "closed": gone.drop(*storage.WHERE)}, drop={"open": gone}, note=str(first + len(rows)), base=store.number(t))
        got = workflow.verify_changes(store, edges)
        full, _, _ = integrity.report({t: store.read(t) for t in kinds}, edges)
        told_ = lambda rows: sorted((r["src_table"], r["fk_col"], sorted(r["dst_table"].split(",")), r["dangling_count"], r["total_checked"], r["samples"]) for r in rows)
        assert told_(got) == told_([r.asDict() for r in full.collect()]), batch
    assert told_(workflow.verify_changes(store, edges)) == told_(got)  # nothing new, nothing read
    assert told_(workflow.verify_changes(store, edges[:1])) != told_(got)
