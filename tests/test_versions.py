import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import canonical, closure, export, incremental, integrity, optionsets, scd2, state, temporal
from tidemark.sources.store import Store
from tidemark.streaming import feed

COLS = "k string, json_response string, sync_time string, valid_from string, seq long"


def sequential(active, batch):
    """The rule one record at a time: key -> versions."""
    rows = [dict(r) for r in active]
    added = updated = 0
    for k, j, t, v, _ in batch:
        if not k:
            continue
        now = next((r for r in rows if r["k"] == k and r["valid_to"] is None), None)
        if now is None:
            added += 1
        elif now["json_response"] == j:
            now["sync_time"] = t
            continue
        else:
            now["valid_to"] = v
            updated += 1
        rows.append({"k": k, "json_response": j, "sync_time": t, "valid_from": v, "valid_to": None})
    return rows, added, updated


@pytest.mark.parametrize("seed", range(4))
def test_apply_equals_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    history, opened = [], []
    for b in range(3):
        batch = [(rng.choice(["a", "b", "c", "", None, "d"]), rng.choice("xyz"), f"t{b}-{i:02}", f"2024-{rng.randint(1, 12):02}", i) for i in range(rng.randint(0, 15))]
        want, added, updated = sequential(opened, batch)
        active = spark.createDataFrame([(r["k"], r["json_response"], r["sync_time"], r["valid_from"]) for r in opened], COLS.rsplit(",", 1)[0])
        got = scd2.apply(active, spark.createDataFrame(batch, COLS), "k")
        rows = sorted(str(r) for r in got.select("k", "json_response", "sync_time", "valid_from", "valid_to").collect())
        assert rows == sorted(str(r) for r in spark.createDataFrame([tuple(r.values()) for r in want], "k string, json_response string, sync_time string, valid_from string, valid_to string").collect())
        assert tuple(scd2.counts(got).first()) == (added, updated)
        opened = [r for r in want if r["valid_to"] is None]
        history += want


def test_idempotent_and_row_ids(spark):
    batch = spark.createDataFrame([("a", "1", "t", "2024-01", 0), ("b", "2", "t", "2024-01", 1)], COLS)
    one = scd2.apply(batch.drop("seq").limit(0), batch, "k")
    again = scd2.apply(temporal.active(one).select("k", "json_response", "sync_time", "valid_from"), batch, "k")
    assert tuple(scd2.counts(again).first()) == (0, 0)
    ids = scd2.with_row_ids(spark.range(100).select(F.col("id").cast("string").alias("k")), 7, ["k"])
    assert sorted(r[0] for r in ids.select("row_id").collect()) == list(range(7, 107))


def test_strict_time(spark):
    batch = spark.createDataFrame([("a", "new", "t", "2024-02", 0), ("a", "old", "t", "2024-01", 1)], COLS)
    none = batch.drop("seq").limit(0)
    late = {r["json_response"]: r["valid_to"] for r in scd2.apply(none, batch, "k").collect()}
    assert late == {"new": "2024-01", "old": None}
    ordered = {r["json_response"]: r["valid_to"] for r in scd2.apply(none, batch, "k", strict_time=True).collect()}
    assert ordered == {"old": "2024-02", "new": None}


def test_a_late_record_before_the_open_version(spark):
    active = spark.createDataFrame([("a", "A", "t", "2024-02-01")], COLS.rsplit(",", 1)[0])
    late = spark.createDataFrame([("a", "B", "t", "2024-01-01", 0)], COLS)
    got = {r["json_response"]: (r["valid_from"], r["valid_to"], r["is_new_entity"]) for r in scd2.apply(active, late, "k", strict_time=True).collect()}
    assert got == {"B": ("2024-01-01", "2024-02-01", False), "A": ("2024-02-01", None, False)}


def in_time(events):
    """(key, payload, from, to) of a history whose records came in the order of time."""
    out = []
    for k in sorted({e[0] for e in events}):
        last = {}
        for _, p, t in sorted(e for e in events if e[0] == k):
            last[t] = p
        runs = [(t, p) for n, (t, p) in enumerate(sorted(last.items())) if n == 0 or sorted(last.items())[n - 1][1] != p]
        out += [(k, p, t, runs[n + 1][0] if n + 1 < len(runs) else None) for n, (t, p) in enumerate(runs)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_arrival_gives_one_history(spark, seed):
    rng = random.Random(seed)
    events = [(k, rng.choice("xy"), f"2024-{m:02}-{d:02}") for k in "abc" for m, d in rng.sample([(m, d) for m in range(1, 13) for d in (1, 15)], 9)]
    rng.shuffle(events)
    known = spark.createDataFrame([], COLS.rsplit(",", 1)[0])
    for n in range(0, len(events), 9):
        batch = spark.createDataFrame([(k, p, f"s{n}", t, i) for i, (k, p, t) in enumerate(events[n : n + 9])], COLS)
        got = scd2.splice(known, batch, "k")
        keys = {r["k"] for r in batch.collect()}
        rows = got.collect()
        rest = [tuple(r) for r in known.collect() if r["k"] not in keys]
        known = spark.createDataFrame(rest + [(r["k"], r["json_response"], r["sync_time"], r["valid_from"]) for r in rows], known.schema)
        assert sorted(((r["k"], r["json_response"], r["valid_from"], r["valid_to"]) for r in rows if r["is_version"]), key=str) == [e for e in in_time(events[: n + 9]) if e[0] in keys]
    again = scd2.splice(known, spark.createDataFrame([("a", "z", "s", known.where("k = 'a'").first()["valid_from"], 0)], COLS), "k")
    assert again.where("valid_to <= valid_from").count() == 0 and again.where("is_version and json_response = 'z'").count() == 1  # a correction takes its record's place


def test_scd1_nulls_what_the_batch_lacks(spark):
    target = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "k string, x int, y int")
    batch = spark.createDataFrame([("a", 5, 0), ("a", 6, 1), ("c", 7, 2)], "k string, x int, seq int")
    got = {r["k"]: (r["x"], r["y"], r["is_new"]) for r in scd2.upsert_scd1(target, batch, "k").collect()}
    assert got == {"a": (6, None, False), "b": (3, 4, False), "c": (7, None, True)}


def _integer(raw):
    if isinstance(raw, (dict, list)):
        raise TypeError
    return int(raw)


def detected(record):
    """The rule of coded fields, one record at a time."""
    out = {}
    for key, label in record.items():
        if not key.endswith(optionsets.SUFFIX) or label is None:
            continue
        raw = record.get(key.removesuffix(optionsets.SUFFIX))
        if raw is None:
            continue
        multi = ";" in label or (isinstance(raw, str) and "," in raw)
        try:
            if multi:
                tokens = [t.strip() for t in raw.split(",") if t.strip()] if isinstance(raw, str) else [raw]
                pairs = dict(zip([_integer(t) for t in tokens], [t.strip() for t in label.split(";") if t.strip()], strict=False))
            else:
                pairs = {_integer(raw): label}
        except (TypeError, ValueError):
            continue
        for code, text in pairs.items():
            out[key.removesuffix(optionsets.SUFFIX), code] = (text, multi)
    return out


def test_detection_equals_the_rule(spark):
    rng = random.Random(3)
    values = [1, 0, -3, 12.5, True, False, None, "1", " 12 ", "+5", "1_000", "12.5", "x", "", "1,2", "1, 2 ,,3", "2,2", {"a": 1}, [1], "7,", 2**53 + 1]
    labels = ["A", "A;B", "A; B ;;C", "", None, "é", ";", "  sp "]
    records = [{f"f{i}": rng.choice(values) for i in range(4)} for _ in range(300)]
    for r in records:
        r |= {f"{k}{optionsets.SUFFIX}": rng.choice(labels) for k in list(r) if rng.random() < 0.9}
    got = optionsets.detect(spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "seq long, raw string"))
    found = {(r["seq"], r["field"], r["code"]): (r["label"], r["is_multi"]) for r in got.collect()}
    assert found == {(i, *k): v for i, r in enumerate(records) for k, v in detected(r).items()}


def test_detection_of_some_fields_is_that_of_all_without_the_others(spark):
    label = optionsets.SUFFIX
    raws = [
        {"a": "1, 2\u00a0,,+3", f"a{label}": "x; y\u00a0;z", "b": 7, f"b{label}": "q", "c": "no"},
        {"a": "-4,1_0,-4", f"a{label}": "x;y;z", "b": 1.5, f"b{label}": "q"},
        {"a": None, f"a{label}": "x", "b": "12\n", f"b{label}": "q"},
        {"a": "9223372036854775807,9223372036854775808", f"a{label}": "x;y", "b": -999999999999999999, f"b{label}": "q"},
        {"a": "5", "b": True, f"b{label}": None}, {"a": [1], f"a{label}": "x"}, {f"a{label}": "x"}, {},
    ]
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(raws)], "seq long, raw string")
    told = lambda df: sorted(tuple(r) for r in df.collect())
    every = told(optionsets.detect(rows))
    assert told(optionsets.detect(rows, fields=("b", "a"))) == every and {r[1] for r in every} == {"a", "b"}
    assert told(optionsets.detect(rows, fields=("a",))) == [r for r in every if r[1] == "a"]
    assert [r[4] for r in every if r[1] == "a"] == [1, 2, 3, -4, 10] and [r[4] for r in every if r[1] == "b"] == [7, 1, 12, -999999999999999999]


def test_detection_reads_a_record_and_splits_a_value_once(spark):
    """A filter on the rows would be moved below the columns that it names and compute them again."""
    found = optionsets.detect(spark.createDataFrame([(1, "{}")], "seq long, raw string").repartition(2))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("rlike(_k") + plan.count("RLIKE(_k") <= 1 and plan.count("split(") == 2


def test_junction_modes(spark):
    versions = spark.createDataFrame([("a", 1, "2024-01"), ("a", 2, "2024-02"), ("a", 3, "2024-03")], "id string, seq int, valid_from string")
    picks = spark.createDataFrame([("a", 1, c, True) for c in (1, 2)] + [("a", 2, 2, False)], "id string, seq int, code long, is_multi boolean")
    rows = lambda mode: sorted((r["option_code"], r["valid_from"], r["valid_to"]) for r in optionsets.junction(versions, picks, "id", "f", mode).collect())
    assert rows("compat") == [(1, "2024-01", None), (2, "2024-01", None)]
    assert rows("fixed") == [(1, "2024-01", "2024-02"), (2, "2024-01", "2024-02"), (2, "2024-02", "2024-03")]


def test_junction_snapshots(spark):
    kind = "entity_id string, option_code long, valid_from string, valid_to string"
    rows = spark.createDataFrame([], kind)
    for day, codes in (("2024-01-01", [1, 2]), ("2024-02-01", [2, 3]), ("2024-03-01", [3, 4, 5])):
        rows = optionsets.snapshot(rows, spark.createDataFrame([("a1", c, day) for c in codes], "entity_id string, option_code long, valid_from string"))
    assert rows.count() == 7
    assert [r[0] for r in temporal.active_codes(rows, "a1").collect()] == [3, 4, 5]
    assert sorted(r["option_code"] for r in temporal.as_of(rows, "2024-02-15").collect()) == [2, 3]


def test_lookup_keeps_first_seen(spark):
    old = spark.createDataFrame([("f", 1, "Old", "t0")], "field string, code long, label string, first_seen string")
    seen = spark.createDataFrame([("f", 1, "New", "t1", 5), ("f", 2, "Two", "t1", 5)], "field string, code long, label string, seen_at string, seq long")
    assert sorted(tuple(r) for r in optionsets.merge_lookup(old, seen).select("code", "label", "first_seen").collect()) == [(1, "New", "t0"), (2, "Two", "t1")]


def test_split(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(2000)] + [(None,)], "id string")
    stored = spark.range(1500).select(F.col("id").cast("int").alias("k"))
    new, old = incremental.split_ids(ids, stored, "k")
    assert new.count() == 500 and old.count() == 1500
    new, old = incremental.split_ids(ids, stored, "k", has_watermark=False)
    assert new.count() == 2000 and old.count() == 0
    marks = incremental.watermark(spark.createDataFrame([("",), (None,), ("2024",)], "modifiedon string")).first()
    assert tuple(marks) == ("2024", 3)


def test_closure_with_a_cycle(spark):
    people = spark.createDataFrame([("p1", "p2"), ("p2", "p3"), ("p3", "p1"), ("p4", "p1")], "id string, boss string")
    start = spark.createDataFrame([("t1", "p1"), ("t2", None)], "id string, owner string")
    edges = [("tasks", "owner", "people", "id"), ("people", "boss", "people", "id")]
    found, done = closure.closure({"tasks": start}, {"people": (people, "id")}, edges)
    assert done and sorted(r["id"] for r in found["people"].collect()) == ["p1", "p2", "p3"]
    _, done = closure.closure({"tasks": start}, {"people": (people, "id")}, edges, rounds=2)
    assert not done
    out = export.closed_sample({"tasks": start, "people": people}, {"tasks": "id", "people": "id"}, edges, "tasks", 2, 1)
    assert out["people"].count() == 4 and "people ||--o{ tasks" in export.diagram(edges)


def test_integrity_over_all_versions(spark):
    diseases = spark.createDataFrame([("d1", "2024-02"), ("d1", None)], "id string, valid_to string")
    rows = spark.createDataFrame([("d1",), ("d9",), ("d9",), (None,)], "fk string")
    found, checks, missing = integrity.report({"c": rows, "d": diseases}, [("c", "fk", "d", "id"), ("c", "nope", "d", "id")])
    (r,) = found.collect()
    assert (r["dangling_count"], r["total_checked"], r["samples"]) == (2, 3, ["d9"]) and checks == 2 and missing == [("c", "nope", "d", "id")]
    assert "2 of 3" in integrity.report_text([r], checks)
    none, _, _ = integrity.report({"c": rows.where("fk = 'd1'"), "d": diseases}, [("c", "fk", "d", "id")])
    assert none.isEmpty()


def test_state(spark):
    now = state.set_state(state.empty_state(spark), spark.createDataFrame([("a", "in_progress", "t1", None, None)], state.STATE))
    now = state.set_state(now, spark.createDataFrame([("a", "completed", "t2", "w", 3)], state.STATE))
    now = state.set_state(now, spark.createDataFrame([("a", "failed", "t3", None, None)], state.STATE))
    assert tuple(now.first()) == ("a", "failed", "t3", "w", 3)


def payloads(spark, how, *raws):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(raws)], "i int, raw string").orderBy("i").select(how(F.col("raw"))).collect()]


def test_canonical(spark):
    got = payloads(spark, canonical.canonical, '{"b": 1, "a": null, "@odata.etag": "x"}', '{"a": null, "@odata.etag": "y", "b": 1}', '{"b": 1}', None)
    assert got[0] == got[1] and got[0] != got[2]


def test_a_payload_reads_its_record_once(spark):
    rows = spark.createDataFrame([("{}",)], "raw string").repartition(2)
    for how in (canonical.canonical, canonical.canonical_exact):
        assert rows.select(how(F.col("raw")).alias("x"))._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    repeated = '{"b": 1, "@odata.etag": "x", "a": 2, "b": {"z": 1, "y": 2, "z": 3}}'
    assert payloads(spark, canonical.canonical, repeated, None, "{}") == ['{"a": 2, "b": {"y":2,"z":3}}', None, "{}"]


def test_payloads_without_marks_meet_one_pattern(spark):
    rows = spark.createDataFrame([("{}",)], "raw string").repartition(2)
    plan = rows.select(canonical.canonical(F.col("raw")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    # the other patterns are for texts that hold a mark; names need none, and the order no function of arrays
    assert plan.count("regexp_replace(") == 4 and plan.count("Contains(") == 2 and "array_sort(" not in plan
    odd = '{"a\\"b\\\\c\\u0007\u00e9": 1, "\\u0001k": "\\u000112345678901234567", "z": {"y": 12345678901234567890, "x": "\\u0001" }}'
    assert payloads(spark, canonical.canonical, odd) == ['{"\\u0001k": "\\u000112345678901234567", "a\\"b\\\\c\\u0007\u00e9": 1, "z": {"x":"\\u0001","y":12345678901234567890}}']


def test_different_records_have_different_payloads(spark):
    long = "123456789012345678901234567890123456789012345"
    raws = [
        '{"a":{"b":1,"b":2},"c":1}', '{"a":{"b":1,"b":2},"c":2}', '{"a":{"b":1},"c":1}', f'{{"n":{long}}}', f'{{"n":{long[:-1]}6}}', f'{{"n":"{long}"}}', f'{{"n":"\\u0001{long}"}}', f'{{"n":[{{"m":-{long}}}]}}', f'{{"n":[{{"m":{long}}}]}}',
        '{"n":0.12345678901234567}', '{"n":0.12345678901234568}', '{"s":"x \\" 1, 2: 12345678901234567890"}', '{"s":"x \\" 1, 2: 12345678901234567891"}', '{"s":"\\u0001\\u00015"}', '{"s":"\\u00015"}', '{"x":[]}', '{"x":{}}', "{}",
    ]
    for how in (canonical.canonical, canonical.canonical_exact):
        got = payloads(spark, how, *raws)
        assert len(set(got)) == len(raws) and None not in got
    assert payloads(spark, canonical.canonical, '{"a":{"b":1,"b":2}}', '{"k":1,"k":3,"a":1.0}') == ['{"a": {"b":2}}', '{"a": 1, "k": 3}']
    assert payloads(spark, canonical.canonical, '{"a":1}', '{"a":1.0}', f'{{"a": {long}}}')[::2] == ['{"a": 1}', f'{{"a": {long}}}']


def test_the_exact_payload_is_a_sorted_dump(spark):
    words = "x" * 200_000 + '\\n"\\\\' * 20_000
    records = [{"b": [1, -2, {"z": "é😀", "a": None}], "a": {"d": True, "c": "1, 2: 3"}}, {"long": words, "k": 12}, {"n": 10**44 + 1, "s": 'q"uo,te: \\ \t', "": ""}, {"é": {"ü": [], "u": {}}}]
    got = payloads(spark, canonical.canonical_exact, *(json.dumps({"@odata.x": 1, **r}) for r in records))
    assert got == [json.dumps(r, sort_keys=True) for r in records]
    assert payloads(spark, canonical.canonical_exact, '{"b": 1.0, "a": 1.50, "a": 2e5}', '{"b": 1}') == ['{"a": 2e5, "b": 1.0}', '{"b": 1}']
    plan = spark.createDataFrame([("{}",)], "raw string").select(canonical.canonical_exact("raw"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_store_and_stream(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = [("a", "1", "t", "2024-01", 0), ("a", "2", "t", "2024-02", 1), ("b", "1", "t", "2024-01", 2)]
    spark.createDataFrame(rows, COLS).coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        feed.history_stream(spark.readStream.schema(COLS).parquet(str(tmp_path / "in")), store, "t", "k", str(tmp_path / "cp")).awaitTermination()
    assert store.tables() == ["t"] and store.read("t").count() == 3 and store.read("t", "open").count() == 2
    spark.createDataFrame([("a", "1", "t", "2024-03", 0)], COLS).write.mode("append").parquet(str(tmp_path / "in"))
    feed.history_stream(spark.readStream.schema(COLS).parquet(str(tmp_path / "in")), store, "t", "k", str(tmp_path / "cp")).awaitTermination()
    assert store.read("t").count() == 4 and not store.create("t", store.read("t").schema)


def test_a_closed_sample_follows_every_edge_to_the_fixpoint(spark, tmp_path):
    people = spark.createDataFrame([(1, None, None), (2, 1, 10), (3, 2, None), (4, None, 13), (5, None, None), (6, 6, None)], "id int, boss int, first int")
    tasks = spark.createDataFrame([(10, 1, 5), (11, 5, None), (12, 4, 4), (13, None, 4)], "id int, owner int, checker int")
    notes = spark.createDataFrame([(10, "a"), (10, "a"), (12, "b"), (None, "c")], "task int, text string")
    edges = [("people", "boss", "people", "id"), ("tasks", "owner", "people", "id"), ("tasks", "checker", "people", "id"), ("people", "first", "tasks", "id"), ("notes", "task", "tasks", "id")]
    tables, keys = {"people": people, "tasks": tasks, "notes": notes}, {"people": "id", "tasks": "id"}
    got = closure.connected(tables, keys, edges, {"people": people.where("id = 3")})
    ids = lambda t, c="id": sorted(r[c] for r in got[t].collect())
    assert ids("people") == [1, 2, 3, 5] and ids("tasks") == [10, 11] and ids("notes", "text") == ["a", "a"]
    got = closure.reverse_closure({"people": people, "tasks": tasks, "notes": notes}, edges, "people", people.where("id = 5"))
    assert ids("people") == [2, 3, 5] and ids("tasks") == [10, 11] and ids("notes", "text") == ["a", "a"]
    out = export.closed_sample(tables, keys, edges, "tasks", 4, 1)
    assert out["people"].count() == 5 and out["notes"].count() == 3
    versions = people.withColumn("json_response", F.lit("{}"))
    export.write_csv({"people": versions, **{n: out[n] for n in ("tasks", "notes")}}, str(tmp_path / "csv"))
    back = spark.read.option("header", True).schema("id int, boss int, first int").csv(str(tmp_path / "csv" / "people"))
    assert sorted(back.collect()) == sorted(people.collect()) or sorted(map(str, back.collect())) == sorted(map(str, people.collect()))


def test_rows_that_lead_no_further_are_not_made_by_the_closure(spark, monkeypatch):
    people = spark.createDataFrame([(1, None), (2, 1), (3, None)], "id int, boss int")
    notes = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "d")], "person int, text string")
    made = []
    monkeypatch.setattr(closure, "checkpointed", lambda df: made.append(df.columns) or df.localCheckpoint())
    edges = [("people", "boss", "people", "id"), ("notes", "person", "people", "id")]
    got = closure.reverse_closure({"people": people, "notes": notes}, edges, "people", people.where("id = 1"))
    assert sorted(r["text"] for r in got["notes"].collect()) == ["a", "b", "b"] and sorted(r["id"] for r in got["people"].collect()) == [1, 2]
    assert not any("text" in c for c in made)
    read = [line for line in got["notes"].select("person")._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line or "text" in line]
    assert sum("LeftSemi" in line for line in read) == 2 and not any("<text" in line for line in read)  # one a round
