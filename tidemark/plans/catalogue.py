"""Registered queries of the engine's own operators, on the tables of one folder, and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types_map
from ..model import Column, EntityConfig, ForeignKey, TableSchema
from ..operators import canonical, closure, incremental, integrity, optionsets, schema_diff, scd2, state, temporal
from ..sources import metadata
from ..sources.store import Store, shared_folder
from . import sample, workflow

SPLIT = "2024-01-15"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---- versions (#27-#29, Q1-Q4)

H = """c AS (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS rn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
h AS (SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to FROM c WHERE rn = 1 OR p IS DISTINCT FROM event_type)"""


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.history(_t(spark, sf_dir, "events"), "user_id", "event_id", ["event_type"], "ts")


@query(f"WITH {H} SELECT * FROM h")
def scd2_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query(f"WITH {H} SELECT * FROM h WHERE valid_to IS NULL")
def scd2_active(spark, sf_dir):
    return temporal.active(_history(spark, sf_dir))


@query(f"WITH {H} SELECT * FROM h WHERE valid_from <= TIMESTAMP '{SPLIT}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{SPLIT}')")
def scd2_asof(spark, sf_dir):
    return temporal.as_of(_history(spark, sf_dir), _at(SPLIT))


@query(f"WITH {H} SELECT count(*) AS total, count(*) FILTER (WHERE valid_to IS NULL) AS active, count(*) FILTER (WHERE valid_to IS NOT NULL) AS historical FROM h")
def scd2_counts(spark, sf_dir):
    return temporal.version_counts(_history(spark, sf_dir))


@query(f"WITH {H} SELECT * FROM h WHERE user_id = 7 ORDER BY valid_from")
def scd2_key_history(spark, sf_dir):
    return temporal.versions(_history(spark, sf_dir), "user_id", 7)


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _t(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("json_response"), F.col("ts").alias("sync_time"), F.col("ts").alias("valid_from"), F.col("event_id").alias("seq"))
    first, second = rows.where(F.col("valid_from") < _at(SPLIT)), rows.where(F.col("valid_from") >= _at(SPLIT))
    return rows.drop("seq").limit(0), first, second


@query(f"WITH {H} SELECT * FROM h")
def scd2_apply_two_batches(spark, sf_dir):
    none, first, second = _batches(spark, sf_dir)
    one = scd2.apply(none, first, "user_id")
    two = scd2.apply(temporal.active(one).select(none.columns), second, "user_id")
    cols = ["user_id", F.col("json_response").alias("event_type"), "valid_from", "valid_to"]
    return one.where("valid_to is not null").select(*cols).unionByName(two.select(*cols))


@query(f"""WITH {H}, n AS (SELECT user_id, min(valid_from) AS born FROM h GROUP BY user_id)
SELECT count(*) FILTER (WHERE valid_from = born) AS added, count(*) FILTER (WHERE valid_from <> born) AS updated FROM h JOIN n USING (user_id) WHERE valid_from >= TIMESTAMP '{SPLIT}'""")
def scd2_batch_counts(spark, sf_dir):
    none, first, second = _batches(spark, sf_dir)
    return scd2.counts(scd2.apply(temporal.active(scd2.apply(none, first, "user_id")).select(none.columns), second, "user_id"))


@query(f"""WITH r AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n, min(ts) OVER (PARTITION BY user_id) >= TIMESTAMP '{SPLIT}' AS is_new FROM events)
SELECT user_id, event_type, value, is_new FROM r WHERE n = 1""")
def scd1_upsert(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select("user_id", "event_type", "value", "ts", F.col("event_id").alias("seq"))
    old = rows.where(F.col("ts") < _at(SPLIT)).drop("ts")
    none = old.drop("seq").limit(0)
    target = scd2.upsert_scd1(none, old, "user_id").drop("is_new")
    return scd2.upsert_scd1(target, rows.where(F.col("ts") >= _at(SPLIT)).drop("ts"), "user_id")


# ---- raw records (#23-#26)


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.lit('{"user_id": '), F.col("user_id").cast("string"), F.lit(', "event_type": "'), F.col("event_type"), F.lit('", "@odata.etag": "W/'), F.col("event_id").cast("string"), F.lit('", "event_id": '), F.col("event_id").cast("string"), F.lit("}")]
    return _t(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.concat(*parts).alias("raw"))


@query("""SELECT event_id AS seq, '{"event_id": ' || event_id || ', "event_type": "' || event_type || '", "user_id": ' || user_id || '}' AS payload FROM events""")
def canonical_payload(spark, sf_dir):
    return _raw_events(spark, sf_dir).select("seq", canonical.canonical(F.col("raw")).alias("payload"))


@query("""SELECT event_id AS seq, '{"event_id": ' || event_id || ', "event_type": "' || event_type || '", "user_id": ' || user_id || '}' AS payload FROM events""")
def canonical_payload_exact(spark, sf_dir):
    return _raw_events(spark, sf_dir).select("seq", canonical.canonical_exact("raw").alias("payload"))


LONG = "1234567890123456789012345678901234567890"


@query(f"""SELECT event_id AS seq, '{{"a": {{"b":' || user_id || '}}, "n": {LONG}' || 10000 + event_id || ', "s": "q\\"' || event_type || ': {LONG}, \\\\", "w": [' || event_id || ',{{"x":{LONG}.5}}]}}' AS payload FROM events""")
def canonical_payload_nested(spark, sf_dir):
    """Keys that repeat at two levels, numbers of 40 digits and more, escapes (#23)."""
    e, u = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    raw = F.concat(
        F.lit('{"w": [0], "s": "q\\"'), "event_type", F.lit(f': {LONG}, \\\\", "a": {{"b": -1, "b": '), u, F.lit(f'}}, "@odata.etag": "'), e, F.lit(f'", "n": {LONG}'), (F.col("event_id") + 10000).cast("string"), F.lit(', "w": ['), e, F.lit(f', {{"x": {LONG}.5}}]}}'),
    )
    return _t(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), canonical.canonical(raw).alias("payload"))


@query("SELECT user_id::VARCHAR AS user_id, event_type, event_id AS seq, '2024-06-01T00:00:00Z' AS valid_from FROM events")
def record_projection(spark, sf_dir):
    rows = canonical.to_versions(_raw_events(spark, sf_dir), "user_id", {"user_id": T.StringType(), "event_type": T.StringType()}, "2024-06-01T00:00:00Z")
    return rows.select("user_id", "event_type", "seq", "valid_from")


@query("""SELECT CASE WHEN user_id % 5 = 0 THEN '0' ELSE user_id::VARCHAR END AS user_id, event_id AS seq FROM events WHERE event_id % 4 = 3""")
def record_keys(spark, sf_dir):
    """Of records without a key, with a null, empty or zero one, the last stay (#26)."""
    key = F.expr("CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '\"user_id\": null, ' WHEN 2 THEN '\"user_id\": \"\", ' ELSE concat('\"user_id\": ', if(user_id % 5 = 0, 0, user_id), ', ') END")
    raw = _t(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.concat(F.lit("{"), key, F.lit('"x": 1}')).alias("raw"))
    return canonical.to_versions(raw, "user_id", {"user_id": T.StringType()}, "2024-06-01T00:00:00Z").select("user_id", "seq")


# ---- coded fields (#30-#38, Q5-Q10)


def _coded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_orderpriority")
    raw = F.concat(F.lit('{"priority": '), F.split_part(p, F.lit("-"), F.lit(1)), F.lit(f', "priority{optionsets.SUFFIX}": "'), F.split_part(p, F.lit("-"), F.lit(2)), F.lit('"}'))
    return _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", raw.alias("raw"))


def _priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return optionsets.detect(_coded_orders(spark, sf_dir), ids=["o_orderkey", "o_orderdate"])


def _lookup(spark: SparkSession, found: DataFrame, seen_at: str, seq: str) -> DataFrame:
    seen = found.select("field", "code", "label", F.col(seen_at).alias("seen_at"), F.col(seq).alias("seq"))
    none = seen.select("field", "code", "label", F.col("seen_at").alias("first_seen")).limit(0)
    return optionsets.merge_lookup(none, seen)


@query("""SELECT 'priority' AS field, split_part(o_orderpriority, '-', 1)::BIGINT AS code, arg_max(split_part(o_orderpriority, '-', 2), o_orderkey) AS label, min(o_orderdate) AS first_seen FROM orders GROUP BY ALL""")
def optionset_single(spark, sf_dir):
    return _lookup(spark, _priorities(spark, sf_dir), "o_orderdate", "o_orderkey")


@query("SELECT o_orderkey, split_part(o_orderpriority, '-', 1)::BIGINT AS code, split_part(o_orderpriority, '-', 2) AS label FROM orders")
def optionset_label_join(spark, sf_dir):
    found = _priorities(spark, sf_dir)
    lookup = _lookup(spark, found, "o_orderdate", "o_orderkey")
    return temporal.with_label(found.select("o_orderkey", F.col("code").alias("priority")), "priority", optionsets.lookup_of(lookup, "priority")).withColumnRenamed("priority", "code")


@query(f"WITH {H} SELECT user_id, event_type AS code_name, upper(event_type) AS label, valid_from FROM h WHERE valid_to IS NULL")
def optionset_label_active(spark, sf_dir):
    now = temporal.active(_history(spark, sf_dir))
    lookup = _t(spark, sf_dir, "events").select("event_type").distinct().select(F.col("event_type").alias("code"), F.upper("event_type").alias("label"))
    return temporal.with_label(now, "event_type", lookup).select("user_id", F.col("event_type").alias("code_name"), "label", "valid_from")


def _multi_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_linenumber")).alias("n"))
    codes, labels = F.array_join(F.col("n").cast("array<string>"), ","), F.array_join(F.transform("n", lambda x: F.concat(F.lit("L"), x.cast("string"))), ";")
    return lines.select("l_orderkey", F.concat(F.lit('{"lines": "'), codes, F.lit(f'", "lines{optionsets.SUFFIX}": "'), labels, F.lit('"}')).alias("raw"))


@query("""SELECT l_orderkey, 'lines' AS field, count(*) OVER (PARTITION BY l_orderkey) > 1 AS is_multi, (row_number() OVER (PARTITION BY l_orderkey ORDER BY n) - 1)::INT AS pos, n::BIGINT AS code, 'L' || n AS label
FROM (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem)""")
def optionset_multi_explode(spark, sf_dir):
    return optionsets.detect(_multi_orders(spark, sf_dir), ids=["l_orderkey"])


@query("SELECT 'k' AS field, regexp_extract(props, '[0-9]+')::BIGINT AS code, arg_max(event_type, event_id) AS label, min(ts) AS first_seen FROM events GROUP BY ALL")
def optionset_lookup_merge(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.lit("k").alias("field"), F.get_json_object("props", "$.k").cast("long").alias("code"), F.col("event_type").alias("label"), "ts", "event_id")
    old = _lookup(spark, e.where(F.col("ts") < _at(SPLIT)), "ts", "event_id")
    return optionsets.merge_lookup(old, e.where(F.col("ts") >= _at(SPLIT)).select("field", "code", "label", F.col("ts").alias("seen_at"), F.col("event_id").alias("seq")))


CODE = "ascii(event_type) * 1000 + length(event_type)"
J = f"""d AS (SELECT user_id, ts::DATE::TIMESTAMP AS day, list_sort(list(DISTINCT ({CODE})::BIGINT)) AS codes FROM events GROUP BY ALL),
e AS (SELECT *, lag(codes) OVER (PARTITION BY user_id ORDER BY day) AS p, row_number() OVER (PARTITION BY user_id ORDER BY day) AS rn FROM d),
v AS (SELECT user_id, day, codes FROM e WHERE rn = 1 OR p IS DISTINCT FROM codes),
f AS (SELECT *, max(len(codes) > 1) OVER (PARTITION BY user_id ORDER BY day) AS ever FROM v),
s AS (SELECT user_id, day, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS valid_to, codes FROM f WHERE ever),
j AS (SELECT user_id AS entity_id, unnest(codes) AS option_code, day AS valid_from, valid_to FROM s)"""


def _daily(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(versions of each user's set of event types, the codes detected in them)."""
    e = _t(spark, sf_dir, "events").select("user_id", F.to_date("ts").cast("timestamp_ntz").alias("day"), F.expr(CODE).cast("string").alias("c"), F.col("event_type").alias("l"))
    sets = e.groupBy("user_id", "day").agg(F.array_sort(F.collect_set(F.struct("c", "l"))).alias("x"))
    raw = F.concat(F.lit('{"types": "'), F.array_join("x.c", ","), F.lit(f'", "types{optionsets.SUFFIX}": "'), F.array_join("x.l", ";"), F.lit('"}'))
    versions = scd2.history(sets.select("user_id", "day", raw.alias("raw")), "user_id", "day", ["raw"], "day").withColumn("seq", F.col("valid_from"))
    return versions, optionsets.detect(versions.select("user_id", "seq", "raw"), ids=["user_id", "seq"])


def _junction(spark: SparkSession, sf_dir: str, mode: str = "fixed") -> DataFrame:
    versions, found = _daily(spark, sf_dir)
    return optionsets.junction(versions, found, "user_id", "types", mode)


@query(f"WITH {J} SELECT * FROM j")
def junction_history(spark, sf_dir):
    return _junction(spark, sf_dir)


@query(f"""WITH {J}, m AS (SELECT user_id, day, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS valid_to, codes FROM v WHERE len(codes) > 1)
SELECT user_id AS entity_id, unnest(codes) AS option_code, day AS valid_from, valid_to FROM m""")
def junction_history_compat(spark, sf_dir):
    return _junction(spark, sf_dir, "compat")


@query(f"WITH {J} SELECT * FROM j WHERE valid_to IS NULL")
def junction_active(spark, sf_dir):
    return temporal.active(_junction(spark, sf_dir))


@query(f"WITH {J} SELECT * FROM j WHERE valid_from <= TIMESTAMP '{SPLIT}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{SPLIT}')")
def junction_asof(spark, sf_dir):
    return temporal.as_of(_junction(spark, sf_dir), _at(SPLIT))


@query(f"WITH {J} SELECT option_code FROM j WHERE valid_to IS NULL AND entity_id = 7 ORDER BY option_code")
def junction_codes(spark, sf_dir):
    return temporal.active_codes(_junction(spark, sf_dir), 7)


@query(f"""WITH {J}, l AS (SELECT DISTINCT ({CODE})::BIGINT AS code, event_type AS label FROM events),
a AS (SELECT entity_id, string_agg(label, ', ' ORDER BY label) AS labels FROM j JOIN l ON code = option_code WHERE valid_to IS NULL GROUP BY entity_id)
SELECT c_custkey, labels FROM customer LEFT JOIN a ON entity_id = c_custkey""")
def junction_labels(spark, sf_dir):
    lookup = _t(spark, sf_dir, "events").select(F.expr(CODE).cast("long").alias("code"), F.col("event_type").alias("label")).distinct()
    return temporal.with_labels(_t(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", _junction(spark, sf_dir), lookup)


@query(f"WITH {J} SELECT user_id, day AS valid_from, option_code, j.valid_to AS option_valid_to FROM v JOIN j ON entity_id = user_id AND j.valid_from = day")
def temporal_join(spark, sf_dir):
    versions, found = _daily(spark, sf_dir)
    return temporal.snapshots(versions.select("user_id", "valid_from"), optionsets.junction(versions, found, "user_id", "types"), "user_id")


@query(f"""WITH {J}, a AS (SELECT entity_id, option_code, valid_from, valid_to FROM j WHERE valid_to IS NULL)
SELECT entity_id, option_code, valid_from, TIMESTAMP '2030-01-01' AS valid_to FROM a WHERE entity_id % 2 = 0
UNION ALL SELECT * FROM a WHERE entity_id % 2 <> 0
UNION ALL SELECT DISTINCT entity_id, 1::BIGINT, TIMESTAMP '2030-01-01', NULL::TIMESTAMP FROM a WHERE entity_id % 4 = 0""")
def junction_snapshot(spark, sf_dir):
    now = temporal.active(_junction(spark, sf_dir))
    new = now.where("entity_id % 2 = 0").select("entity_id").distinct().select("entity_id", F.when(F.expr("entity_id % 4 = 0"), F.lit(1).cast("long")).alias("option_code"), _at("2030-01-01").alias("valid_from"))
    return optionsets.snapshot(now, new)


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS entity_id, l_linenumber::BIGINT AS option_code, l_returnflag AS f FROM lineitem)
SELECT DISTINCT entity_id, option_code FROM l WHERE entity_id % 2 <> 0 UNION ALL SELECT DISTINCT entity_id, option_code + 10 FROM l WHERE entity_id % 4 = 0 AND f = 'R'""")
def junction_replace(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("entity_id"), F.col("l_linenumber").cast("long").alias("option_code"), "l_returnflag")
    new = lines.where("entity_id % 4 = 0 and l_returnflag = 'R'").select("entity_id", F.col("option_code") + 10).toDF("entity_id", "option_code").distinct()
    return optionsets.replace_links(lines.select("entity_id", "option_code").distinct(), new, lines.where("entity_id % 2 = 0").select("entity_id"))


# ---- whole syncs (#10-#13, #33-#37, #42-#45, #49, #51, #60)

_STORES: dict[tuple[str, str], Store] = {}


def _synced(spark: SparkSession, sf_dir: str) -> Store:
    """A store in the shared folder after two syncs of the folder's customers, of which a tenth changed in between; made once a session and folder."""
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _STORES:
        store, source = Store(spark, f"{shared_folder(spark)}/sync-{uuid.uuid4().hex}"), sample.source(spark, sf_dir)
        for day, where in (("2024-01-02", None), ("2024-02-02", "c_custkey % 10 = 0")):
            if where:
                source.records["buyers"] = sample.turn(spark, sf_dir, where, "2024-02-01")
            got = workflow.run_workflow(store, source, sample.ENTITIES, verify_references=True, clock=day)
            if not got["success"]:
                raise RuntimeError(f"the sync failed: {got}")
        _STORES[name] = store
    return _STORES[name]


@query("""SELECT c_custkey::VARCHAR AS buyerid, c_name AS title, ascii(c_mktsegment)::BIGINT AS segment, '2024-01-01' AS valid_from, CASE WHEN c_custkey % 10 = 0 THEN '2024-02-01' END AS valid_to FROM customer
UNION ALL SELECT c_custkey::VARCHAR, c_name, ascii(c_mktsegment)::BIGINT, '2024-02-01', NULL FROM customer WHERE c_custkey % 10 = 0""")
def sync_versions(spark, sf_dir):
    return _synced(spark, sf_dir).read("buyers").select("buyerid", "title", "segment", "valid_from", "valid_to")


@query("SELECT count(*) + count(*) FILTER (WHERE c_custkey % 10 = 0) AS n, 1::BIGINT AS first, count(*) + count(*) FILTER (WHERE c_custkey % 10 = 0) AS last FROM customer")
def sync_row_ids(spark, sf_dir):
    return _synced(spark, sf_dir).read("buyers").agg(F.count_distinct("row_id").alias("n"), F.min("row_id").alias("first"), F.max("row_id").alias("last"))


@query("SELECT DISTINCT n_nationkey::VARCHAR AS landid, n_name AS title FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)")
def sync_filtered(spark, sf_dir):
    return _synced(spark, sf_dir).read("lands", "open").select("landid", "title")


@query("""SELECT 'segment' AS field, ascii(c_mktsegment)::BIGINT AS code, arg_max(c_mktsegment, c_custkey) AS label, '2024-01-02' AS first_seen FROM customer GROUP BY 2
UNION ALL SELECT * FROM (VALUES ('picks', 1::BIGINT, 'A', '2024-01-02'), ('picks', 2, 'B', '2024-01-02'), ('picks', 3, 'C', '2024-01-02')) v""")
def sync_lookups(spark, sf_dir):
    return _synced(spark, sf_dir).read("_optionset").select("field", "code", "label", "first_seen")


@query("""WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN [1, 2] WHEN 1 THEN [2, 3] ELSE [] END AS p FROM customer)
SELECT k::VARCHAR AS entity_id, unnest(p)::BIGINT AS option_code, '2024-01-01' AS valid_from, CASE WHEN k % 10 = 0 THEN '2024-02-01' END AS valid_to FROM c
UNION ALL SELECT k::VARCHAR, 3, '2024-02-01', NULL FROM c WHERE k % 10 = 0 AND len(p) > 0""")
def sync_junction(spark, sf_dir):
    return _synced(spark, sf_dir).read("_junction_buyers_picks")


@query("""SELECT * FROM (VALUES ('buyers', 'row_id', 'bigint'), ('buyers', 'buyerid', 'string'), ('buyers', 'title', 'string'), ('buyers', 'segment', 'bigint'), ('buyers', 'picks', 'string'), ('buyers', '_land_value', 'string'), ('buyers', 'modifiedon', 'string'),
('buyers', 'json_response', 'string'), ('buyers', 'sync_time', 'string'), ('buyers', 'valid_from', 'string'), ('buyers', 'valid_to', 'string'), ('_optionset', 'field', 'string'), ('_optionset', 'code', 'bigint'), ('_optionset', 'label', 'string'), ('_optionset', 'first_seen', 'string'),
('_junction_buyers_picks', 'entity_id', 'string'), ('_junction_buyers_picks', 'option_code', 'bigint'), ('_junction_buyers_picks', 'valid_from', 'string'), ('_junction_buyers_picks', 'valid_to', 'string')) v(entity, "column", db_type)""")
def sync_tables(spark, sf_dir):
    return _synced(spark, sf_dir).columns().where("entity in ('buyers', '_optionset', '_junction_buyers_picks')").select("entity", "column", "db_type")


@query("""SELECT 'buyers' AS entity_name, 'completed' AS state, '2024-02-01' AS last_timestamp, count(*) FILTER (WHERE c_custkey % 10 = 0) AS records_count FROM customer""")
def sync_state_of(spark, sf_dir):
    return state.get_state(_synced(spark, sf_dir).read(workflow.STATE), "buyers").select("entity_name", "state", "last_timestamp", "records_count")


def _failing(store: Store, at: int) -> Store:
    """The store, of whose next writes the one numbered `at` fails."""
    left = [at]

    class Failing(Store):
        def _put(self, *args, **named):
            left[0] -= 1
            if left[0] == 0:
                raise OSError("the disk is full")
            return super()._put(*args, **named)

    return Failing(store.spark, store.root)


def _new_store(spark: SparkSession) -> Store:
    return Store(spark, f"{shared_folder(spark)}/sync-{uuid.uuid4().hex}")


@query("""WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN [1, 2] WHEN 1 THEN [2, 3] ELSE [] END AS p FROM customer)
SELECT 'version' AS kind, k::VARCHAR AS id, NULL::BIGINT AS code, '2024-01-01' AS valid_from, CASE WHEN k % 10 = 0 THEN '2024-02-01' END AS valid_to FROM c UNION ALL SELECT 'version', k::VARCHAR, NULL, '2024-02-01', NULL FROM c WHERE k % 10 = 0
UNION ALL SELECT 'link', k::VARCHAR, unnest(p)::BIGINT, '2024-01-01', CASE WHEN k % 10 = 0 THEN '2024-02-01' END FROM c UNION ALL SELECT 'link', k::VARCHAR, 3, '2024-02-01', NULL FROM c WHERE k % 10 = 0 AND len(p) > 0""")
def sync_after_failure(spark, sf_dir):
    """Versions and links after a sync that failed between them, and the next one (#28, #37)."""
    store, source = _new_store(spark), sample.source(spark, sf_dir)
    workflow.run_workflow(store, source, sample.ENTITIES, clock="2024-01-02")
    source.records["buyers"] = sample.turn(spark, sf_dir, "c_custkey % 10 = 0", "2024-02-01")
    failed = workflow.run_workflow(_failing(store, 7), source, sample.ENTITIES, clock="2024-02-02")
    if not failed["failed_entities"] or not workflow.run_workflow(store, source, sample.ENTITIES, clock="2024-02-03")["success"]:
        raise RuntimeError(f"the failure was not one, or was not mended: {failed}")
    versions = store.read("buyers").select(F.lit("version").alias("kind"), F.col("buyerid").alias("id"), F.lit(None).cast("long").alias("code"), "valid_from", "valid_to")
    return versions.unionByName(store.read("_junction_buyers_picks").select(F.lit("link").alias("kind"), F.col("entity_id").alias("id"), F.col("option_code").alias("code"), "valid_from", "valid_to"))


_LATE = """l AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN [1, 2] WHEN 1 THEN [2, 3] ELSE [] END AS p, '2024-01-01' AS f, CASE WHEN c_custkey % 20 = 0 THEN '2024-02-01' WHEN c_custkey % 10 = 0 THEN '2024-03-01' END AS t FROM customer
UNION ALL SELECT c_custkey, [3], '2024-02-01', '2024-03-01' FROM customer WHERE c_custkey % 20 = 0 UNION ALL SELECT c_custkey, [3], '2024-03-01', NULL FROM customer WHERE c_custkey % 10 = 0)"""


def _late(spark: SparkSession, sf_dir: str) -> Store:
    """A store in which February's records came after those of January and March."""
    store, source = _new_store(spark), sample.source(spark, sf_dir)
    schema = metadata.parse(sample.DOCUMENT)["buyer"]
    for turn in (source.records["buyers"], sample.turn(spark, sf_dir, "c_custkey % 10 = 0", "2024-03-01"), sample.turn(spark, sf_dir, "c_custkey % 20 = 0", "2024-02-01")):
        workflow.load_batch(store, sample.ENTITIES[0], schema, turn, "2024-04-01", in_time=True)
    return store


@query(f"WITH {_LATE} SELECT k::VARCHAR AS buyerid, f AS valid_from, t AS valid_to FROM l")
def sync_late_records(spark, sf_dir):
    return _late(spark, sf_dir).read("buyers").select("buyerid", "valid_from", "valid_to")


@query(f"""WITH {_LATE}, e AS (SELECT *, max(len(p) > 1) OVER (PARTITION BY k ORDER BY f) AS ever FROM l) SELECT k::VARCHAR AS entity_id, unnest(p)::BIGINT AS option_code, f AS valid_from, t AS valid_to FROM e WHERE ever""")
def sync_late_links(spark, sf_dir):
    return _late(spark, sf_dir).read("_junction_buyers_picks")


@query("""WITH d AS (SELECT user_id, ts, arg_max(event_type, event_id) AS event_type FROM events GROUP BY ALL), c AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS p, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn FROM d),
v AS (SELECT * FROM c WHERE rn = 1 OR p IS DISTINCT FROM event_type) SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM v""")
def scd2_late_records(spark, sf_dir):
    """Three batches, the oldest events last."""
    rows = _t(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("json_response"), F.col("ts").alias("sync_time"), F.col("ts").alias("valid_from"), F.col("event_id").alias("seq"))
    known = rows.drop("seq").limit(0)
    for n in (2, 1, 0):
        told = scd2.splice(known, rows.where(f"seq % 3 = {n}"), "user_id")
        known = told.select(known.columns)
    return told.where("is_version").select("user_id", F.col("json_response").alias("event_type"), "valid_from", "valid_to")


@query("SELECT '7' AS buyerid, c_name AS title, '2024-01-01' AS valid_from, NULL::VARCHAR AS valid_to FROM customer WHERE c_custkey = 7")
def sync_key_history(spark, sf_dir):
    """Q2 by the index of the store."""
    return _synced(spark, sf_dir).read("buyers", key="7").select("buyerid", "title", "valid_from", "valid_to").orderBy("valid_from")


@query("SELECT c_custkey::VARCHAR AS buyerid, '2024-01-01' AS valid_from FROM customer")
def sync_asof(spark, sf_dir):
    """Q3 by the index of the store."""
    return _synced(spark, sf_dir).read("buyers", at="2024-01-15").select("buyerid", "valid_from")


@query("""WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN [1, 2] WHEN 1 THEN [2, 3] ELSE [] END AS p FROM customer)
SELECT k::VARCHAR AS entity_id, unnest(p)::BIGINT AS option_code, '2024-01-01' AS valid_from FROM c WHERE k % 10 <> 0 UNION ALL SELECT k::VARCHAR, 3, '2024-02-01' FROM c WHERE k % 10 = 0 AND len(p) > 0""")
def sync_junction_asof(spark, sf_dir):
    """Q9 by the index of the store."""
    return _synced(spark, sf_dir).read("_junction_buyers_picks", at="2024-02-15").select("entity_id", "option_code", "valid_from")


@query("SELECT '30' AS entity_id, 3::BIGINT AS option_code")
def sync_junction_codes(spark, sf_dir):
    """Q8 by the index of the store."""
    return _synced(spark, sf_dir).read("_junction_buyers_picks", key="30", is_open=True).select("entity_id", "option_code").orderBy("option_code")


# ---- metadata documents (#22a-#22g), keys and order (#42-#44), edges (#50)


@query("""SELECT * FROM (VALUES ('buyer', 'buyerid', 'TEXT', FALSE, NULL), ('buyer', 'title', 'TEXT', TRUE, 30), ('buyer', 'segment', 'INTEGER', TRUE, NULL), ('buyer', 'picks', 'INTEGER', TRUE, NULL), ('buyer', '_land_value', 'TEXT', TRUE, NULL), ('buyer', 'modifiedon', 'TEXT', TRUE, NULL),
('land', 'landid', 'TEXT', FALSE, NULL), ('land', 'title', 'TEXT', TRUE, 25)) v(entity, "column", db_type, nullable, max_length)""")
def metadata_columns(spark, sf_dir):
    return metadata.column_table(spark, metadata.parse(sample.DOCUMENT, option_sets={"buyer": ["picks"]})).select("entity", "column", "db_type", "nullable", "max_length")


@query("""SELECT * FROM (VALUES ('buyer', '_land_value', 'land', 'landid')) v(entity, "column", referenced_table, referenced_column)""")
def metadata_references(spark, sf_dir):
    return metadata.reference_table(spark, metadata.parse(sample.DOCUMENT)).select("entity", "column", "referenced_table", "referenced_column")


def _own_schemas(spark: SparkSession, sf_dir: str) -> dict[str, TableSchema]:
    """The tables' schemas, with keys and references as declared here, some of which no column bears out."""
    keys = {"customer": "c_custkey", "orders": "orderno", "nation": None}
    refs = {"customer": [("c_nationkey", "Nation", "n_nationkey"), ("c_gone", "nation", "n_nationkey")], "orders": [("o_custkey", "customer", "c_custkey"), ("o_orderkey", "elsewhere", "x")], "nation": [("n_regionkey", "region", "r_regionkey")]}
    return {n: TableSchema(n, [Column(c, "TEXT") for c in _t(spark, sf_dir, n).columns], keys[n], [ForeignKey(*r) for r in refs[n]]) for n in keys}


@query("""WITH f(s, c, d, k) AS (VALUES ('customer', 'c_nationkey', 'nation', 'n_nationkey'), ('customer', 'c_gone', 'nation', 'n_nationkey'), ('orders', 'o_custkey', 'customer', 'c_custkey'), ('nation', 'n_regionkey', 'region', 'r_regionkey'))
SELECT s || 's' AS src_table, c AS fk_col, d || 's' AS dst_table, k AS dst_col, EXISTS (SELECT 1 FROM information_schema.columns i WHERE i.table_name = s AND i.column_name = c) AS kept FROM f WHERE d <> 'region'""")
def entity_edges(spark, sf_dir):
    found, dropped = closure.edges(_own_schemas(spark, sf_dir), [EntityConfig(n, f"{n}s") for n in ("customer", "orders", "nation")])
    rows = [(*e, True) for e in found] + [(*e, False) for e in dropped]
    return spark.createDataFrame(rows, "src_table string, fk_col string, dst_table string, dst_col string, kept boolean")


@query("""WITH t(entity, declared) AS (VALUES ('customer', 'c_custkey'), ('orders', 'orderno'), ('nation', NULL)), c AS (SELECT table_name, column_name FROM information_schema.columns)
SELECT entity, CASE WHEN EXISTS (SELECT 1 FROM c WHERE table_name = entity AND column_name = declared) THEN declared END AS key, declared AS order_by FROM t""")
def entity_keys(spark, sf_dir):
    rows = [(n, incremental.resolve_key(s, n, required=False), incremental.order_column(s)) for n, s in _own_schemas(spark, sf_dir).items()]
    return spark.createDataFrame(rows, "entity string, key string, order_by string")


@query("""SELECT * FROM (VALUES ('buyers', 'type_mismatch', 'error', 'segment'), ('ghost', 'missing_in_metadata', 'warning', NULL), ('lands', 'new_entity', 'info', NULL)) v(entity, issue_type, severity, name)""")
def schema_gate(spark, sf_dir):
    """What is said before a sync whose metadata have changed (#22m-#22r)."""
    expected = metadata.parse(sample.DOCUMENT)
    actual = {"buyers": TableSchema("buyers", [Column(c.name, "TEXT", c.edm_type, c.nullable, c.max_length) for c in expected["buyer"].columns] + [Column("row_id", "INTEGER"), Column("valid_to", "TEXT")], "row_id")}
    _, _, found, _ = schema_diff.gate(spark, expected, actual, [*sample.ENTITIES, EntityConfig("ghost", "ghosts")])
    return found.select("entity", "issue_type", "severity", F.try_element_at("details", F.lit("column_name")).alias("name"))


# ---- incremental and filtered loads (#39-#51, Q11, Q12)


@query("SELECT max(ts) AS last_timestamp, count(*) AS records_count FROM events")
def watermark(spark, sf_dir):
    return incremental.watermark(_t(spark, sf_dir, "events"), "ts")


@query(f"SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '{SPLIT} 12:00:00'")
def incremental_filter(spark, sf_dir):
    return incremental.since(_t(spark, sf_dir, "events"), _at(f"{SPLIT} 12:00:00"), "ts").select("event_id", "ts")


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ids = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    return incremental.split_ids(ids, _t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'"), "c_custkey")


@query("SELECT DISTINCT o_custkey::VARCHAR AS id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def id_split_new(spark, sf_dir):
    return _split(spark, sf_dir)[0]


@query("SELECT DISTINCT o_custkey::VARCHAR AS id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def id_split_existing(spark, sf_dir):
    return _split(spark, sf_dir)[1]


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
AND (c_mktsegment <> 'BUILDING' OR c_acctbal > 1000)""")
def filtered_fetch(spark, sf_dir):
    new, existing = _split(spark, sf_dir)
    return incremental.fetch_by_ids(_t(spark, sf_dir, "customer"), "c_custkey", new, existing, 1000.0, "c_acctbal").select("c_custkey", "c_mktsegment")


@query("SELECT DISTINCT c_nationkey AS id FROM customer WHERE c_nationkey IS NOT NULL")
def fk_distinct(spark, sf_dir):
    return temporal.distinct_values(_t(spark, sf_dir, "customer"), "c_nationkey")


@query("SELECT c_nationkey::VARCHAR AS id FROM customer WHERE c_nationkey IS NOT NULL UNION SELECT s_nationkey::VARCHAR FROM supplier WHERE s_nationkey IS NOT NULL")
def fk_union(spark, sf_dir):
    return temporal.union_values([(_t(spark, sf_dir, "customer"), "c_nationkey"), (_t(spark, sf_dir, "supplier"), "s_nationkey")])


EDGES = [
    ("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
]
KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "orders": "o_orderkey", "supplier": "s_suppkey"}


@query("""WITH o AS (SELECT * FROM orders WHERE o_totalprice > 490000), c AS (SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM o)),
n AS (SELECT * FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM c)), r AS (SELECT * FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM n))
SELECT 'customer' AS entity, c_custkey::VARCHAR AS id FROM c UNION ALL SELECT 'nation', n_nationkey::VARCHAR FROM n UNION ALL SELECT 'region', r_regionkey::VARCHAR FROM r""")
def fk_closure(spark, sf_dir):
    start = {"orders": _t(spark, sf_dir, "orders").where("o_totalprice > 490000")}
    wanted = {n: (_t(spark, sf_dir, n), KEYS[n]) for n in ("region", "nation", "customer")}
    found, _ = closure.closure(start, wanted, EDGES)
    each = [t.select(F.lit(n).alias("entity"), F.col(KEYS[n]).cast("string").alias("id")) for n, t in found.items()]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("""WITH r AS (SELECT * FROM region WHERE r_regionkey = 2), n AS (SELECT * FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM r)),
c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)), s AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)),
o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c))
SELECT 'region' AS entity, count(*) AS n FROM r UNION ALL SELECT 'nation', count(*) FROM n UNION ALL SELECT 'customer', count(*) FROM c UNION ALL SELECT 'supplier', count(*) FROM s
UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o)""")
def fk_closure_reverse(spark, sf_dir):
    tables = {n: _t(spark, sf_dir, n) for n in ("nation", "customer", "supplier", "orders", "lineitem")}
    found = closure.reverse_closure(tables, EDGES, "region", _t(spark, sf_dir, "region").where("r_regionkey = 2"))
    out = None
    for n, t in found.items():
        row = t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("entity"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def _circles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Customers in tens: the first of ten is the others' boss; orders have two customers, and customers a first order."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.expr("o_custkey - o_custkey % 10 + o_orderkey % 10").alias("payer"))
    first = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").alias("first_order"))
    people = _t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.expr("if(c_custkey % 10 = 0, null, c_custkey - c_custkey % 10)").alias("boss"))
    return {"people": people.join(first, "c_custkey", "left"), "orders": orders}


@query("""WITH RECURSIVE o AS (SELECT o_orderkey AS k, o_custkey AS c, o_custkey - o_custkey % 10 + o_orderkey % 10 AS payer FROM orders), f AS (SELECT c, min(k) AS k FROM o GROUP BY c), p AS (SELECT c_custkey AS c, c_acctbal AS b FROM customer),
d AS (SELECT 'orders' AS a, k AS x, 'people' AS b, c AS y FROM o UNION SELECT 'orders', k, 'people', payer FROM o UNION SELECT 'people', c, 'orders', k FROM f UNION SELECT 'people', c, 'people', c - c % 10 FROM p WHERE c % 10 <> 0),
g AS (SELECT DISTINCT * FROM (SELECT a, x, b, y FROM d UNION ALL SELECT b, y, a, x FROM d) WHERE NOT (b = 'people' AND y NOT IN (SELECT c FROM p)) AND NOT (a = 'people' AND x NOT IN (SELECT c FROM p))),
r AS (SELECT 'people' AS entity, c AS id FROM p WHERE b > 9900 UNION SELECT g.b, g.y FROM r JOIN g ON g.a = r.entity AND g.x = r.id)
SELECT entity, id FROM r""")
def export_closed_sample(spark, sf_dir):
    """Two keys to one table, a table that refers to itself, and a cycle (#19)."""
    tables = _circles(spark, sf_dir)
    found = [("people", "boss", "people", "c_custkey"), ("orders", "o_custkey", "people", "c_custkey"), ("orders", "payer", "people", "c_custkey"), ("people", "first_order", "orders", "o_orderkey")]
    keys = {"people": "c_custkey", "orders": "o_orderkey"}
    got = closure.connected(tables, keys, found, {"people": tables["people"].where("c_acctbal > 9900")})
    return got["people"].select(F.lit("people").alias("entity"), F.col("c_custkey").alias("id")).unionByName(got["orders"].select(F.lit("orders").alias("entity"), F.col("o_orderkey").alias("id")))


# ---- integrity (#52-#54)


@query("SELECT doc_id::VARCHAR AS fk_value, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AND doc_id IS NOT NULL GROUP BY ALL")
def dangling_refs(spark, sf_dir):
    return integrity.dangling(_t(spark, sf_dir, "documents"), "doc_id", [(_t(spark, sf_dir, "labels"), "doc_id")])


@query("SELECT o_custkey::VARCHAR AS fk_value, count(*) AS n FROM orders WHERE o_custkey % 3 <> 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY ALL")
def dangling_null_fk(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select(F.when(F.expr("o_custkey % 3 <> 0"), F.col("o_custkey")).alias("o_custkey"))
    return integrity.dangling(orders, "o_custkey", [(_t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'"), "c_custkey")])


@query("""SELECT o_custkey::VARCHAR AS fk_value, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_custkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY ALL""")
def dangling_polymorphic(spark, sf_dir):
    return integrity.dangling(_t(spark, sf_dir, "orders"), "o_custkey", [(_t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'"), "c_custkey"), (_t(spark, sf_dir, "supplier"), "s_suppkey")])


@query("SELECT o_custkey::VARCHAR AS fk_value, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY ALL")
def dangling_followed_up(spark, sf_dir):
    """What dangles after two batches of orders and customers, of which the second was checked by itself."""
    store = _new_store(spark)
    for turn in (0, 1):
        for name, key, rows in (("orders", "o_orderkey", _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")), ("customer", "c_custkey", _t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey"))):
            first = int(store.note(name) or 1)
            new = rows.where(f"{key} % 2 = {turn}")
            store.commit(name, append={"open": scd2.with_row_ids(new, first, [key])}, note=str(first + new.count()), base=store.number(name), key=key)
        workflow.verify_changes(store, [("orders", "o_custkey", "customer", "c_custkey")])
    return store.read(workflow.DANGLING, "all").select("fk_value", "n")


@query("""WITH b AS (SELECT o_custkey::VARCHAR AS v, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY ALL)
SELECT 'orders' AS src_table, 'o_custkey' AS fk_col, 'customer' AS dst_table, (SELECT sum(n) FROM b)::BIGINT AS dangling_count, (SELECT count(o_custkey) FROM orders) AS total_checked,
(SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT v FROM b ORDER BY v LIMIT 10)) AS samples""")
def dangling_report(spark, sf_dir):
    tables = {"orders": _t(spark, sf_dir, "orders"), "nation": _t(spark, sf_dir, "nation"), "customer": _t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")}
    found, _, _ = integrity.report(tables, [e for e in EDGES if e[0] in ("customer", "orders")])
    return found.withColumn("samples", F.array_join("samples", ","))


# ---- metadata and schema differences (#20-#22)


_EDM_ROWS = [(e, n, o) for e in ("Edm.String", "Edm.Int16", "Edm.Int32", "Edm.Int64", "Edm.Decimal", "Edm.Double", "Edm.Boolean", "Edm.DateTimeOffset", "Edm.Date", "Edm.TimeOfDay", "Edm.Guid", "Edm.Binary", "Edm.Unknown") for n in (0, 160) for o in (False, True)]
_VALUES = ", ".join(f"('{e}', {n}, {o})" for e, n, o in _EDM_ROWS)


# the expected types are written out here, not taken from the table under test
@query(f"""WITH v(edm_type, max_length, is_option_set) AS (VALUES {_VALUES}),
k(edm_type, s, p) AS (VALUES ('Edm.Int16', 'INTEGER', 'SMALLINT'), ('Edm.Int32', 'INTEGER', 'INTEGER'), ('Edm.Int64', 'INTEGER', 'BIGINT'), ('Edm.Boolean', 'INTEGER', 'BOOLEAN'),
  ('Edm.Decimal', 'REAL', 'NUMERIC'), ('Edm.Double', 'REAL', 'DOUBLE PRECISION'), ('Edm.Binary', 'BLOB', 'BYTEA'), ('Edm.Guid', 'TEXT', 'UUID'),
  ('Edm.Date', 'TEXT', 'DATE'), ('Edm.TimeOfDay', 'TEXT', 'TIME'), ('Edm.DateTimeOffset', 'TEXT', 'TIMESTAMP WITH TIME ZONE'))
SELECT edm_type, max_length::INT AS max_length, is_option_set, CASE WHEN is_option_set AND edm_type = 'Edm.String' THEN 'INTEGER' ELSE coalesce(s, 'TEXT') END AS sqlite_type,
CASE WHEN is_option_set AND edm_type = 'Edm.String' THEN 'INTEGER' WHEN edm_type = 'Edm.String' AND max_length > 0 THEN 'VARCHAR(' || max_length || ')' ELSE coalesce(p, 'TEXT') END AS postgresql_type
FROM v LEFT JOIN k USING (edm_type)""")
def edm_type_map(spark, sf_dir):
    rows = spark.createDataFrame(_EDM_ROWS, "edm_type string, max_length int, is_option_set boolean")
    args = F.col("edm_type"), F.col("max_length"), F.col("is_option_set")
    return rows.select("*", types_map.db_type_col(*args, "sqlite").alias("sqlite_type"), types_map.db_type_col(*args, "postgresql").alias("postgresql_type"))


_NAMES = ["varchar(100)", " INT ", "Double", "numeric(10,2)", "CHARACTER VARYING", "int4", "BOOL", "timestamptz", "FLOAT8", "TEXT", "bigint", "blob", "odd"]


@query("""SELECT * FROM (VALUES ('varchar(100)', 'TEXT', 'TEXT'), (' INT ', 'INTEGER', 'INTEGER'), ('Double', 'REAL', 'DOUBLE'), ('numeric(10,2)', 'REAL', 'NUMERIC'), ('CHARACTER VARYING', 'CHARACTER VARYING', 'TEXT'),
('int4', 'INT4', 'INTEGER'), ('BOOL', 'BOOL', 'BOOLEAN'), ('timestamptz', 'TIMESTAMPTZ', 'TIMESTAMP WITH TIME ZONE'), ('FLOAT8', 'FLOAT8', 'DOUBLE PRECISION'), ('TEXT', 'TEXT', 'TEXT'), ('bigint', 'INTEGER', 'BIGINT'), ('blob', 'BLOB', 'BLOB'), ('odd', 'ODD', 'ODD')) v(name, sqlite_type, postgresql_type)""")
def type_normalize(spark, sf_dir):
    rows = spark.createDataFrame([(n,) for n in _NAMES], "name string")
    return rows.select("name", types_map.normal_type_col(F.col("name")).alias("sqlite_type"), types_map.normal_type_col(F.col("name"), "postgresql").alias("postgresql_type"))


_COLS = [("buyer", "buyerid", "buyerid"), ("buyer", "_agent_value", "buyerid"), ("buyer", "_Land_Value", "buyerid"), ("buyer", "shopid", "buyerid"), ("buyer", "versionnumber", "buyerid"), ("buyer", "title", "buyerid"), ("link", "buyerid", None), ("link", "_parent_value", None)]
_COL_VALUES = ", ".join(f"('{e}', '{c}', {repr(k) if k else 'NULL'})" for e, c, k in _COLS)


@query(f"""WITH v(entity, col, pk) AS (VALUES {_COL_VALUES}), f AS (SELECT *, lower(col) LIKE '\\_%\\_value' ESCAPE '\\' AS look FROM v),
i AS (SELECT entity, col, CASE WHEN look THEN substr(col, 2, length(col) - 7) ELSE substr(col, 1, length(col) - 2) END AS base, look FROM f
  WHERE (look OR (lower(col) LIKE '%id' AND col IS DISTINCT FROM pk AND col <> 'versionnumber')) AND NOT (entity = 'link' AND col = '_parent_value'))
SELECT entity, col AS "column", base AS referenced_table, CASE WHEN look THEN base || 'id' ELSE col END AS referenced_column FROM i UNION ALL SELECT 'link', '_parent_value', 'buyer', 'buyerid'""")
def fk_infer(spark, sf_dir):
    columns = spark.createDataFrame(_COLS, "entity string, column string, primary_key string")
    known = spark.createDataFrame([("link", "_parent_value", "buyer", "buyerid")], "entity string, column string, referenced_table string, referenced_column string")
    return metadata.inferred_keys(columns, known)


_EXPECTED = [("orders", "o_orderkey", "BIGINT", False), ("orders", "O_CUSTKEY", "INTEGER", True), ("orders", "o_total", "REAL", True), ("orders", "o_orderstatus", "INTEGER", True), ("orders", "o_orderpriority", "TEXT", False), ("widget", "widgetid", "TEXT", True)]
_EXPECTED_VALUES = ", ".join(f"('{e}', '{c}', '{t}', {n})" for e, c, t, n in _EXPECTED)
_ACTUAL_VALUES = "('orders', 'o_orderkey', 'bigint', TRUE), ('orders', 'o_custkey', 'bigint', TRUE), ('orders', 'o_orderstatus', 'string', TRUE), ('orders', 'o_totalprice', 'double', TRUE), ('orders', 'o_orderdate', 'timestamp_ntz', TRUE), ('orders', 'o_orderpriority', 'string', TRUE), ('nation', 'n_nationkey', 'int', TRUE)"
_DIFF = f"""e(entity, c, t, n) AS (VALUES {_EXPECTED_VALUES}), a(entity, c, t, n) AS (VALUES {_ACTUAL_VALUES}),
k AS (SELECT entity, lower(c) AS c, CASE WHEN t = 'BIGINT' THEN 'INTEGER' ELSE t END AS t, n FROM e),
x AS (SELECT entity, lower(c) AS c, CASE WHEN t IN ('bigint', 'int') THEN 'INTEGER' WHEN t = 'double' THEN 'REAL' ELSE upper(t) END AS t, n FROM a),
i AS (SELECT entity, 'missing_table' AS issue_type, 'info' AS severity, NULL AS name FROM (SELECT entity FROM k EXCEPT SELECT entity FROM x)
UNION ALL SELECT entity, 'extra_table', 'warning', NULL FROM (SELECT entity FROM x EXCEPT SELECT entity FROM k)
UNION ALL SELECT k.entity, 'missing_column', 'info', k.c FROM k LEFT JOIN x USING (entity, c) WHERE x.t IS NULL AND k.entity IN (SELECT entity FROM x)
UNION ALL SELECT x.entity, 'extra_column', 'warning', x.c FROM x LEFT JOIN k USING (entity, c) WHERE k.t IS NULL AND x.entity IN (SELECT entity FROM k)
UNION ALL SELECT k.entity, 'type_mismatch', 'error', k.c FROM k JOIN x USING (entity, c) WHERE k.t <> x.t
UNION ALL SELECT k.entity, 'nullable_mismatch', 'warning', k.c FROM k JOIN x USING (entity, c) WHERE k.n <> x.n)"""


def _differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = spark.createDataFrame(_EXPECTED, "entity string, column string, db_type string, nullable boolean")
    actual = [("orders", f.name, f.dataType.simpleString(), f.nullable) for f in _t(spark, sf_dir, "orders").schema.fields] + [("nation", "n_nationkey", "int", True)]
    found = spark.createDataFrame(actual, expected.schema)
    return schema_diff.table_differences(expected, found).unionByName(schema_diff.column_differences(expected, found))


@query(f"WITH {_DIFF} SELECT * FROM i")
def schema_differences(spark, sf_dir):
    return _differences(spark, sf_dir).select("entity", "issue_type", "severity", F.lower(F.try_element_at("details", F.lit("column_name"))).alias("name"))


@query(f"WITH {_DIFF} SELECT severity, issue_type, count(*) AS n FROM i GROUP BY ALL")
def schema_differences_summary(spark, sf_dir):
    return schema_diff.summary(_differences(spark, sf_dir))


@query("""WITH e(entity, k) AS (VALUES ('customer', 'custid'), ('nation', 'N_NATIONKEY'), ('region', NULL)), a(entity, k) AS (VALUES ('customer', 'c_custkey'), ('nation', 'n_nationkey'), ('region', 'r_regionkey'))
SELECT entity, 'pk_mismatch' AS issue_type, 'error' AS severity, e.k AS expected_pk, a.k AS actual_pk FROM e JOIN a USING (entity) WHERE lower(e.k) IS DISTINCT FROM lower(a.k)""")
def schema_key_differences(spark, sf_dir):
    kind = "entity string, primary_key string"
    expected = spark.createDataFrame([("customer", "custid"), ("nation", "N_NATIONKEY"), ("region", None)], kind)
    actual = spark.createDataFrame([("customer", "c_custkey"), ("nation", "n_nationkey"), ("region", "r_regionkey")], kind)
    found = schema_diff.key_differences(expected, actual)
    return found.select("entity", "issue_type", "severity", F.try_element_at("details", F.lit("expected_pk")).alias("expected_pk"), F.try_element_at("details", F.lit("actual_pk")).alias("actual_pk"))


@query("""WITH e(c, t, n) AS (VALUES ('o_custkey', 'customer.c_custkey', 0), ('o_clerk', 'x.xid', 0), ('O_CLERK', 'clerk.clerkid', 1), ('o_same', 'Region.R_ID', 2)), a(c, t, n) AS (VALUES ('o_clerk', 'supplier.s_suppkey', 0), ('o_same', 'region.r_id', 1), ('o_old', 'part.p_partkey', 2)),
x AS (SELECT lower(c) AS name, lower(arg_max(t, n)) AS t FROM e GROUP BY 1), y AS (SELECT lower(c) AS name, lower(arg_max(t, n)) AS t FROM a GROUP BY 1)
SELECT CASE WHEN y.t IS NULL THEN 'fk_missing' WHEN x.t IS NULL THEN 'fk_extra' ELSE 'fk_mismatch' END AS issue_type, CASE WHEN x.t IS NOT NULL AND y.t IS NOT NULL THEN 'warning' ELSE 'info' END AS severity, name FROM x FULL JOIN y USING (name) WHERE x.t IS DISTINCT FROM y.t""")
def schema_reference_differences(spark, sf_dir):
    kind = "entity string, column string, referenced_table string, referenced_column string, seq int"
    expected = spark.createDataFrame([("orders", "o_custkey", "customer", "c_custkey", 0), ("orders", "o_clerk", "x", "xid", 0), ("orders", "O_CLERK", "clerk", "clerkid", 1), ("orders", "o_same", "Region", "R_ID", 2)], kind)
    actual = spark.createDataFrame([("orders", "o_clerk", "supplier", "s_suppkey", 0), ("orders", "o_same", "region", "r_id", 1), ("orders", "o_old", "part", "p_partkey", 2)], kind)
    return schema_diff.reference_differences(expected, actual).select("issue_type", "severity", F.lower(F.try_element_at("details", F.lit("column"))).alias("name"))


@query("""WITH c(entity, col, is_int) AS (SELECT table_name, column_name, data_type = 'BIGINT' FROM information_schema.columns WHERE table_name IN ('customer', 'orders'))
SELECT entity, string_agg(col, ',' ORDER BY col) AS fields FROM c WHERE is_int AND col IN ('c_custkey', 'o_custkey', 'o_orderkey', 'o_orderstatus') GROUP BY entity""")
def optionset_config(spark, sf_dir):
    columns = [(n, f.name, "INTEGER" if f.dataType.simpleString() == "bigint" else "TEXT") for n in ("customer", "orders") for f in _t(spark, sf_dir, n).schema.fields]
    lookups = spark.createDataFrame([("c_custkey",), ("o_custkey",), ("o_orderkey",), ("o_orderstatus",)], "field string")
    found = schema_diff.option_set_config(lookups, spark.createDataFrame(columns, "entity string, column string, db_type string"))
    return found.withColumn("fields", F.array_join("fields", ","))


# ---- state and log (#56-#59), counts (#6)

_COUNTED = ("region", "nation", "customer", "orders")


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for n in _COUNTED:
        row = _t(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("records_count")).select(F.lit(n).alias("entity_name"), "records_count")
        out = row if out is None else out.unionByName(row)
    return out


@query(" UNION ALL ".join(f"SELECT '{n}' AS entity_name, count(*) AS records_count FROM {n}" for n in _COUNTED))
def entity_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(" UNION ALL ".join(f"SELECT '{n}' AS entity_name, '{'failed' if n == 'nation' else 'completed'}' AS state, '2024-06-02' AS last_sync_time, '2024-06-01' AS last_timestamp, count(*) AS records_count FROM {n}" for n in _COUNTED))
def sync_state(spark, sf_dir):
    done = _counts(spark, sf_dir).select("entity_name", F.lit("completed").alias("state"), F.lit("2024-06-01").alias("last_sync_time"), F.lit("2024-06-01").alias("last_timestamp"), "records_count")
    now = state.set_state(state.empty_state(spark), done)
    again = done.select("entity_name", F.when(F.col("entity_name") == "nation", "failed").otherwise("completed").alias("state"), F.lit("2024-06-02").alias("last_sync_time"), F.lit(None).cast("string").alias("last_timestamp"), F.lit(None).cast("long").alias("records_count"))
    return state.set_state(now, again)


@query(" UNION ALL ".join(f"SELECT '{n}-1' AS id, '{n}' AS entity_name, '2024-06-01T00:00' AS start_time, '2024-06-01T00:05' AS end_time, count(*) AS records_added, 0::BIGINT AS records_updated, 'completed' AS status, NULL::VARCHAR AS error_message FROM {n}" for n in _COUNTED))
def sync_log(spark, sf_dir):
    made = _counts(spark, sf_dir)
    run = F.concat("entity_name", F.lit("-1")).alias("id")
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("long")
    begun = made.select(run, "entity_name", F.lit("2024-06-01T00:00").alias("start_time"), none.alias("end_time"), zero.alias("records_added"), zero.alias("records_updated"), F.lit("in_progress").alias("status"), none.alias("error_message"))
    ended = made.select(run, "entity_name", F.lit("2024-06-01T00:00").alias("start_time"), F.lit("2024-06-01T00:05").alias("end_time"), F.col("records_count").alias("records_added"), zero.alias("records_updated"), F.lit("completed").alias("status"), none.alias("error_message"))
    return state.latest_log(state.empty_log(spark).unionByName(begun).unionByName(ended))
