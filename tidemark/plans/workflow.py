"""The whole sync: validate, create, load, close over references, verify (#45, #49, #60, #61, #65, #66).

A source gives the metadata document and, for an entity, its raw records in arrival order.  The store
holds for each entity its historised table, for each coded field its lookup, for each multi-select its
junction, the state and the log.  A failing entity does not stop the others.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types_map import spark_type
from ..model import EntityConfig, TableSchema, local_frame
from ..operators import canonical, closure, incremental, integrity, optionsets, schema_diff, scd2, state
from ..sources import metadata
from ..sources.catalog import store_schemas
from ..sources.config import load_entities, load_option_sets
from ..sources.odata import Authenticator, client_of, register
from ..sources.store import WHERE, Store, Transaction, checkpointed, entity_schema

STATE, LOG, LOOKUPS, DANGLING = "_sync_state", "_sync_log", "_optionset", "_dangling"
#: Requests to a service at a time.
CONCURRENCY = 50
#: Characters of the names of columns in a request.
LONGEST_SELECT = 4000
#: Entities that are loaded at a time.
AT_ONCE = 4
#: The part of a junction with the entities that had a multi-select once and have no code now.
BLANK = "_blank"
#: The part of a table with the times at which a version was met again, kept where versions follow their own times.
SAME = "_same"
log = logging.getLogger(__name__)


class Source(Protocol):
    def metadata(self) -> str: ...

    def scan(self, entity: str, order: str | None, since: str | None) -> DataFrame:
        """seq, raw of the entity's records, those after `since` if given."""

    def by_ids(self, entity: str, key: str, new: DataFrame, existing: DataFrame, since: str | None) -> DataFrame:
        """seq, raw of the records with these ids: all new ones, existing ones if after `since`."""


class RawSource:
    """A source over raw records that Spark holds: {entity: DataFrame(seq, raw)}."""

    def __init__(self, document: str, records: Mapping[str, DataFrame]) -> None:
        self.document, self.records = document, dict(records)

    def metadata(self) -> str:
        return self.document

    def scan(self, entity: str, order: str | None, since: str | None) -> DataFrame:
        rows = self.records[entity]
        modified = F.get_json_object("raw", "$.modifiedon")
        return rows if since is None else rows.where(modified > F.lit(since))

    def by_ids(self, entity: str, key: str, new: DataFrame, existing: DataFrame, since: str | None) -> DataFrame:
        rows = self.records[entity].withColumn("_id", F.get_json_object("raw", f"$['{key}']"))
        fresh = rows.join(new, rows["_id"] == new["id"], "left_semi")
        old = rows if since is None else rows.where(F.get_json_object("raw", "$.modifiedon") > F.lit(since))
        return fresh.unionByName(old.join(existing, old["_id"] == existing["id"], "left_semi")).drop("_id")


class ODataRecords:
    """A source over an OData service; ids go out in requests of a bounded number, at most `concurrency` at a time.

    token: an Authenticator, with which the tasks renew their tokens themselves, or a function that gives a token.
    """

    def __init__(self, spark: SparkSession, url: str, token: Authenticator | Callable[[], str], concurrency: int = CONCURRENCY) -> None:
        self.spark, self.url, self.token, self.concurrency = spark, url, token, concurrency
        self.columns: dict[str, str] = {}
        self.timed: set[str] = set()
        register(spark)

    def _options(self, entity: str, **more: str | None) -> dict[str, str]:
        if isinstance(self.token, Authenticator):
            t = self.token
            own = {"token": t.get_token(), "expiry": repr(t.expiry), "tenant": t.tenant, "client_id": t.client_id, "client_secret": t.client_secret, "scope": t.scope}
        else:
            own = {"token": self.token()}
        return {k: v for k, v in {"url": self.url, "entity": entity, **own, **more}.items() if v}

    def narrow(self, columns: Mapping[str, Iterable[str]]) -> None:
        """From now on requests name these columns of an entity, unless that makes too long an address; what annotates a column comes with it."""
        told = {e: ",".join(c) for e, c in columns.items()}
        self.timed = {e for e, c in told.items() if "modifiedon" in c.split(",")}
        self.columns = {e: c for e, c in told.items() if len(c) <= LONGEST_SELECT}

    def metadata(self) -> str:
        return client_of(self._options("")).metadata()

    def scan(self, entity: str, order: str | None, since: str | None) -> DataFrame:
        # several entities are read at a time, so each has its part of the requests
        cut = {"ranges": str(self.concurrency // AT_ONCE)} if entity in self.timed and self.concurrency >= 2 * AT_ONCE else {}
        told = self._options(entity, orderby=order, pushdown="true", select=self.columns.get(entity), **cut)
        rows = self.spark.read.format("odata").options(**told).load()
        return (rows if since is None else rows.where(F.col("modifiedon") > F.lit(since))).select("seq", "raw")

    def by_ids(self, entity: str, key: str, new: DataFrame, existing: DataFrame, since: str | None) -> DataFrame:
        options, size, select = self._options(entity), incremental.IDS_A_REQUEST, self.columns.get(entity)

        def run(batches):
            import pyarrow as pa
            from pyspark import TaskContext

            client = client_of(options)
            seq = TaskContext.get().partitionId() << 40  # no two records have one number
            for batch in batches:
                ids, known = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                asked = incremental.id_filters(key, [i for i, k in zip(ids, known, strict=True) if not k], None, size)
                asked += incremental.id_filters(key, [i for i, k in zip(ids, known, strict=True) if k], since, size)
                for f in asked:
                    for page in client.pages(entity, filter=f, select=select):
                        yield pa.RecordBatch.from_pydict({"seq": pa.array(range(seq, seq + len(page)), pa.int64()), "raw": pa.array([json.dumps(r) for r in page], pa.string())})
                        seq += len(page)

        ids = new.select("id", F.lit(False).alias("known")).unionByName(existing.select("id", F.lit(True).alias("known")))
        # few tasks, each with one request open at a time
        return ids.repartition(self.concurrency, "id").mapInArrow(run, "seq long, raw string")


def _now() -> str:
    return datetime.now(timezone.utc).isoformat().replace("+00:00", "Z")


def _mark(tx: Transaction, rows: list[tuple]) -> None:
    """Merges (entity, state, clock, mark, count) rows into the state, which other syncs may write meanwhile."""
    spark, store = tx.store.spark, tx.store

    def write() -> None:
        base = store.number(STATE)
        now = store.read(STATE) if base else state.empty_state(spark)
        tx.commit(STATE, {"all": state.set_state(now, local_frame(spark, rows, state.STATE)).coalesce(1)}, base=base)

    tx.stage(STATE, write)


def _append_log(tx: Transaction, rows: list[tuple]) -> None:
    tx.commit(LOG, append={"all": local_frame(tx.store.spark, rows, state.LOG).coalesce(1)})


def watermark_of(store: Store, entity: str) -> str | None:
    if not store.exists(STATE):
        return None
    row = state.get_state(store.read(STATE), entity).select("last_timestamp").first()
    return row[0] if row else None


def load_batch(store: Store, entity: EntityConfig, schema: TableSchema, records: DataFrame, clock: str, option_fields: Iterable[str] = (), mode: str = "fixed", into: Transaction | None = None, in_time: bool = False) -> tuple[int, int, str | None, int]:
    """Applies raw records (seq, raw) to the entity's table, lookups and junctions: (added, updated, largest modifiedon, records).

    All of it is one transaction (`into`, if given, which the caller publishes): either the table, its lookups and its junctions
    have the batch or none has.  Read are the open versions of the batch's keys; written are these and what the batch made, so
    neither history nor other keys are written again.  The table's note holds the next row id.  in_time: versions follow one another by their own
    times, so that a late record is put where it belongs; the closed versions of the batch's keys are then read and written, too.
    """
    spark, table = store.spark, entity.api_name
    tx = into or store.transaction()
    # dealt out, as a source may give all in one task (a small file of few row groups, an entity without ranges) and what follows is the sync's main work
    records = checkpointed(records.select("seq", "raw").repartition("seq"))
    mark = incremental.watermark(records.select(F.get_json_object("raw", "$.modifiedon").alias("modifiedon"))).first()
    if not mark["records_count"]:
        return 0, 0, None, 0
    key = incremental.resolve_key(schema, entity.name)
    options = frozenset(option_fields)
    types: dict[str, T.DataType] = {c.name: spark_type(c.edm_type, c.name in options) for c in schema.columns}
    found = checkpointed(optionsets.detect(records.withColumn("_id", F.get_json_object("raw", f"$['{key}']")).where(canonical.has_key(F.col("_id"))), ids=["seq", "_id"]))
    multi = tuple(r[0] for r in found.where("is_multi").select("field").distinct().collect())  # names of columns
    known = [t.removeprefix(f"_junction_{table}_") for t in store.tables() if t.startswith(f"_junction_{table}_")]
    multi = tuple(dict.fromkeys([*multi, *known]))
    versions = canonical.to_versions(records, key, {k: v for k, v in types.items() if k not in multi}, clock)
    full = versions.select(*[F.col(c.name) if c.name not in multi else F.lit(None).cast(types[c.name]).alias(c.name) for c in schema.columns], "json_response", "sync_time", "valid_from", "seq")
    base = store.number(table)
    plain = [c for c in full.columns if c != "seq"]
    batch = full.select(F.lit(None).cast("long").alias("row_id"), *plain, F.lit(None).cast("string").alias(WHERE[0]), F.lit(None).cast("long").alias(WHERE[1]), "seq")
    known: dict[str, DataFrame] = {}
    if base:
        known = {part: store.read(table, part, keys=full.select(key), places=True) for part in (("open", "closed", SAME) if in_time else ("open",))}
    before = batch.limit(0).select("row_id", *plain, *WHERE)
    for rows in known.values():
        before = before.unionByName(rows.select("row_id", *plain, *WHERE))
    if in_time:
        spliced = checkpointed(scd2.splice(before, batch, key, keep_seq=True))
        done, same = spliced.where("is_version"), spliced.where("not is_version")
    else:
        done, same = checkpointed(scd2.apply(before, batch, key, keep_seq=True)), None
    first = int(store.note(table) or 1) if base else 1
    keep = ["row_id", *plain, "valid_to"]
    made = scd2.with_row_ids(done.where("row_id is null").drop("row_id"), first, [key, "seq"])
    all_rows = checkpointed(made.select(*keep).unionByName(done.where("row_id is not null").select(*keep)))
    added, updated = scd2.counts(done).first()
    parts = {"open": all_rows.where("valid_to is null"), "closed": all_rows.where("valid_to is not null")} | ({SAME: same.select(*keep)} if in_time else {})
    tx.commit(table, append=parts, note=str(first + added + updated), base=base, drop=known, key=key)

    seen = found.select("field", "code", "label", F.lit(clock).alias("seen_at"), "seq")
    tx.stage(LOOKUPS, lambda: _add_labels(tx, seen, clock))
    if added + updated:
        if in_time and multi:
            versions = all_rows.select(F.col(key).cast("string").alias("id"), F.col("valid_from").alias("seq"), "valid_from", F.col("json_response").alias("raw"))
            picked = checkpointed(optionsets.detect(versions.select("id", "seq", "raw"), ids=["id", "seq"], fields=multi))
        new = done.where("version_created").select(F.col(key).cast("string").alias("id"), "seq", "valid_from")
        for field in multi:
            if in_time:
                _set_links(tx, f"_junction_{table}_{field}", versions.drop("raw"), picked.where(F.col("field") == field).drop("field"), mode)
                continue
            picks = found.where(F.col("field") == field).select(F.col("_id").alias("id"), "seq", "code", "is_multi")
            _add_links(tx, f"_junction_{table}_{field}", new, picks, mode)
    if into is None:
        tx.publish()
    return added, updated, mark["last_timestamp"], mark["records_count"]


def _add_labels(tx: Transaction, seen: DataFrame, clock: str) -> None:
    """Merges seen labels into the lookups, which are written only if that changes them."""
    store = tx.store
    base = store.number(LOOKUPS)
    old = store.read(LOOKUPS) if base else seen.select("field", "code", "label", F.col("seen_at").alias("first_seen")).limit(0)
    if base and seen.join(old.where(F.col("first_seen") <= F.lit(clock)), ["field", "code", "label"], "left_anti").isEmpty():
        return  # all of it is there
    merged = checkpointed(optionsets.merge_lookup(old, seen))
    if not merged.exceptAll(old.select(*merged.columns)).isEmpty():
        tx.commit(LOOKUPS, {"all": merged.coalesce(1)}, base=base)


def _add_links(tx: Transaction, name: str, versions: DataFrame, picks: DataFrame, mode: str) -> None:
    """The batch on a junction: read and written are the links of its entities."""
    store = tx.store
    base = store.number(name)
    none = local_frame(store.spark, [], "entity_id string, option_code long, valid_from string, valid_to string, _file string, _place long")
    own = versions.select("id")
    opened = store.read(name, "open", keys=own, places=True) if base else none
    blank = store.read(name, BLANK, keys=own, places=True) if base else none
    after, closed, left = optionsets.junction_batch(opened.drop(*WHERE), blank.select("entity_id"), versions, picks, "id", mode)
    tx.commit(name, append={"open": after, "closed": closed, BLANK: left}, base=base, drop={"open": opened, BLANK: blank} if base else None, key="entity_id")


def _set_links(tx: Transaction, name: str, versions: DataFrame, picks: DataFrame, mode: str) -> None:
    """All links of these entities anew, from all their versions."""
    base = tx.store.number(name)
    rows = checkpointed(optionsets.junction(versions, picks, "id", "", mode))
    opened = rows.where("valid_to is null")
    blank = picks.where("is_multi").select(F.col("id").alias("entity_id")).distinct().join(opened, "entity_id", "left_anti")
    old = {part: tx.store.read(name, part, keys=versions.select("id"), places=True) for part in ("open", "closed", BLANK)} if base else None
    tx.commit(name, append={"open": opened, "closed": rows.where("valid_to is not null"), BLANK: blank}, base=base, drop=old, key="entity_id")


def maintain(store: Store, tables: Iterable[str]) -> None:
    """Joins and rewrites what has become costly to read. Another writer, or a failure, only puts it off."""
    for table in tables:
        for part in ("open", "closed", BLANK, SAME, "all"):
            try:
                store.compact(table, part)
            except Exception:
                log.exception("%s of %s was not compacted", part, table)


def _sync_one(store: Store, entity: EntityConfig, run: str, begun: str, load: Callable[[Transaction], tuple[int, int, str | None, int]]) -> tuple[int, int]:
    """The batch, its state and its log, published together."""
    try:
        tx = store.transaction()
        added, updated, mark, count = load(tx)
        _mark(tx, [(entity.api_name, state.COMPLETED, _now(), mark, count)])
        _append_log(tx, [(run, entity.api_name, begun, _now(), added, updated, state.COMPLETED, None)])
        tx.publish()
    except Exception as e:
        tx = store.transaction()
        _mark(tx, [(entity.api_name, state.FAILED, _now(), None, None)])
        _append_log(tx, [(run, entity.api_name, begun, _now(), 0, 0, state.FAILED, str(e)[:2000])])
        tx.publish()
        raise
    return added, updated


def _begin(store: Store, entities: list[EntityConfig]) -> tuple[str, dict[str, str]]:
    """Marks entities as begun, in one commit: (when, {entity: run id})."""
    begun, runs = _now(), {e.api_name: uuid.uuid4().hex for e in entities}
    if entities:
        tx = store.transaction()
        _mark(tx, [(e, state.IN_PROGRESS, begun, None, None) for e in runs])
        _append_log(tx, [(r, e, begun, None, 0, 0, state.IN_PROGRESS, None) for e, r in runs.items()])
        tx.publish()
    return begun, runs


def new_references(store: Store, found: list[tuple[str, str, str, str]], table: str, read: dict[tuple[str, str], int]) -> DataFrame | None:
    """id: what refers to the table in rows that came since the last call; `read` holds the number up to which each referring table has been read."""
    fresh = {}
    for source, _ in closure.referencing(found, table):
        number, before = store.number(source), read.get((table, source), 0)
        if number > before:
            fresh[source] = store.read(source, since=before)
            read[table, source] = number
    return closure.referenced_ids(fresh, found, table)


def verify_changes(store: Store, edges: list[tuple[str, str, str, str]]) -> list[dict]:
    """The rows of integrity.report, from what dangled when this was last called and the versions that came since; the first call, and one with other edges, reads all.

    The table of what dangles notes up to which commit and row id each table has been read. Versions must stay, so this is not for tables that are kept `in_time`.
    """
    spark, base = store.spark, store.number(DANGLING)
    groups = {n: g for n, g in integrity.grouped(edges).items() if all(store.exists(t) for e in g for t in (e[0], e[2]))}
    noted = json.loads(store.note(DANGLING) or "{}") if base else {}
    again = noted.get("edges") == [list(e) for g in groups.values() for e in g]
    seen = noted["tables"] if again else {}
    now = {t: [store.number(t), int(store.note(t) or 1)] for g in groups.values() for e in g for t in (e[0], e[2])}
    fresh = {t: store.read(t, since=seen.get(t, [0, 1])[0]).where(F.col("row_id") >= seen.get(t, [0, 1])[1]) for t, n in now.items() if n[0] > seen.get(t, [0, 1])[0]}
    if again and not fresh:
        return integrity.told(store.read(DANGLING, "all"), store.read(DANGLING, "_totals"), groups)
    counted, valued = "edge string, fk_value string, n long", "edge string, fk_value string"
    values = lambda rows, edge, column: rows.where(F.col(column).isNotNull()).select(F.lit(edge).alias("edge"), F.col(column).cast("string").alias("fk_value"))
    references, keys, held = local_frame(spark, [], counted), local_frame(spark, [], valued), local_frame(spark, [], valued)
    for name, group in groups.items():
        if group[0][0] in fresh:
            references = references.unionByName(values(fresh[group[0][0]], name, group[0][1]).groupBy("edge", "fk_value").agg(F.count(F.lit(1)).alias("n")))
    references = checkpointed(references)
    for name, group in groups.items():
        asked = references.where(F.col("edge") == name).select("fk_value")
        for _, _, target, key in group:
            if target in fresh:
                keys = keys.unionByName(values(fresh[target], name, key))
            # by the target's index, where it is indexed by this column
            rows = store.read(target, keys=asked) if store.state(target).key == key else store.read(target).join(asked.select(F.col("fk_value").alias("_v")).distinct(), F.col(key).cast("string") == F.col("_v"), "left_semi")
            held = held.unionByName(values(rows, name, key))
    old = store.read(DANGLING, "all") if again else local_frame(spark, [], counted)
    sums = store.read(DANGLING, "_totals") if again else local_frame(spark, [], "edge string, n long")
    after = checkpointed(integrity.followed_up(old, references, keys, held))
    totals = checkpointed(sums.unionByName(references.groupBy("edge").agg(F.sum("n").alias("n"))).groupBy("edge").agg(F.sum("n").alias("n")))
    note = json.dumps({"edges": [e for g in groups.values() for e in g], "tables": now})
    store.commit(DANGLING, {"all": after, "_totals": totals}, note=note, base=base)
    return integrity.told(after, totals, groups)


def run_workflow(store: Store, source: Source, entities: list[EntityConfig], verify_references: bool | str = False, option_sets: Mapping[str, Iterable[str]] | None = None, rounds: int = closure.ROUNDS, compat: bool = False, clock: str | None = None, in_time: bool = False) -> dict:
    """verify_references: True for all versions of all tables, `changes` for what came since the last time. Result: success, total_added, total_updated, failed_entities, validation_errors, reference_errors, reference_checks."""
    spark = store.spark
    clock = clock or _now()
    options = {k: frozenset(v) for k, v in (option_sets or {}).items()}
    schemas = metadata.parse(source.metadata(), option_sets=options)
    valid, to_create, differences, passed = schema_diff.gate(spark, schemas, store_schemas(store), entities)
    out = {"success": False, "total_added": 0, "total_updated": 0, "failed_entities": [], "validation_errors": [], "reference_errors": [], "reference_checks": 0}
    if not passed:
        out["validation_errors"] = [r.asDict(recursive=True) for r in differences.where("severity = 'error'").collect()]
        return out
    if to_create:
        tx = store.transaction()
        for e in to_create:
            tx.commit(e.api_name, {"open": spark.createDataFrame([], entity_schema(schemas[e.name], options.get(e.name, frozenset())))}, key=incremental.resolve_key(schemas[e.name], e.name, required=False))
        tx.publish()
    if isinstance(source, ODataRecords):
        source.narrow({e.api_name: [c.name for c in schemas[e.name].columns] for e in valid})
    found, dropped = closure.edges(schemas, valid)
    for edge in dropped:
        log.warning("no column %s in %s: the reference to %s is not followed", edge[1], edge[0], edge[2])
    mode = "compat" if compat else "fixed"

    def attempt(entity: EntityConfig, run: str, begun: str, records: Callable[[], DataFrame]) -> bool:
        try:
            added, updated = _sync_one(store, entity, run, begun, lambda tx: load_batch(store, entity, schemas[entity.name], records(), clock, options.get(entity.name, ()), mode, tx, in_time))
        except Exception as e:  # one entity's failure does not stop the others
            log.exception("sync of %s failed", entity.api_name)
            out["failed_entities"].append((entity.api_name, str(e)))
            return False
        out["total_added"] += added
        out["total_updated"] += updated
        return True

    def whole(entity: EntityConfig) -> None:
        schema = schemas[entity.name]
        mark = watermark_of(store, entity.api_name) if schema.has("modifiedon") else None
        attempt(entity, runs[entity.api_name], begun, lambda: source.scan(entity.api_name, incremental.order_column(schema), mark))

    marks = {e.api_name: watermark_of(store, e.api_name) for e in valid if e.filtered}
    begun, runs = _begin(store, [e for e in valid if not e.filtered])
    # independent entities at once: each is a few small jobs that leave the cluster idle in between
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(whole, [e for e in valid if not e.filtered]))

    done: dict[str, DataFrame] = {}
    failed: dict[str, DataFrame] = {}
    read: dict[tuple[str, str], int] = {}
    for turn in range(rounds):
        moved = False
        for entity in (e for e in valid if e.filtered):
            name = entity.api_name
            ids = new_references(store, found, name, read)
            if name in failed:  # they are asked for again
                ids = failed.pop(name) if ids is None else ids.unionByName(failed.pop(name)).distinct()
            if ids is None:
                continue
            if name in done:
                ids = ids.join(done[name], "id", "left_anti")
            ids = checkpointed(ids)
            if ids.isEmpty():
                continue
            moved = True
            schema, mark = schemas[entity.name], marks[name]
            key = incremental.resolve_key(schema, entity.name)
            new, existing = incremental.split_ids(ids, store.read(name), key, mark is not None)
            begun, runs = _begin(store, [entity])
            if not attempt(entity, runs[name], begun, lambda e=entity, k=key, n=new, x=existing, m=mark: source.by_ids(e.api_name, k, n, x, m)):
                failed[name] = ids
                continue
            done[name] = checkpointed(done[name].unionByName(ids)) if name in done else ids
        if not moved:
            break
    else:
        log.warning("references were still being followed after %d rounds", rounds)
    maintain(store, store.tables())

    if verify_references == "changes" and not compat and not in_time:
        out["reference_errors"], out["reference_checks"] = verify_changes(store, found), len(found)
    elif verify_references:
        tables = {t: store.read(t) for t in store.tables() if not t.startswith("_")}
        report, out["reference_checks"], missing = integrity.report(tables, found, compat)
        out["reference_errors"] = [r.asDict() for r in report.collect()] if report is not None else []
        for edge in missing:
            log.warning("cannot verify %s", edge)
    out["success"] = not out["failed_entities"] and not out["reference_errors"]
    return out


def run_sync(spark: SparkSession, root: str, source: Source, entities_config: str, optionsets_config: str | None = None, verify_reference: bool = False, show: Callable[[str], None] = log.info) -> bool:
    """A sync into the store at `root` of the entities that a JSON file lists; `show` gets the report of references, if they are verified."""
    got = run_workflow(Store(spark, root), source, load_entities(entities_config), verify_reference, load_option_sets(optionsets_config))
    if verify_reference and not got["validation_errors"]:
        show(integrity.report_text(got["reference_errors"], got["reference_checks"]))
    for e in got["validation_errors"]:
        log.error("%s: %s", e["entity"], e["description"])
    return got["success"]
