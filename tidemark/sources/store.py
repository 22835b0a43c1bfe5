"""A table store on Parquet: staged folders, one log of commits, an index (#10-#13).

A table is a set of folders, each of a part (open and closed versions, say).  A state file lists a table's folders;
a manifest lists the state files of all tables.  A commit writes new folders, then new state files, and then the manifest of the
next number, through the file system's own interface, which never replaces a file: readers see all tables of a
commit change together or none of them, whatever fails in between.  Of two writers of one table that began at one
number the second is refused; writers of different tables follow one another.

Nothing that may be being read is overwritten.  Rows of a part go by being listed (file and place in it), not
by writing the others again, so a commit costs what the batch costs, not what the table has grown to;
`compact` joins small folders, and writes a part again, in buckets of the key, once half of it is gone.

Each folder has its least and largest key and interval bounds in the state file, small ones also a Bloom filter of the key in
a file beside their data, and folders of a bucket know its number.  read(key=, at=, is_open=) leaves out the folders that cannot hold
such a row before Spark lists them.  Parts whose name starts with `_` are read only by name.
"""

from __future__ import annotations

import atexit
import dataclasses
import json
import re
import shutil
import tempfile
import time
import uuid
import zlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types_map import spark_type
from ..model import TableSchema, local_frame


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the session's shared checkpoint folder (see shared_folder)."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or the context's. Where neither is set, a local session gets a temporary one and a cluster is refused, as its executors share no local folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def entity_schema(schema: TableSchema, option_fields: frozenset[str] = frozenset(), strict: bool = False) -> T.StructType:
    """Surrogate id first, the entity's columns, then the system columns."""
    own = [T.StructField(c.name, spark_type(c.edm_type, c.name in option_fields, strict), c.nullable, {"edm_type": c.edm_type, "max_length": c.max_length}) for c in schema.columns if c.name != "row_id"]
    return T.StructType([T.StructField("row_id", T.LongType(), True), *own, T.StructField("json_response", T.StringType(), False), T.StructField("sync_time", T.StringType(), False), T.StructField("valid_from", T.StringType()), T.StructField("valid_to", T.StringType())])


def create_table_sql(table: str, schema: TableSchema) -> str:
    """The table as DDL, in the same column order."""
    own = [f"  {c.name} {c.db_type}{'' if c.nullable else ' NOT NULL'}" for c in schema.columns]
    last = ["  json_response TEXT NOT NULL", "  sync_time TEXT NOT NULL", "  valid_from TEXT", "  valid_to TEXT"]
    return f"CREATE TABLE IF NOT EXISTS {table} (\n" + ",\n".join(["  row_id INTEGER PRIMARY KEY AUTOINCREMENT", *own, *last]) + "\n)"


#: The folder of manifests, and the file of a folder's Bloom filter.
COMMITS, INDEX = "_commits", "_index"
#: Rows of a folder up to which it has a Bloom filter: two halves of a hash in two bitmaps of 2**15 bits.
BLOOM_ROWS, BITS = 10_000, 15
#: Rows of a bucket, about, when a part is written again, and buckets at most.
BUCKET_ROWS, MOST_BUCKETS = 500_000, 1 << 16
#: Folders of a transaction that are written at a time.
AT_ONCE = 8
#: Rows that are gone are broadcast up to this many.
MOST_GONE = 1_000_000
VALID_FROM, VALID_TO = "valid_from", "valid_to"
#: Where a row is: its file and its place in that.
WHERE = ["_file", "_place"]


class Conflict(RuntimeError):
    """Another writer has committed to the table meanwhile."""


@dataclass(frozen=True)
class Folder:
    """A folder of a part. at: the table's number when it came; low, high: bounds by column; gone: it lists rows of the part that are no more; bucket: its number, of `of`."""

    part: str
    name: str
    at: int = 0
    rows: int | None = None
    gone: bool = False
    low: dict = field(default_factory=dict, compare=False)
    high: dict = field(default_factory=dict, compare=False)
    bloom: bool = False
    bucket: int = 0
    of: int = 1


@dataclass(frozen=True)
class State:
    """What a table consists of. schemas: of each part as it was declared, so that nullability outlives files."""

    number: int = 0
    note: str | None = None
    key: str | None = None
    schemas: dict = field(default_factory=dict)
    folders: tuple[Folder, ...] = ()

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self))

    @classmethod
    def of_json(cls, text: str) -> State:
        told = json.loads(text)
        return cls(**told | {"folders": tuple(Folder(**f) for f in told["folders"])})

    def of_part(self, part: str | None, gone: bool = False) -> list[Folder]:
        return [f for f in self.folders if f.gone == gone and (f.part == part or part is None and not f.part.startswith("_"))]

    def schema(self, part: str | None = None) -> T.StructType | None:
        name = next((p for p in self.schemas if p == part or part is None and not p.startswith("_")), None)
        return T.StructType.fromJson(json.loads(self.schemas[name])) if name is not None else None


def key_hash(key: Column) -> Column:
    """32 bits of a key as text, the same as zlib.crc32 gives."""
    return F.crc32(key.cast("string").cast("binary"))


def _halves(hash_: Column) -> list[Column]:
    return [hash_.bitwiseAND((1 << BITS) - 1), F.shiftright(hash_, BITS).bitwiseAND((1 << BITS) - 1)]


def _places() -> dict[str, Column]:
    # names of files are unique within a folder; a store may be moved as a whole
    return {"_file": F.substring_index("_metadata.file_path", "/", -3), "_place": F.col("_metadata.row_index")}


class Transaction:
    """Changes of several tables that are published together, or not at all."""

    def __init__(self, store: Store) -> None:
        self.store = store
        self.changes: dict[str, list[dict]] = {}
        self.staged: dict[str, Callable[[], None]] = {}
        # folders are small jobs that do not depend on one another
        self.pool = ThreadPoolExecutor(AT_ONCE)

    def commit(self, table: str, replace: dict[str, DataFrame] | None = None, append: dict[str, DataFrame] | None = None, note: str | None = None, base: int | None = None, drop: dict[str, DataFrame] | None = None, key: str | None = None) -> None:
        """Begins to write the folders; publish() waits for them and makes them the table's.

        replace, append: rows by part; drop: rows of a part, as read with `places`, that are no more.  base: the number at which the caller read what it
        writes: if the table has moved on since, publish() raises Conflict.  key: the column by which the table is indexed; it and the note stay until they are changed.
        """
        replace, append, drop = replace or {}, append or {}, drop or {}
        key = key or self.store.state(table).key
        folders = [self.pool.submit(self.store._put, table, part, df, key) for part, df in [*replace.items(), *append.items()]]
        folders += [self.pool.submit(self.store._put, table, part, df.select(*WHERE), None, True) for part, df in drop.items()]
        schemas = {part: df.schema for part, df in [*replace.items(), *append.items()]}
        self.changes.setdefault(table, []).append({"replace": set(replace), "folders": folders, "schemas": schemas, "note": note, "base": base, "key": key})

    def stage(self, table: str, write: Callable[[], None]) -> None:
        """write() commits to the table what follows from its rows as they are; it is called again if the table moves on before publish()."""
        self.staged[table] = write
        write()

    def publish(self) -> None:
        for each in self.changes.values():
            for c in each:
                for f in c["folders"]:
                    f.result()  # a write that failed is raised here, before any table changes
        while self.changes:
            try:
                if self.store._publish({t: self._after(t) for t in self.changes}):
                    return
            except Conflict as e:
                if e.args[0] not in self.staged:
                    raise
                del self.changes[e.args[0]]
                self.staged[e.args[0]]()

    def _after(self, table: str) -> State:
        first = state = self.store.state(table)
        for c in self.changes[table]:
            if c["base"] is not None and c["base"] != first.number:
                raise Conflict(table)
            kept = tuple(f for f in state.folders if f.part not in c["replace"])
            new = tuple(dataclasses.replace(f.result(), at=first.number + 1) for f in c["folders"])
            # a schema is as it was first declared, unless other columns come
            told = {p: s.json() for p, s in c["schemas"].items() if p not in state.schemas or [(f.name, f.dataType) for f in state.schema(p)] != [(f.name, f.dataType) for f in s]}
            state = State(first.number + 1, state.note if c["note"] is None else c["note"], c["key"], {**state.schemas, **told}, kept + new)
        return state


class Store:
    """Named tables under one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), conf)
        self._fs = self._path(self.root).getFileSystem(conf)

    # ---- files

    def _bytes(self, path: str) -> bytes:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def _make(self, path: str, data: bytes) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def _manifests(self) -> list[int]:
        folder = self._path(f"{self.root}/{COMMITS}")
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def _manifest(self, number: int) -> dict[str, str]:
        """The state file of each table."""
        return dict(x.split("\t") for x in self._bytes(f"{self.root}/{COMMITS}/{number}").decode().splitlines()) if number else {}

    def _latest(self) -> tuple[int, dict[str, str]]:
        numbers = self._manifests()
        return (numbers[-1], self._manifest(numbers[-1])) if numbers else (0, {})

    def state(self, table: str) -> State:
        name = self._latest()[1].get(table)
        return State.of_json(self._bytes(f"{self.root}/{table}/{name}").decode()) if name else State()

    def _publish(self, states: dict[str, State]) -> bool:
        """The manifest of the next number, with these states in place of the tables' own; False if another took the number. A state follows on the one before, else Conflict."""
        number, now = self._latest()
        for table, state in states.items():
            if state.number != self._number_in(table, now) + 1:
                return False
            name = f"_state-{uuid.uuid4().hex}"
            self._make(f"{self.root}/{table}/{name}", state.to_json().encode())
            now[table] = name
        staged = self._path(f"{self.root}/{COMMITS}/.staged-{uuid.uuid4().hex}")
        self._make(staged.toString(), "\n".join(f"{t}\t{n}" for t, n in sorted(now.items())).encode())
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(staged, self._path(f"{self.root}/{COMMITS}/{number + 1}"), none)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise
        finally:
            self._fs.delete(staged, False)
        return True

    def _number_in(self, table: str, manifest: dict[str, str]) -> int:
        return State.of_json(self._bytes(f"{self.root}/{table}/{manifest[table]}").decode()).number if table in manifest else 0

    # ---- what there is

    def number(self, table: str) -> int:
        """How many commits the table has had; 0 if there is none."""
        return self.state(table).number

    def note(self, table: str) -> str | None:
        return self.state(table).note

    def tables(self) -> list[str]:
        return sorted(self._latest()[1])

    def exists(self, table: str) -> bool:
        return table in self._latest()[1]

    def _lines(self, table: str) -> list[tuple[str, str]]:
        return [(f.part, f.name) for f in self.state(table).folders if not f.gone]

    # ---- reading

    def folders(self, table: str, part: str | None = None, key: object = None, at: str | None = None, is_open: bool = False, since: int | None = None, hashes: list[int] | None = None, state: State | None = None) -> list[Folder]:
        """The folders that may hold such rows (see read)."""
        state = state or self.state(table)
        found = state.of_part(part)
        if since is not None:
            found = [f for f in found if f.at > since]
        if is_open:
            found = [f for f in found if f.part != "closed"]
        if at is not None:
            found = [f for f in found if not (f.low.get(VALID_FROM) is not None and f.low[VALID_FROM] > at) and not (f.part == "closed" and f.high.get(VALID_TO) is not None and f.high[VALID_TO] <= at)]
        if key is not None:
            own = state.key
            found = [f for f in found if not (type(f.low.get(own)) is type(key) and not f.low[own] <= key <= f.high[own])]
            hashes = [zlib.crc32(str(key).encode())]
        if hashes is not None:
            found = [f for f in found if f.of == 1 or any(h % f.of == f.bucket for h in hashes)]
        if key is not None:
            found = [f for f in found if not f.bloom or self._may_hold(table, f, hashes[0])]
        return found

    def _may_hold(self, table: str, folder: Folder, hash_: int) -> bool:
        bits = self._bytes(f"{self.root}/{table}/{folder.name}/{INDEX}")
        half, size = (1 << BITS) - 1, 1 << BITS >> 3
        return all(bits[n * size + (p >> 3)] >> (p & 7) & 1 for n, p in enumerate((hash_ & half, hash_ >> BITS & half)))

    def read(self, table: str, part: str | None = None, key: object = None, at: str | None = None, is_open: bool = False, since: int | None = None, keys: DataFrame | None = None, places: bool = False) -> DataFrame:
        """The table, or one part of it; parts that have no rows yet read as empty.

        key: rows of this key only; at: versions that held then; is_open: those without an end; keys: rows of the keys in this column; since: rows that commits after this number of the
        table brought.  Of all these only the folders that may hold such rows are opened.  places: with each row's place, for `drop`.
        """
        state = self.state(table)
        schema = state.schema(part) or state.schema()
        if schema is None:
            raise ValueError(f"no such table: {table}")
        hashes = None
        if keys is not None and (most := max((f.of for f in state.of_part(part)), default=1)) > 1:
            # as many numbers as there are buckets, at most
            hashes = [r[0] for r in keys.select(F.pmod(key_hash(keys[0]), F.lit(most)).alias("b")).distinct().collect()]
        found = self.folders(table, part, key, at, is_open, since, hashes, state)
        if not found:
            none = self.spark.createDataFrame([], schema)
            return none.select(*schema.names, *[F.lit(None).cast(k).alias(c) for c, k in zip(WHERE, ("string", "long"), strict=True)]) if places else none
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{table}/{f.name}" for f in found])
        gone = [f for p in {f.part for f in found} for f in state.of_part(p, gone=True)]
        if gone or places:
            rows = rows.withColumns(_places())
        if key is not None:
            rows = rows.where(F.col(state.key) == F.lit(key))
        if at is not None:
            rows = rows.where((F.col(VALID_FROM) <= F.lit(at)) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.lit(at))))
        if is_open:
            rows = rows.where(F.col(VALID_TO).isNull())
        if keys is not None:
            wanted = keys.select(F.col(keys.columns[0]).alias("_wanted")).distinct()
            rows = rows.join(wanted, rows[state.key].cast("string") == wanted["_wanted"].cast("string"), "left_semi")
        if gone:
            out = self.spark.read.schema("_file string, _place long").parquet(*[f"{self.root}/{table}/{f.name}" for f in gone])
            few = sum(MOST_GONE if f.rows is None else f.rows for f in gone) < MOST_GONE
            rows = rows.join(F.broadcast(out) if few else out, WHERE, "left_anti")
        return rows if places else rows.select(*schema.names)

    # ---- writing

    def _put(self, table: str, part: str, df: DataFrame, key: str | None, gone: bool = False) -> Folder:
        """Writes a folder, counting and bounding its rows on the way."""
        name = f"{part}{'-gone' * gone}-{uuid.uuid4().hex}"
        bounded = [c for c in dict.fromkeys((key, VALID_FROM, VALID_TO)) if c in df.columns and df.schema[c].dataType.typeName() in ("string", "long", "integer", "short")] if not gone else []
        told = [F.count(F.lit(1)).alias("rows")] + [f(c).alias(f"{n}{i}") for i, c in enumerate(bounded) for n, f in (("low", F.min), ("high", F.max))]
        if key in bounded:
            told += [F.bitmap_construct_agg(F.coalesce(x, F.lit(0))).alias(f"bits{i}") for i, x in enumerate(_halves(key_hash(F.col(key))))]
        seen = Observation()
        df.observe(seen, *told).write.parquet(f"{self.root}/{table}/{name}")
        got = seen.get
        bloom = key in bounded and got.get("rows", BLOOM_ROWS + 1) <= BLOOM_ROWS
        if bloom:
            self._make(f"{self.root}/{table}/{name}/{INDEX}", bytes(got["bits0"]) + bytes(got["bits1"]))
        bounds = {n: {c: got.get(f"{n}{i}") for i, c in enumerate(bounded)} for n in ("low", "high")}
        return Folder(part, name, rows=got.get("rows"), gone=gone, bloom=bloom, **bounds)

    def transaction(self) -> Transaction:
        return Transaction(self)

    def commit(self, table: str, replace: dict[str, DataFrame] | None = None, append: dict[str, DataFrame] | None = None, note: str | None = None, base: int | None = None, drop: dict[str, DataFrame] | None = None, key: str | None = None) -> DataFrame:
        """A transaction of one table. What only appends needs no base: it follows on whatever is there."""
        one = self.transaction()
        one.commit(table, replace, append, note, self.number(table) if base is None and (replace or drop) else base, drop, key)
        one.publish()
        return self.read(table)

    def compact(self, table: str, part: str, most: int = 32, small: int = 128 << 20) -> bool:
        """Keeps the part cheap to read; says whether it did anything. If half of its rows are gone, it is written again in buckets of the key; else, if it has more than
        `most` folders of less than `small` bytes, these are joined; else, if it has as many lists of gone rows, those are. A row is rewritten a few times at most. A table that moves on meanwhile is left alone."""
        state = self.state(table)
        own, dead = state.of_part(part), state.of_part(part, gone=True)
        lost = sum(f.rows or 0 for f in dead)
        if lost and 2 * lost >= sum(f.rows or 0 for f in own):
            return self._swap(table, state, {*own, *dead}, self._buckets(table, part, state))
        little = [f for f in own if f.of == 1 and self._fs.getContentSummary(self._path(f"{self.root}/{table}/{f.name}")).getLength() < small]
        if len(little) > most:
            joined = self._without(table, little, dead, state.schema(part))
            return self._swap(table, state, set(little), [self._put(table, part, joined.coalesce(max(1, most * small // (128 << 20))), state.key)])
        if len(dead) > most:
            joined = self.spark.read.parquet(*[f"{self.root}/{table}/{f.name}" for f in dead])
            return self._swap(table, state, set(dead), [self._put(table, part, joined.coalesce(1), None, gone=True)])
        return False

    def _without(self, table: str, folders: list[Folder], dead: list[Folder], schema: T.StructType) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{table}/{f.name}" for f in folders])
        if not dead:
            return rows
        out = self.spark.read.parquet(*[f"{self.root}/{table}/{f.name}" for f in dead])
        return rows.withColumns(_places()).join(out, WHERE, "left_anti").select(*schema.names)

    def _buckets(self, table: str, part: str, state: State) -> list[Folder]:
        """The part's rows, written by the hash of their key."""
        own, dead = state.of_part(part), state.of_part(part, gone=True)
        left = max(0, sum(f.rows or 0 for f in own) - sum(f.rows or 0 for f in dead))
        of = min(MOST_BUCKETS, 1 << max(0, (left // BUCKET_ROWS).bit_length()))
        rows = self._without(table, own, dead, state.schema(part))
        if state.key is None or of == 1:
            return [self._put(table, part, rows.coalesce(1) if of == 1 else rows, state.key)]
        name = f"{part}-{uuid.uuid4().hex}"
        dealt = rows.withColumn("_b", F.pmod(key_hash(F.col(state.key)), F.lit(of)))
        # sorted, and with Parquet's own filters, so that a bucket's row groups are left out too
        dealt.repartition(of, "_b").sortWithinPartitions("_b", state.key).write.option(f"parquet.bloom.filter.enabled#{state.key}", "true").partitionBy("_b").parquet(f"{self.root}/{table}/{name}")
        made = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.root}/{table}/{name}")) if f.isDirectory()]
        return [Folder(part, f"{name}/{n}", rows=left // len(made), bucket=int(n.removeprefix("_b=")), of=of) for n in made if n.startswith("_b=")]

    def _swap(self, table: str, state: State, old: set[Folder], new: list[Folder]) -> bool:
        names = {f.name for f in old}
        after = dataclasses.replace(state, number=state.number + 1, folders=tuple(f for f in state.folders if f.name not in names) + tuple(dataclasses.replace(f, at=state.number + 1) for f in new))
        for _ in range(8):
            if self.number(table) != state.number:
                return False
            if self._publish({table: after}):
                return True
        return False

    def vacuum(self, table: str, older: float = 3600) -> int:
        """Deletes manifests but the last two, and the table's folders that neither of these lists, if older than so many seconds; returns how many folders."""
        numbers, gone, listed = self._manifests(), 0, set()
        for n in numbers[-2:]:
            name = self._manifest(n).get(table)
            if name:
                state = State.of_json(self._bytes(f"{self.root}/{table}/{name}").decode())
                listed |= {name} | {f.name.split("/")[0] for f in state.folders}
        limit = (time.time() - older) * 1000
        for n in numbers[:-2]:
            path = self._path(f"{self.root}/{COMMITS}/{n}")
            if self._fs.getFileStatus(path).getModificationTime() <= limit:
                self._fs.delete(path, False)
        for f in self._fs.listStatus(self._path(f"{self.root}/{table}")):
            if f.getPath().getName() not in listed and f.getModificationTime() <= limit:
                gone += bool(self._fs.delete(f.getPath(), True)) and f.isDirectory()
        return gone

    def write(self, table: str, df: DataFrame) -> DataFrame:
        return self.commit(table, replace={"all": df})

    def create(self, table: str, schema: T.StructType) -> bool:
        """An empty table, unless it is there; says whether it was made."""
        if self.exists(table):
            return False
        self.write(table, self.spark.createDataFrame([], schema))
        return True

    def columns(self) -> DataFrame:
        """The catalogue: entity, column, db_type, nullable, position of every table, as declared."""
        rows = [(t, f.name, f.dataType.simpleString(), f.nullable, i) for t in self.tables() for i, f in enumerate(self.state(t).schema().fields)]
        return local_frame(self.spark, rows, "entity string, column string, db_type string, nullable boolean, position int")
