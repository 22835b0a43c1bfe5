"""A change feed applied as a stream: each micro-batch is one SCD2 batch on the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import canonical, scd2
from ..sources.odata import register
from ..sources.store import WHERE, Store, checkpointed


def apply_batch(store: Store, table: str, batch: DataFrame, key: str, payload: str = "json_response", seq: str = "seq", note: str | None = None) -> DataFrame:
    """The batch on the open versions of its keys, in one commit. Returns what was applied."""
    plain = [c for c in batch.columns if c not in (seq, "valid_to")]
    there, base = store.exists(table), store.number(table)
    rows = batch.withColumns({WHERE[0]: F.lit(None).cast("string"), WHERE[1]: F.lit(None).cast("long")})
    active = store.read(table, "open", keys=batch.select(key), places=True) if there else rows.limit(0)
    done = checkpointed(scd2.apply(active.select(*plain, *WHERE), rows, key, payload, seq))
    keep = [*plain, "valid_to"]
    store.commit(table, append={"open": done.where("valid_to is null").select(*keep), "closed": done.where("valid_to is not null").select(*keep)}, note=note, base=base, drop={"open": done.where("from_target")} if there else None, key=key)
    return done


def changes(spark: SparkSession, key: str, columns: dict[str, T.DataType], clock: str, **options: str) -> DataFrame:
    """A service's changes (options of the `odata` format) as a feed for history_stream."""
    register(spark)
    raw = spark.readStream.format("odata").options(**options).load().select("seq", "raw")
    return canonical.to_versions(raw, key, columns, clock)


def history_stream(feed: DataFrame, store: Store, table: str, key: str, checkpoint: str, payload: str = "json_response", seq: str = "seq", once: bool = True) -> StreamingQuery:
    """feed: a streaming DataFrame of key, columns..., payload, sync_time, valid_from, seq. The commit notes its batch, so one that comes again is skipped: exactly once."""

    def each(batch: DataFrame, number: int) -> None:
        note = f"batch {number}"
        if not (store.exists(table) and store.note(table) == note):
            apply_batch(store, table, batch, key, payload, seq, note)

    writer = feed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
