"""Slowly changing dimensions: every version of every key, as half-open intervals (#27-#29).

A batch is applied in arrival order: a key's first record starts a version, an equal payload only moves
sync_time, another payload closes the open version at its own valid_from and starts the next.  The whole
batch is one window job per entity: one shuffle by key, which the open rows share.  A key's records are
sorted, never collected, so a key with very many records spills instead of failing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def history(events: DataFrame, key: str, seq: str, payload: list[str], valid_from: str) -> DataFrame:
    """Versions of a change feed: key, payload..., valid_from, valid_to. Consecutive equal payloads are one version."""
    w = Window.partitionBy(key).orderBy(seq)
    now = F.struct(*payload)
    changed = (F.row_number().over(w) == 1) | ~now.eqNullSafe(F.lag(now).over(w))
    starts = events.withColumn("_changed", changed).where("_changed")
    return starts.select(key, *payload, F.col(valid_from).alias("valid_from"), F.lead(valid_from).over(w).alias("valid_to"))


def apply(active: DataFrame, batch: DataFrame, key: str, payload: str = "json_response", seq: str = "seq", strict_time: bool = False, keep_seq: bool = False) -> DataFrame:
    """Open versions and a batch -> all versions that are open or were closed or made by it.

    active: key, columns..., payload, sync_time, valid_from (and valid_to, all null); batch: the same
    with seq.  Result: the columns, valid_from, valid_to, is_new_entity, version_created, from_target.
    strict_time takes records in the order of valid_from instead of arrival (see splice, which also takes closed versions);
    keep_seq adds the seq of the record that each version began with (-1 for those of active).
    """
    if strict_time:
        told = splice(active, batch, key, payload, seq, keep_seq)
        return told.where("is_version").drop("is_version")
    columns = [c for c in batch.columns if c not in (seq, "valid_to")]
    old = active.select(*columns).withColumn(seq, F.lit(-1).cast("long")).withColumn("_target", F.lit(True))
    new = batch.select(*columns, F.col(seq).cast("long").alias(seq)).withColumn("_target", F.lit(False))
    rows = old.unionByName(new).where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    order = [F.col("_target").desc(), F.col(seq)]
    w = Window.partitionBy(key).orderBy(*order)
    rows = rows.withColumn("_changed", (F.row_number().over(w) == 1) | ~F.col(payload).eqNullSafe(F.lag(payload).over(w)))
    rows = rows.withColumn("_run", F.sum(F.col("_changed").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # a run's first row holds the version, its last one the time it was seen
    run = Window.partitionBy(key, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("sync_time", F.last("sync_time").over(run)).where("_changed")
    ends = F.lead("valid_from").over(w)
    first_new = (F.col("_run") == 1) & ~F.col("_target")
    return rows.select(*columns, ends.alias("valid_to"), first_new.alias("is_new_entity"), (~F.col("_target")).alias("version_created"), F.col("_target").alias("from_target"), *([F.col(seq)] if keep_seq else []))


def splice(known: DataFrame, batch: DataFrame, key: str, payload: str = "json_response", seq: str = "seq", keep_seq: bool = False) -> DataFrame:
    """The history of the batch's keys in the order of time, whatever the order of arrival.

    known: all that is known of these keys, open and closed versions and confirmations: key, columns..., payload, sync_time, valid_from; batch: the same with seq.  A late
    record splits the interval that it falls in; neighbours that become equal are one version.  Of several records of one
    time the last to arrive counts, so no interval is empty or inverted.  Result: the columns, valid_to, is_new_entity, version_created,
    from_target, is_version.  Rows that are no version are confirmations: a payload met again at a later time, from which a version
    may begin once something comes in between; they are kept apart and come again as known.
    """
    columns = [c for c in batch.columns if c not in (seq, "valid_to")]
    old = known.select(*columns).withColumn(seq, F.lit(-1).cast("long")).withColumn("_target", F.lit(True))
    new = batch.select(*columns, F.col(seq).cast("long").alias(seq)).withColumn("_target", F.lit(False))
    rows = old.unionByName(new).where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).repartition(key)
    moment = Window.partitionBy(key, "valid_from").orderBy(F.desc("_target"), seq)
    all_of_it = moment.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"_p": F.last(payload).over(all_of_it), "_s": F.last("sync_time").over(all_of_it)}).where(F.col(payload).eqNullSafe(F.col("_p")))
    rows = rows.withColumn("_n", F.row_number().over(moment)).where("_n = 1").withColumn("sync_time", F.col("_s"))
    w = Window.partitionBy(key).orderBy("valid_from")
    rows = rows.withColumns({"is_version": (F.row_number().over(w) == 1) | ~F.col(payload).eqNullSafe(F.lag(payload).over(w)), "is_new_entity": (F.row_number().over(w) == 1) & ~F.max("_target").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    # the next version's start: the first of those that come after
    ends = F.first(F.when(F.col("is_version"), F.col("valid_from")), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    # a run is seen until its last confirmation
    rows = rows.withColumns({"valid_to": ends, "_run": F.sum(F.col("is_version").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))})
    run = Window.partitionBy(key, "_run").orderBy("valid_from").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("sync_time", F.when(F.col("is_version"), F.max("sync_time").over(run)).otherwise(F.col("sync_time")))
    created = F.col("is_version") & ~F.col("_target")
    return rows.select(*columns, "valid_to", "is_new_entity", created.alias("version_created"), F.col("_target").alias("from_target"), *([F.col(seq)] if keep_seq else []), "is_version")


def counts(applied: DataFrame) -> DataFrame:
    """added (new keys) and updated (new versions of known keys) of an applied batch."""
    return applied.agg(
        F.count_if("is_new_entity").cast("long").alias("added"),
        F.count_if(F.col("version_created") & ~F.col("is_new_entity")).cast("long").alias("updated"),
    )


def upsert_scd1(target: DataFrame, batch: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Latest record of each key over the target; columns that the batch lacks become null, as in a whole-row replace; is_new tells unknown keys."""
    last = batch.groupBy(key).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in (key, seq)]), seq).alias("_x"))
    last = last.select(key, *[F.col(f"_x.{c}").alias(c) for c in batch.columns if c not in (key, seq)])
    known = target.select(F.col(key).alias("_known")).distinct()
    marked = last.join(known, last[key] == known["_known"], "left").withColumn("is_new", F.col("_known").isNull()).drop("_known")
    kept = target.join(last.select(key), key, "left_anti").withColumn("is_new", F.lit(False))
    return kept.unionByName(marked, allowMissingColumns=True).select(*target.columns, "is_new")


def with_row_ids(new_rows: DataFrame, first: int, order: list[str], buckets: int = 1024) -> DataFrame:
    """Dense surrogate ids from `first`: numbered within buckets of a hash of the first column, from the number of rows in the buckets before, so that no task numbers all rows; the rows of one key ascend in the order of the others."""
    dealt = new_rows.withColumn("_bucket", F.pmod(F.xxhash64(order[0]), F.lit(buckets)))
    sizes = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))  # at most `buckets` rows
    starts = sizes.select("_bucket", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    turn = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return dealt.withColumn("_turn", turn).join(F.broadcast(starts), "_bucket").select((F.lit(first - 1) + F.col("_start") + F.col("_turn")).cast("long").alias("row_id"), *new_rows.columns)
