"""Coded fields: detection in raw records, lookup tables, temporal junction tables (#30-#38).

A field is coded if the record also has `<field>@OData.Community.Display.V1.FormattedValue`, both values are
not null, and the raw value is an integer as a program would read it: booleans count as 0 and 1, numbers
are cut off, strings may have spaces, a sign and single underscores between digits.  It is a multi-select if
the label holds `;`, or the raw value is a string that holds `,`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The annotation's suffix, and what an integer may look like in a string.
SUFFIX = "@OData.Community.Display.V1.FormattedValue"
INTEGER = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
_SPACE = r"(?U)^\s+|\s+$"


def _tokens(x: Column, separator: str) -> Column:
    # between two plain characters there is nothing to cut off, and the pattern is costly
    plain = lambda c: F.ascii(c).between(33, 126)
    trimmed = lambda t: F.when(plain(t) & plain(F.right(t, F.lit(1))), t).otherwise(F.regexp_replace(t, _SPACE, ""))
    return F.filter(F.transform(F.split(x, separator, -1), trimmed), lambda t: t != "")


def _code(token: Column, kind: Column) -> Column:
    """The token of a raw value of a JSON kind as a 64-bit integer, or null."""
    short = token.rlike(r"^-?[0-9]{1,18}$")  # as nearly all are: the rest is for others
    text = F.when(short, token.try_cast("bigint")).when(token.rlike(INTEGER), F.regexp_replace(token, r"[_\s]", "").try_cast("bigint"))
    cut = F.when(short, token.try_cast("bigint")).when(F.abs(token.try_cast("double")) < 9.3e18, F.regexp_replace(token.try_cast("decimal(38,10)").cast("string"), r"\..*$", "").try_cast("bigint"))
    return F.when(kind == "BOOLEAN", F.when(token == "true", 1).when(token == "false", 0).cast("bigint")).when(kind == "STRING", text).when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|TINYINT|SMALLINT)"), cut)


def _coded(records: DataFrame, raw: str, ids: list[str]) -> DataFrame:
    """ids..., field, _v, _lv: value and label of each field that has both."""
    entries = F.map_entries(F.from_json(F.col(raw), "map<string, variant>"))
    pairs = records.select(*ids, entries.alias("_e"))
    # labels and raw values of one record meet inside the row: no join, no shuffle
    label_of = F.map_from_entries(F.filter("_e", lambda e: e["key"].endswith(SUFFIX)))
    pairs = pairs.withColumn("_l", label_of)
    # what does not count is left out inside the arrays: a filter on the rows would be moved below the columns that it names, which are then computed once more for each mention
    label_at = lambda e: F.try_element_at("_l", F.concat(e["key"], F.lit(SUFFIX)))
    coded = F.filter("_e", lambda e: ~e["key"].endswith(SUFFIX) & _counts(e["value"]) & _counts(label_at(e)))
    each = pairs.select(*ids, "_l", F.explode(coded).alias("_p"))
    return each.select(*ids, F.col("_p.key").alias("field"), F.col("_p.value").alias("_v"), label_at(F.col("_p")).alias("_lv"))


def _counts(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def _coded_of(records: DataFrame, raw: str, ids: list[str], fields: tuple[str, ...]) -> DataFrame:
    """The same of these fields only: nothing else of a record, which must name none twice, is made a value."""
    kind = T.StructType([T.StructField(n, T.VariantType()) for f in fields for n in (f, f + SUFFIX)])
    told = records.select(*ids, F.from_json(F.col(raw), kind).alias("_e"))
    own = F.array(*[F.struct(F.lit(f).alias("field"), F.col("_e").getField(f).alias("_v"), F.col("_e").getField(f + SUFFIX).alias("_lv")) for f in fields])
    each = told.select(*ids, F.explode(F.filter(own, lambda e: _counts(e["_v"]) & _counts(e["_lv"]))).alias("_p"))
    return each.select(*ids, "_p.field", "_p._v", "_p._lv")


def detect(records: DataFrame, raw: str = "raw", ids: list[str] | None = None, fields: tuple[str, ...] | None = None) -> DataFrame:
    """ids..., field, is_multi, pos, code, label: one row a code of each coded field, or of these `fields`, of each record.

    ids must identify a record. Within a field a repeated code keeps its first position and last label.
    """
    ids = ids or [c for c in records.columns if c != raw]
    each = _coded(records, raw, ids) if fields is None else _coded_of(records, raw, ids, fields)
    kind, label_kind = F.schema_of_variant("_v"), F.schema_of_variant("_lv")
    text = F.try_variant_get("_v", "$", "string")
    label = F.coalesce(F.try_variant_get("_lv", "$", "string"), F.to_json("_lv"))
    each = each.select(*ids, "field", kind.alias("_k"), F.coalesce(text, F.to_json("_v")).alias("_t"), label.alias("_label"), (label_kind == "STRING").alias("_ls"))
    multi = (F.col("_ls") & F.contains("_label", F.lit(";"))) | ((F.col("_k") == "STRING") & F.contains("_t", F.lit(",")))
    each = each.withColumn("is_multi", multi)
    many = F.col("is_multi") & (F.col("_k") == "STRING")
    each = each.withColumn("_raws", F.when(many, _tokens(F.col("_t"), ",")).otherwise(F.array("_t")))
    each = each.withColumn("_labels", F.when(F.col("is_multi"), _tokens(F.col("_label"), ";")).otherwise(F.array("_label")))
    each = each.withColumn("_codes", F.transform("_raws", lambda t: _code(t, F.col("_k"))))
    n = F.least(F.size("_codes"), F.size("_labels"))
    zipped = F.transform(F.slice("_codes", 1, n), lambda c, i: F.struct(i.alias("pos"), c.alias("code"), F.get("_labels", i).alias("label")))
    each = each.withColumn("_z", F.when(~F.exists("_codes", lambda c: c.isNull()) & (n > 0), zipped))
    # within a field a code's first position and last label count; the costly rule runs only where a code repeats
    first = F.filter("_z", lambda z, i: F.array_position("_codes", z["code"]) == i + 1)
    last = F.transform(first, lambda z: F.struct(z["pos"].alias("pos"), z["code"].alias("code"), F.element_at(F.filter("_z", lambda y: y["code"] == z["code"]), -1)["label"].alias("label")))
    repeats = F.size(F.array_distinct("_codes")) < F.size("_codes")
    chosen = F.when(repeats, last).otherwise(F.col("_z"))
    return each.select(*ids, "field", "is_multi", F.explode(chosen).alias("_o")).select(*ids, "field", "is_multi", F.col("_o.pos").alias("pos"), F.col("_o.code").alias("code"), F.col("_o.label").alias("label"))


def merge_lookup(old: DataFrame, seen: DataFrame) -> DataFrame:
    """old(field, code, label, first_seen) and seen(field, code, label, seen_at, seq) -> the lookup after: the latest label, the earliest first_seen. Combined before the shuffle."""
    before = old.select("field", "code", "label", F.col("first_seen").alias("seen_at"), F.lit(-1).cast("long").alias("seq"))
    rows = before.unionByName(seen.select("field", "code", "label", "seen_at", F.col("seq").cast("long").alias("seq")))
    return rows.groupBy("field", "code").agg(F.max_by("label", F.struct("seq", "label")).alias("label"), F.min("seen_at").alias("first_seen"))


def lookup_of(lookups: DataFrame, field: str) -> DataFrame:
    return lookups.where(F.col("field") == field).select("code", "label", "first_seen")


def junction(versions: DataFrame, selections: DataFrame, key: str, field: str, mode: str = "fixed") -> DataFrame:
    """The temporal table of one multi-select field from all versions of its entity.

    versions: key, valid_from, seq (order of versions); selections: key, seq, code, is_multi, as detected
    in those versions.  Result: entity_id, option_code, valid_from, valid_to.
    compat: only versions detected as multi-select are snapshots, so a selection of one code or none leaves
    the one before open.  fixed: once a field was multi-select for the entity, every version is a snapshot.
    """
    picks = selections.where(F.col("field") == field) if "field" in selections.columns else selections
    sets = picks.groupBy(key, "seq").agg(F.collect_set("code").alias("codes"), F.max("is_multi").alias("is_multi"))
    joined = versions.select(key, "seq", "valid_from").join(sets, [key, "seq"], "left")
    w = Window.partitionBy(key).orderBy("seq")
    if mode == "compat":
        shots = joined.where("is_multi")
    else:
        shots = joined.withColumn("_ever", F.max(F.coalesce("is_multi", F.lit(False))).over(w)).where("_ever")
    shots = shots.withColumn("valid_to", F.lead("valid_from").over(w))
    return shots.select(F.col(key).alias("entity_id"), F.explode("codes").alias("option_code"), "valid_from", "valid_to")


def junction_batch(open_rows: DataFrame, blank: DataFrame, versions: DataFrame, selections: DataFrame, key: str, mode: str = "fixed") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The new versions of a batch on a junction: (open rows after, rows that were closed, blank after).

    open_rows: entity_id, option_code, valid_from, valid_to; blank: entity_id of the entities that had a
    multi-select once and have no code now; versions and selections as for junction(), of the new versions
    only.  What was closed before is not read: an entity that ever had a snapshot is in open_rows or blank.
    """
    sets = selections.groupBy(key, "seq").agg(F.collect_set("code").alias("codes"), F.max("is_multi").alias("is_multi"))
    joined = versions.select(key, "seq", "valid_from").join(sets, [key, "seq"], "left")
    w = Window.partitionBy(key).orderBy("seq")
    if mode == "compat":
        shots = joined.where("is_multi")
    else:
        ever = open_rows.select(F.col("entity_id").alias(key)).union(blank.select(F.col("entity_id").alias(key))).distinct().withColumn("_known", F.lit(True))
        began = F.max(F.coalesce("is_multi", F.lit(False))).over(w) | F.coalesce("_known", F.lit(False))
        shots = joined.join(ever, key, "left").withColumn("_ever", began).where("_ever")
    shots = shots.withColumn("valid_to", F.lead("valid_from").over(w))
    rows = shots.select(F.col(key).alias("entity_id"), F.explode("codes").alias("option_code"), "valid_from", "valid_to")
    ends = shots.groupBy(F.col(key).alias("entity_id")).agg(F.min_by("valid_from", "seq").alias("_at"), F.max_by(F.size(F.coalesce("codes", F.array())), "seq").alias("_left"))
    before = open_rows.join(ends.select("entity_id", "_at"), "entity_id", "left")
    columns = ["entity_id", "option_code", "valid_from", "valid_to"]
    closed = before.where("_at is not null").withColumn("valid_to", F.col("_at")).select(*columns).unionByName(rows.where("valid_to is not null"))
    opened = before.where("_at is null").select(*columns).unionByName(rows.where("valid_to is null"))
    blank = blank.select("entity_id").join(ends.select("entity_id"), "entity_id", "left_anti").unionByName(ends.where("_left = 0").select("entity_id"))
    return opened, closed, blank


def snapshot(open_rows: DataFrame, new: DataFrame) -> DataFrame:
    """Close all open rows of the entities in new(entity_id, option_code, valid_from) at its valid_from and add the new ones; an entity with a null code is only closed."""
    times = new.groupBy("entity_id").agg(F.max("valid_from").alias("_at"))
    closed = open_rows.join(times, "entity_id", "left").withColumn("valid_to", F.when(F.col("valid_to").isNull(), F.col("_at")).otherwise(F.col("valid_to"))).select("entity_id", "option_code", "valid_from", "valid_to")
    added = new.where("option_code is not null").select("entity_id", "option_code", "valid_from", F.lit(None).cast(open_rows.schema["valid_to"].dataType).alias("valid_to"))
    return closed.unionByName(added)


def replace_links(rows: DataFrame, new: DataFrame, changed: DataFrame) -> DataFrame:
    """Without versions: the links of the entities in changed(entity_id) are cleared, new ones inserted."""
    return rows.join(changed.select("entity_id").distinct(), "entity_id", "left_anti").unionByName(new.select(*rows.columns))
