"""From raw JSON records to keyed, typed rows with a canonical payload (#23-#26)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ODATA_PREFIX = "@odata."
#: A JSON string, as a pattern that never goes back, so that texts of any length do; and how much of a number a double holds for certain.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_SHORT = 15
#: What comes before a string of digits that stands for a number, and before a string of the record's own that starts so.
_MARK = r"\\u0001"


def _verbatim(raw: Column, all_numbers: bool) -> Column:
    """raw with numbers as marked strings: all, or those with more digits than a double holds. Strings are passed over whole, so digits in them stay."""
    own = F.when(_marked(raw), F.regexp_replace(raw, r'(?<!\\)"' + r"\\u0001", F.lit('"' + _MARK + _MARK))).otherwise(raw)
    short = "" if all_numbers else rf"|-?[0-9.eE+-]{{1,{_SHORT}}}+(?![0-9.eE+-])"
    return F.regexp_replace(own, rf'\G((?:[^"0-9-]++|{_STRING}{short})*+)(-?[0-9][0-9.eE+-]*+)', F.lit(f'$1"{_MARK}$2"'))


def _plain(text: Column) -> Column:
    numbers = lambda t: F.regexp_replace(t, r'"\\u0001(-?[0-9][0-9.eE+-]*)"', "$1")
    return once(text, lambda t: F.when(_marked(t), F.regexp_replace(numbers(t), r'(?<!\\)"\\u0001\\u0001', F.lit('"' + _MARK))).otherwise(t))


def _marked(text: Column) -> Column:
    """Most texts hold no mark, and to look for one costs next to nothing beside a pattern."""
    return F.contains(text, F.lit(r"\u0001"))


def once(x: Column, then: Callable[[Column], Column]) -> Column:
    """then(x), where x is evaluated once however often `then` names it: Spark shares nothing below a function of arrays."""
    return F.get(F.transform(F.array(x), then), F.lit(0))


def _entries(raw: Column) -> Column:
    """The record's own (key, value) pairs; of a key that comes twice, here or further in, the last."""
    SparkSession.active().conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    own = F.filter(F.map_entries(F.from_json(raw, "map<string, variant>")), lambda e: ~F.startswith(e["key"], F.lit(ODATA_PREFIX)))

    def distinct(all_: Column, keys: Column) -> Column:
        last = lambda: F.filter(all_, lambda e, i: F.array_position(F.reverse(keys), e["key"]) == F.size(keys) - i)
        return F.when(F.size(F.array_distinct(keys)) < F.size(keys), last()).otherwise(all_)

    return once(own, lambda all_: once(F.transform(all_, lambda e: e["key"]), lambda keys: distinct(all_, keys)))


def _object(raw: Column, text_of) -> Column:
    name = lambda e: F.to_json(e["key"].cast("variant"))
    # sort_array compares without a function of arrays
    pairs = F.sort_array(F.transform(_entries(raw), lambda e: F.struct(e["key"].alias("k"), F.concat(name(e), F.lit(": "), text_of(F.coalesce(F.to_json(e["value"]), F.lit("null")))).alias("t"))))
    return F.concat(F.lit("{"), F.array_join(pairs["t"], ", "), F.lit("}"))


def canonical(raw: Column) -> Column:
    """The record without its top-level `@odata.` keys, keys sorted at every level: equal for equal records.

    Of a key that comes twice the last counts, at any level.  Numbers are normalised (`1.0` and `1` are the same) unless they have
    more digits than a double holds; these keep their text.  For the text of all numbers use canonical_exact.
    """
    return _plain(_object(_verbatim(raw, False), lambda x: x))


def canonical_exact(raw: Column | str) -> Column:
    """canonical() with each number as the record has it (1 and 1.0 differ), a space after every colon and comma, and non-ASCII characters escaped, as a sorted JSON dump writes them."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    spaced = lambda x: F.regexp_replace(x, rf'\G((?:[^",:]++|{_STRING})*+)([:,])', "$1$2 ")
    text = _plain(_object(_verbatim(raw, True), spaced))
    units = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(....)", r"\\u$1")
    ascii_ = lambda t: F.array_join(F.transform(F.split(t, ""), lambda c: F.when(c > F.lit("\x7f"), units(c)).otherwise(c)), "")
    return once(text, lambda t: F.when(t.rlike(r"[^\x00-\x7F]"), ascii_(t)).otherwise(t))


def effective_time(modified: Column, clock: Column) -> Column:
    """When a version starts: the record's own time, or the batch clock where it has none."""
    return F.coalesce(F.nullif(modified, F.lit("")), clock)


def has_key(key: Column) -> Column:
    """Rows that have a business key: keys are strings, so that a number 0 is a key."""
    return key.isNotNull() & (key.cast("string") != "")


def project(records: DataFrame, columns: dict[str, T.DataType], raw: str = "raw", multi: tuple[str, ...] = ()) -> DataFrame:
    """records with one typed column for each schema column found in the raw JSON; multi-select fields are left to their junction."""
    parsed = F.try_parse_json(F.col(raw))
    kinds = {n: "string" if isinstance(t, T.StringType) else t.simpleString() for n, t in columns.items()}
    path = lambda n: "$['" + n.replace("'", "\\'") + "']"
    each = [(F.lit(None).cast(kinds[n]) if n in multi else F.try_variant_get(parsed, path(n), kinds[n])).alias(n) for n in columns]
    return records.select("*", *each)


def to_versions(records: DataFrame, key: str, columns: dict[str, T.DataType], clock: str, modified: str = "modifiedon", raw: str = "raw", seq: str = "seq", exact: bool = False) -> DataFrame:
    """Raw records (raw, seq) -> key, columns..., json_response, sync_time, valid_from, seq, ready for scd2.apply; records without a key go."""
    typed = project(records, {**columns, **({} if modified in columns else {modified: T.StringType()})}, raw)
    payload = canonical_exact(F.col(raw)) if exact else canonical(F.col(raw))
    names = list(columns)
    return typed.where(has_key(F.col(key))).select(
        *[F.col(key).cast("string").alias(key) if n == key else F.col(n) for n in names],
        payload.alias("json_response"),
        F.lit(clock).alias("sync_time"),
        effective_time(F.col(modified).cast("string"), F.lit(clock)).alias("valid_from"),
        F.col(seq),
    )
