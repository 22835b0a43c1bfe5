"""Mixing sources to target weights, in DataFrame operations only.

The documents' level columns (domain, language, source) make a tree.  A budget of tokens goes down from
the root: each node shares its budget among its children by weight, no child getting more than it can
give (its documents' tokens times the allowed epochs); what a short child cannot use goes to its
siblings, and only what all of them cannot use was never asked of the node, since capacities are summed
upwards first.  So shortages are made up by siblings before ancestors.  A leaf fills its budget from
seeded epochs: whole epochs take every document once, the last takes the documents in a seeded order
while their tokens fit (a prefix of that order).

All amounts are integers (a node's tokens times its siblings' weights must stay below 2**63; ANSI mode
raises otherwise); left-over tokens of a division go one each to the first children by the MD5 of their names.  A hot leaf
is never in one task: its seeded order is cut into ranges of about RANGE documents, sums of ranges find
the one in which the prefix ends, and only that one is ordered.  Nor is a family of very many children: beyond
MOST_NODES leaves, running sums over siblings are taken in steps, of which only the sums meet in one task.

Null level values are a child of their own, named NONE.  Null and empty texts have no tokens.  Repeated
rows count each; an empty table gives an empty result.  Weights below 1 leave a node out.  mix reads the key, the levels and
the tokens only; mixture passes all columns on, whatever their names.  The documents table has no domain: the registered
tree takes it from the number in the source's name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fits, stored

NONE = "(none)"
RANGE = 1024
#: Leaves up to this many are broadcast.
MOST_BROADCAST = 100_000
#: Leaves up to this many are shared out by windows over whole families.
MOST_NODES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def seeded(seed: int, epoch: Column, key: Column) -> Column:
    """The place of a document in the order of an epoch: 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("long")


def weight_of(name: str, levels: list[str], weights: Mapping[str, int]) -> Column:
    """The weight of a node: by its path (`a/b/c`), else by its own name, else 1."""
    path = F.concat_ws("/", *levels[: levels.index(name) + 1])
    listed = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else None
    return F.coalesce(F.try_element_at(listed, path), F.try_element_at(listed, F.col(name)), F.lit(1)).cast("long") if weights else F.lit(1).cast("long")


def _before(nodes: DataFrame, near: list[str], step: Column, order: list[Column | str], value: Column, name: str) -> DataFrame:
    """nodes with the sum of `value` over the siblings that come before in order, step by step: a task sees one step's siblings, or the sums of the steps. Steps must ascend with the order."""
    stepped = nodes.withColumn("_step", step).withColumn("_value", value)
    up = Window.partitionBy(*near).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    steps = stepped.groupBy(*near, "_step").agg(F.sum("_value").alias("_sum")).withColumn("_base", F.coalesce(F.sum("_sum").over(up), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*near, "_step").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = stepped.withColumn("_own", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return own.join(steps, [*near, "_step"]).withColumn(name, F.col("_base") + F.col("_own")).drop("_step", "_value", "_base", "_own")


def share(nodes: DataFrame, parents: list[str], name: str, wide: bool = False) -> DataFrame:
    """nodes(parents..., name, weight, cap, budget of the parent) -> with `given`, whose sum is the parent's budget. wide: for families too large for one task; the result is the same."""
    near = parents or ["_root"]
    full = nodes if parents else nodes.withColumn("_root", F.lit(0))
    full = full.withColumn("_ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(-1.0)).withColumn("_turn", F.md5(F.col(name)))
    family = Window.partitionBy(*near)

    def over_family(rows: DataFrame, **sums: Column) -> DataFrame:
        if wide:
            return rows.join(rows.groupBy(*near).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in sums.items()]), near)
        return rows.select("*", *[F.coalesce(F.sum(v).over(family), F.lit(0)).alias(k) for k, v in sums.items()])

    def before(rows: DataFrame, step: Column, order: list[Column | str], value: Column, as_: str) -> DataFrame:
        if wide:
            return _before(rows, near, step, order, value, as_)
        w = Window.partitionBy(*near).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(as_, F.coalesce(F.sum(value).over(w), F.lit(0)))

    octave = F.when(F.col("_ratio") > 0, F.floor(F.log2("_ratio") * 64)).otherwise(-(1 << 20))
    by_need = [F.col("_ratio"), F.col(name)]
    full = before(full, octave, by_need, F.col("cap"), "before")
    full = before(full, octave, by_need, F.col("weight"), "_lighter")
    full = over_family(full, _weights=F.col("weight")).withColumn("rest", F.col("_weights") - F.col("_lighter"))
    full = full.withColumn("short", F.expr("cap * rest <= (budget - before) * weight"))
    full = over_family(full, _given=F.when(F.col("short"), F.col("cap")), open=F.when(~F.col("short"), F.col("weight")))
    full = full.withColumn("left", F.col("budget") - F.col("_given"))
    full = full.withColumn("part", F.when(F.col("short"), F.col("cap")).otherwise(F.expr("left * weight div nullif(open, 0)")))
    full = over_family(full, _parts=F.when(~F.col("short"), F.col("part"))).withColumn("over", F.col("left") - F.col("_parts"))
    full = before(full, F.conv(F.substring("_turn", 1, 3), 16, 10).cast("int"), [F.col("_turn"), F.col(name)], F.when(F.col("short"), 0).otherwise(1), "_earlier")
    given = F.col("part") + F.when(~F.col("short") & (F.col("_earlier") < F.col("over")), 1).otherwise(0)
    return full.withColumn("given", given.cast("long")).select(*nodes.columns, "given")


def budgets(leaves: DataFrame, levels: list[str], weights: Mapping[str, Mapping[str, int]], epochs: int, percent: int) -> DataFrame:
    """leaves(levels..., tokens, docs) -> with `given`, the tokens each leaf owes. The budget is `percent` of all tokens."""
    nodes = leaves
    for i in range(len(levels)):
        nodes = nodes.withColumn(f"w{i}", weight_of(levels[i], levels, weights.get(levels[i], {})))
    used = F.lit(True)
    for i in range(len(levels)):
        used = used & (F.col(f"w{i}") > 0)
    nodes = nodes.withColumn("cap0", F.when(used, F.col("tokens") * epochs).otherwise(0))
    tokens, most = nodes.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("cap0"), F.lit(0))).first()
    wide = not fits(leaves, MOST_NODES)
    above = None
    for i, name in enumerate(levels):
        parents = levels[:i]
        here = nodes.groupBy(*levels[: i + 1]).agg(F.max(f"w{i}").alias("weight"), F.sum("cap0").alias("cap"))
        # a node without capacity takes no part in sharing
        here = here.withColumn("weight", F.when(F.col("cap") > 0, F.col("weight")).otherwise(0))
        here = here.join(above, parents) if parents else here.withColumn("budget", F.lit(min(tokens * percent // 100, most)).cast("long"))
        above = share(here, parents, name, wide).select(*levels[: i + 1], F.col("given").alias("budget"))
    return leaves.join(above.withColumnRenamed("budget", "given"), levels)


def mix(docs: DataFrame, levels: list[str], weights: Mapping[str, Mapping[str, int]], key: str = "doc_id", tokens: str = "n_tokens", epochs: int = 2, percent: int = 60, seed: int = 7) -> DataFrame:
    """docs(key, levels..., tokens) -> the same and copies: how often the mixture holds the document (0: not at all)."""
    named = docs.select(key, *[F.coalesce(F.col(x), F.lit(NONE)).alias(x) for x in levels], F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias("n_tokens"))
    base = stored(named, "mix")
    leaves = stored(base.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "leaves")
    owed = budgets(leaves, levels, weights, epochs, percent)
    has = F.col("tokens") > 0
    owed = owed.select(*levels, F.when(has, F.expr("given div nullif(tokens, 0)")).otherwise(0).alias("whole"), F.when(has, F.expr("given % nullif(tokens, 0)")).otherwise(0).alias("rest"), F.ceil(F.col("docs") / RANGE).alias("ranges"))
    owed = stored(owed, "owed")
    small = fits(owed, MOST_BROADCAST)
    side = (lambda x: F.broadcast(x)) if small else (lambda x: x)
    placed = base.join(side(owed), levels).withColumn("place", seeded(seed, F.col("whole"), F.col(key)))
    placed = placed.withColumn("range", F.expr("shiftright(place * ranges, 32)"))
    sums = placed.groupBy(*levels, "range").agg(F.sum("n_tokens").alias("tokens"), F.max("rest").alias("rest"))
    up_to = F.sum("tokens").over(Window.partitionBy(*levels).orderBy("range"))
    # the first range that does not fit whole: documents before it are in, it is ordered, later ones are out
    edge = sums.withColumn("up_to", up_to).where("up_to > rest").groupBy(*levels).agg(F.min_by(F.struct("range", (F.col("up_to") - F.col("tokens")).alias("before")), "range").alias("x")).select(*levels, F.col("x.range").alias("edge"), F.col("x.before").alias("before"))
    judged = placed.join(side(edge), levels, "left")
    out = [key, *levels, "n_tokens"]
    plain = judged.where("edge is null or range <> edge").select(*out, (F.col("whole") + F.when(F.col("range") < F.col("edge"), 1).when(F.col("edge").isNull(), 1).otherwise(0)).alias("copies"))
    order = Window.partitionBy(*levels).orderBy("place", key, "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    last = judged.where("range = edge").withColumn("sum", F.sum("n_tokens").over(order) + F.col("before"))
    last = last.select(*out, (F.col("whole") + F.when(F.col("sum") <= F.col("rest"), 1).otherwise(0)).alias("copies"))
    return plain.unionByName(last)


#: Parameters of the registered query: three kinds of sources, the languages in them, the sources alike.
LEVELS = ["domain", "lang", "source"]
WEIGHTS = {"domain": {"web": 5, "code": 2, "books": 3}, "lang": {"en": 6, "fr": 2, "de": 1, "es": 1}}


def domain_of(source: Column) -> Column:
    n = F.expr("try_cast(regexp_extract(source, '^src([0-9]{1,9})$', 1) as int)")
    return F.when(n < 10, "web").when(n < 15, "code").otherwise("books")


def mix_documents(docs: DataFrame, epochs: int = 2, percent: int = 60, seed: int = 7) -> DataFrame:
    """The documents table by domain, language and source; a token is a word."""
    rows = docs.select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"))
    return mix(rows, LEVELS, WEIGHTS, epochs=epochs, percent=percent, seed=seed)


def mixture(docs: DataFrame, epochs: int = 2, percent: int = 60, seed: int = 7) -> DataFrame:
    """docs' rows as often as the mixture holds them, all columns as they are. Rows with one id are one document, each given the largest number of copies of any of them."""
    counted = mix_documents(docs, epochs, percent, seed).where("copies > 0").groupBy(F.col("doc_id").alias("mix_id")).agg(F.max("copies").alias("mix_copies"))
    # the row travels whole, so that no column of it can clash
    rows = docs.select(F.struct("*").alias("mix_row"))
    joined = rows.join(counted, F.col("mix_row.doc_id").eqNullSafe(F.col("mix_id")))
    return joined.select("mix_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))).select("mix_row.*")


def _level_sql(i: int) -> str:
    """One level of sharing, as in share()."""
    cols = ", ".join(LEVELS[: i + 1])
    up = ", ".join(LEVELS[:i]) or "1"
    name, above = LEVELS[i], f"b{i - 1}" if i else "b"
    source = f"(SELECT {cols}, max(w{i}) AS w, sum(cap) AS cap FROM leaves GROUP BY {cols})"
    joined = f"{source} h JOIN {above} USING ({', '.join(LEVELS[:i])})" if i else f"{source} h CROSS JOIN {above}"
    return f"""
h{i} AS (SELECT {cols}, CASE WHEN cap > 0 THEN w ELSE 0 END AS w, cap, budget FROM {joined}),
s{i} AS (SELECT *, cap * sum(w) OVER (PARTITION BY {up} ORDER BY CASE WHEN w > 0 THEN cap::DOUBLE / w ELSE -1 END, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  <= (budget - coalesce(sum(cap) OVER (PARTITION BY {up} ORDER BY CASE WHEN w > 0 THEN cap::DOUBLE / w ELSE -1 END, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS short FROM h{i}),
l{i} AS (SELECT *, budget - coalesce(sum(cap) FILTER (WHERE short) OVER (PARTITION BY {up}), 0) AS rest, sum(w) FILTER (WHERE NOT short) OVER (PARTITION BY {up}) AS open,
  row_number() OVER (PARTITION BY {up}, short ORDER BY md5({name}), {name}) AS turn FROM s{i}),
p{i} AS (SELECT *, CASE WHEN short THEN cap ELSE (rest * w) // open END AS part FROM l{i}),
b{i} AS (SELECT {cols}, CASE WHEN short THEN part ELSE part + CASE WHEN turn <= rest - coalesce(sum(part) FILTER (WHERE NOT short) OVER (PARTITION BY {up}), 0) THEN 1 ELSE 0 END END AS budget FROM p{i})"""


def oracle(epochs: int = 2, percent: int = 60, seed: int = 7) -> str:
    case = lambda col, kinds: f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in kinds.items()) + " ELSE 1 END"
    return (
        f"""
WITH d AS (SELECT doc_id, CASE WHEN n < 10 THEN 'web' WHEN n < 15 THEN 'code' ELSE 'books' END AS domain, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source, n_tokens
  FROM (SELECT *, TRY_CAST(regexp_extract(source, '^src([0-9]{{1,9}})$', 1) AS INT) AS n, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents)),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {epochs} AS cap, {case("domain", WEIGHTS["domain"])} AS w0, {case("lang", WEIGHTS["lang"])} AS w1, 1 AS w2 FROM d GROUP BY ALL),
b AS (SELECT least(sum(tokens) * {percent} // 100, sum(cap)) AS budget FROM leaves),"""
        + ",".join(_level_sql(i) for i in range(3))
        + f""",
o AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM leaves JOIN b2 USING (domain, lang, source)),
r AS (SELECT d.*, whole, rest, ('0x' || substr(md5('{seed}:' || whole::BIGINT || ':' || doc_id), 1, 8))::BIGINT AS place FROM d JOIN o USING (domain, lang, source)),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM r)
SELECT doc_id, domain, lang, source, n_tokens, (whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM c
"""
    )
