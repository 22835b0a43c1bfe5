"""Verdicts on URLs from a list of host and path rules.

Each URL becomes host-suffix and path-prefix expressions (`host<tab>path`, in the lengths that the rules'
keys have); expressions meet the rules in an equi-join on a short prefix of their SHA-256, full digests
confirm, then the whole rule, and of the rules that hold the longest decides.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased.  Path: from there up to
`?`, `#` or the end.  A null URL, or one without `://`, has both empty.  A rule (host, path, verdict)
fits its host and all subdomains if the path starts with the rule's.  Longest: most characters of the
rule string, then of its host, then the larger verdict string; no rule: `default`.  A rule's key is its last
LABELS labels and the first PREFIX characters of its path, so that the lengths of keys are few however many rules there are.

Every row comes back, repeated ones as often as they come, with these columns: key, host, path, rule, verdict; no
other column is read, so none can clash.  An empty table gives an empty result; without rules all get the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULES = T.StructType([T.StructField(x, T.StringType()) for x in ("host", "path", "verdict")])
#: The rules of the registered query.
CONTRACT_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
PREFIX_HEX = 8
#: Of a rule's key: labels of the host, characters of the path. There are at most LABELS * (PREFIX + 1) pairs of lengths.
LABELS, PREFIX = 8, 255
#: Rules up to this many are broadcast; beyond it both sides are shuffled, salted.
MOST_BROADCAST, SALTS = 200_000, 32
#: Copies of a row that one task gives back.
MOST_COPIES = 100_000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def last_labels(host: Column, n: Column) -> Column:
    """The last n labels of a host; the host itself if it has no more."""
    labels = F.split(host, r"\.", -1)
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")


def expressions(host: Column, path: Column, shapes: dict[int, list[int]]) -> Column:
    """host-suffix and path-prefix of each shape (labels of the host: characters of the path) that the URL can fill: as many as its own labels and characters allow, by expressions whose size does not grow with the rules."""
    if not shapes:
        return F.array().cast("array<string>")
    known = F.array(*[F.struct(F.lit(n).alias("labels"), F.array(*[F.lit(m) for m in sorted(ms)]).alias("lengths")) for n, ms in sorted(shapes.items())])
    labels = F.size(F.split(host, r"\.", -1))
    fill = F.filter(known, lambda x: x["labels"] <= labels)
    each = F.transform(fill, lambda x: F.transform(F.filter(x["lengths"], lambda m: m <= F.length(path)), lambda m: F.concat(last_labels(host, x["labels"]), F.lit("\t"), F.substring(path, F.lit(1), m))))
    return F.flatten(each)


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """pages(key, url, ...) x rules(host, path, verdict) -> key, host, path, rule, verdict for every row of pages."""
    known = rules.select(
        F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    ).where("rule_host is not null and rule_host <> '' and rule_path is not null and rule_verdict is not null").distinct()
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    known = known.withColumn("labels", F.least(F.size(F.split("rule_host", r"\.", -1)), F.lit(LABELS))).withColumn("chars", F.least(F.length("rule_path"), F.lit(PREFIX)))
    rule_key = F.concat(last_labels(F.col("rule_host"), F.col("labels")), F.lit("\t"), F.substring("rule_path", F.lit(1), F.col("chars")))
    known = known.withColumn("digest", digest(rule_key)).withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    shapes: dict[int, list[int]] = {}
    for n, m in known.select("labels", "chars").distinct().collect():  # at most LABELS * (PREFIX + 1) rows
        shapes.setdefault(n, []).append(m)
    small = known.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST

    base = pages.select(pages[key].alias("id"), pages[url].alias("url")).groupBy("id", "url").agg(F.count(F.lit(1)).alias("copies"))
    base = base.select("id", "url", "copies", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    exprs = base.withColumn("expression", F.explode_outer(expressions(F.col("host"), F.col("path"), shapes)))
    exprs = exprs.withColumn("full", digest(F.col("expression"))).withColumn("prefix", F.substring("full", 1, PREFIX_HEX))
    if small:
        joined = exprs.join(F.broadcast(known), (F.col("prefix") == F.col("short")) & (F.col("full") == F.col("digest")), "left")
    else:
        salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        exprs = exprs.withColumn("grain", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
        joined = exprs.join(salted, (F.col("prefix") == F.col("short")) & (F.col("grain") == F.col("salt")) & (F.col("full") == F.col("digest")), "left")
    rule = F.concat("rule_host", "rule_path")
    # keys are cut short, so the whole rule is held against the URL
    fits = F.endswith(F.concat(F.lit("."), F.col("host")), F.concat(F.lit("."), F.col("rule_host"))) & F.startswith("path", F.col("rule_path"))
    best = F.max(F.when(fits, F.struct(F.length(rule).alias("a"), F.length("rule_host").alias("b"), F.col("rule_verdict").alias("verdict"), rule.alias("rule"))))
    judged = joined.groupBy("id", "url").agg(F.first("copies").alias("copies"), F.first("host").alias("host"), F.first("path").alias("path"), best.alias("best"))
    few = judged.where(F.col("copies") <= MOST_COPIES)
    # rows of very many copies come back from several tasks
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {MOST_COPIES}")))
    many = judged.where(F.col("copies") > MOST_COPIES).withColumn("piece", piece).repartition("id", "url", "piece")
    many = many.withColumn("copies", F.least(F.lit(MOST_COPIES), F.col("copies") - F.col("piece") * MOST_COPIES)).drop("piece")
    once = few.unionByName(many).withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return once.select(F.col("id").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS u, position('://' IN coalesce(url, '')) AS cut FROM pages),
q AS (SELECT page_id, CASE WHEN cut > 0 THEN substr(u, cut + 3) ELSE '' END AS rest FROM p),
r AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM q),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (SELECT n, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
  FROM r JOIN rules ON ('.' || host) LIKE ('%.' || rh) AND starts_with(path, rp) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM r LEFT JOIN best USING (n)
"""
