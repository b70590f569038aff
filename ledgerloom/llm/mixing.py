"""Mixing sources to target weights by hierarchical budgets.

Documents form a tree: domain, language, source. The token budget flows from the root to
the leaves in proportion to weights. A node that holds too little keeps what it has, and
its shortage goes to its siblings by their weights; only what all children of a parent
together lack goes on to the parent's own siblings. Every level is closed form: with
children ordered by capacity over weight, those short of their share come first.

A leaf may be read in several epochs, each in an order of its own, given by a hash of
seed, epoch and id. Whole epochs are taken while they fit; of the next one the longest
prefix that fits in tokens. The prefix is found without sorting a leaf: hash prefixes cut
a leaf into buckets of about `BUCKET_ROWS`, sums of buckets find the one in which
the budget ends, and only that one is ordered.

Everything here is DataFrame functions and windows over tree nodes, buckets, or the rows
of one bucket a leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import load, stored

TREE = ("domain", "lang", "source")
#: Weights by name at each level; others have the last one.
DOMAIN_WEIGHTS, OTHER_DOMAIN = {"d0": 40, "d1": 30, "d2": 20, "d3": 10}, 5
LANG_WEIGHTS, OTHER_LANG = {"en": 50, "de": 20, "fr": 20, "es": 10}, 5
SOURCE_WEIGHT = 1
#: Tokens to take, as a percentage of those there are, and epochs of a leaf at most.
BUDGET_PERCENT, EPOCHS, SEED = 60, 2, 42
BUCKET_ROWS = 2000
#: Up to so many leaves (about 100 bytes each) the plan is sent to every task; more leaves are joined by a shuffle.
BROADCAST_LEAVES = 50_000


def domain_of(source: str) -> Column:
    """The domain of a source: d0 to d3 by the number it ends in, else `other`."""
    number = F.regexp_extract(F.col(source), "([0-9]{1,9})$", 1)
    return F.when(F.col(source).isNull() | (number == ""), F.lit("other")).otherwise(F.concat(F.lit("d"), (number.try_cast("int") % 4).cast("string")))


def leaf_columns(lang: str = "lang", source: str = "source") -> dict[str, Column]:
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)"))
    return {"domain": domain_of(source), "lang": named(lang), "source": named(source)}


def words_in(text: str) -> Column:
    """Tokens of a text for budgets: runs of characters that are not white space. Null: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def order_key(doc_id: str, epoch, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.lit(epoch).cast("string") if not isinstance(epoch, Column) else epoch.cast("string"), F.lit(":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def by_name(name: str, weights: dict, other: int) -> Column:
    out = F.lit(other)
    for k, w in weights.items():
        out = F.when(F.col(name) == k, F.lit(w)).otherwise(out)
    return out.cast("long")


def shares(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """`nodes` (parent columns, `name`, `cap`, `weight`, `budget` of the parent) with `share`, never above `cap`."""
    family = Window.partitionBy(*parent)
    before = family.orderBy(F.col("cap") / F.col("weight"), "name").rowsBetween(Window.unboundedPreceding, -1)
    sums = nodes.select("*", F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("_cap"), (F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("_weight"))
    short = sums.withColumn("_short", F.expr("cap * _weight <= (budget - _cap) * weight"))
    rest = short.select("*", (F.col("budget") - F.sum(F.when(F.col("_short"), F.col("cap")).otherwise(0)).over(family)).alias("_left"), F.sum(F.when(F.col("_short"), 0).otherwise(F.col("weight"))).over(family).alias("_heavy"))
    return rest.withColumn("share", F.expr("CASE WHEN _short THEN cap ELSE weight * _left div _heavy END")).drop("_cap", "_weight", "_short", "_left", "_heavy")


def budgets(leaves: DataFrame, percent: int, epochs: int) -> DataFrame:
    """`leaves` (tree columns, `tokens`, `docs`) with `quota`, the tokens to take from each."""
    caps = leaves.select(*TREE, "tokens", "docs", (F.col("tokens") * epochs).alias("cap"))
    total = leaves.agg((F.sum("tokens") * percent).alias("all")).select(F.expr("all div 100").alias("budget"))
    top = caps.groupBy("domain").agg(F.sum("cap").alias("cap")).crossJoin(F.broadcast(total))  # one row
    top = shares(top.select(F.lit(0).alias("root"), F.col("domain").alias("name"), "cap", by_name("domain", DOMAIN_WEIGHTS, OTHER_DOMAIN).alias("weight"), "budget"), ["root"])
    mid = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(top.select(F.col("name").alias("domain"), F.col("share").alias("budget")), "domain")
    mid = shares(mid.select("domain", F.col("lang").alias("name"), "cap", by_name("lang", LANG_WEIGHTS, OTHER_LANG).alias("weight"), "budget"), ["domain"])
    low = caps.join(mid.select("domain", F.col("name").alias("lang"), F.col("share").alias("budget")), ["domain", "lang"])
    low = shares(low.select("domain", "lang", F.col("source").alias("name"), "tokens", "docs", "cap", F.lit(SOURCE_WEIGHT).cast("long").alias("weight"), "budget"), ["domain", "lang"])
    return low.select("domain", "lang", F.col("name").alias("source"), "tokens", "docs", F.col("share").alias("quota"))


def plan(sized: DataFrame, percent: int = BUDGET_PERCENT, epochs: int = EPOCHS, seed: int = SEED, doc_id: str = "doc_id") -> DataFrame:
    """Per leaf: `whole`, its whole epochs, and `cutoff`, the last order key taken in the epoch after.

    `sized` holds the tree columns, the id and `n_tokens`. A leaf without tokens is taken once.
    """
    leaves = stored(sized.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "mix-leaves")
    quotas = budgets(leaves, percent, epochs).select(
        *TREE,
        "docs",
        F.expr("CASE WHEN tokens = 0 THEN 1 ELSE quota div tokens END").cast("int").alias("whole"),
        F.expr("CASE WHEN tokens = 0 THEN 0 ELSE quota % tokens END").alias("rest"),
    )
    quotas = stored(quotas.withColumn("digits", F.ceil(F.greatest(F.lit(0.0), F.log(16.0, F.col("docs") / BUCKET_ROWS))).cast("int")), "mix-quotas")
    small = quotas.count() <= BROADCAST_LEAVES
    partly = quotas.where("rest > 0")
    keyed = sized.join(F.broadcast(partly) if small else partly, [*TREE]).withColumn("key", order_key(doc_id, F.col("whole") + 1, seed))
    keyed = stored(keyed.select(*TREE, "rest", "key", "n_tokens", F.expr("substring(key, 1, digits)").alias("bucket")), "mix-keys")
    sums = keyed.groupBy(*TREE, "rest", "bucket").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy(*TREE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    last = stored(offsets.where("offset <= rest AND offset + n > rest").select(*TREE, "bucket", "offset"), "mix-last")  # one bucket a leaf
    within = Window.partitionBy(*TREE, "bucket").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = keyed.join(F.broadcast(last) if small else last, [*TREE, "bucket"])
    fits = rows.withColumn("upto", F.col("offset") + F.sum("n_tokens").over(within)).where("upto <= rest").groupBy(*TREE).agg(F.max("key").alias("cutoff"))
    ends = last.join(fits, [*TREE], "left").select(*TREE, F.coalesce("cutoff", "bucket").alias("cutoff"))
    return stored(quotas.select(*TREE, "whole").join(ends, [*TREE], "left").select(*TREE, "whole", F.coalesce("cutoff", F.lit("")).alias("cutoff")), "mix-plan")


def taken(rows: DataFrame, leaf_plan: DataFrame, epochs: int, seed: int, doc_id: str) -> DataFrame:
    """`rows` (with the tree columns) once for every epoch that takes them, with `epoch`."""
    small = leaf_plan.count() <= BROADCAST_LEAVES
    own = rows.join(F.broadcast(leaf_plan) if small else leaf_plan, [*TREE])
    own = own.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.least(F.col("whole") + 1, F.lit(epochs)))))
    return own.where((F.col("epoch") <= F.col("whole")) | (order_key(doc_id, F.col("epoch"), seed) <= F.col("cutoff"))).drop("whole", "cutoff")


def mixture(docs: DataFrame, percent: int = BUDGET_PERCENT, epochs: int = EPOCHS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """A row for each document and epoch that the mixture takes: `doc_id`, `domain`, `lang`, `source`, `epoch`, `n_tokens`.

    Null languages and sources are leaves of their own, `(none)`; a null text has no tokens. Rows that share an id
    share their place in the order and are taken or left together. Other columns, whatever their names, are left
    out. An empty table gives no rows.
    """
    leaf = leaf_columns(lang, source)
    sized = stored(docs.select(F.col(doc_id).alias("doc_id"), *(c.alias(k) for k, c in leaf.items()), words_in(text).alias("n_tokens")), "mix-sizes")
    found = taken(sized, plan(sized, percent, epochs, seed), epochs, seed, "doc_id")
    return found.select("doc_id", *TREE, "epoch", "n_tokens")


def mixed(docs: DataFrame, percent: int = BUDGET_PERCENT, epochs: int = 1, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of `docs` that the mixture takes, with their columns as they were, once for each epoch.

    Nulls, repeated ids and texts without tokens count as in `mixture`; a text counts whole, however long. An
    empty table stays empty.
    """
    leaf = leaf_columns(lang, source)
    sized = stored(docs.select(F.col(doc_id).alias("doc_id"), *(c.alias(k) for k, c in leaf.items()), words_in(text).alias("n_tokens")), "mix-sizes")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(doc_id).alias("doc_id"), *(c.alias(k) for k, c in leaf.items()))
    return taken(whole, plan(sized, percent, epochs, seed), epochs, seed, "doc_id").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return mixture(load(spark, sf_dir, "documents"))


SHARES = """
     {0}b AS (SELECT *, CAST(coalesce(sum(cap) OVER (PARTITION BY {1} ORDER BY cap / weight, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS c,
                     CAST(sum(weight) OVER (PARTITION BY {1}) - coalesce(sum(weight) OVER (PARTITION BY {1} ORDER BY cap / weight, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS w FROM {0}a),
     {0}s AS (SELECT *, cap * w <= (budget - c) * weight AS short FROM {0}b),
     {0} AS (SELECT *, CASE WHEN short THEN cap ELSE CAST(weight * (budget - sum(CASE WHEN short THEN cap ELSE 0 END) OVER (PARTITION BY {1})) AS BIGINT)
                    // CAST(sum(CASE WHEN short THEN 0 ELSE weight END) OVER (PARTITION BY {1}) AS BIGINT) END AS share FROM {0}s)"""

ORACLE = (
    r"""
WITH d AS (SELECT doc_id, coalesce('d' || CAST(CAST(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS INTEGER) % 4 AS VARCHAR), 'other') AS domain,
                  coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source, CAST(coalesce(len(regexp_extract_all(text, '[^ \t\n\r]+')), 0) AS BIGINT) AS n_tokens FROM documents),
     leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * 2 AS BIGINT) AS cap FROM d GROUP BY ALL),
     ta AS (SELECT 0 AS root, domain AS name, CAST(sum(cap) AS BIGINT) AS cap, CASE domain WHEN 'd0' THEN 40 WHEN 'd1' THEN 30 WHEN 'd2' THEN 20 WHEN 'd3' THEN 10 ELSE 5 END AS weight,
                   (SELECT CAST(sum(tokens) * 60 AS BIGINT) // 100 FROM leaf) AS budget FROM leaf GROUP BY domain),"""
    + SHARES.format("t", "root")
    + """,
     ma AS (SELECT l.domain, lang AS name, CAST(sum(l.cap) AS BIGINT) AS cap, CASE lang WHEN 'en' THEN 50 WHEN 'de' THEN 20 WHEN 'fr' THEN 20 WHEN 'es' THEN 10 ELSE 5 END AS weight, t.share AS budget
            FROM leaf l JOIN t ON t.name = l.domain GROUP BY l.domain, lang, t.share),"""
    + SHARES.format("m", "domain")
    + """,
     la AS (SELECT l.domain, l.lang, l.source AS name, l.tokens, l.cap, 1 AS weight, m.share AS budget FROM leaf l JOIN m ON m.domain = l.domain AND m.name = l.lang),"""
    + SHARES.format("l", "domain, lang")
    + """,
     q AS (SELECT domain, lang, name AS source, CASE WHEN tokens = 0 THEN 1 ELSE share // tokens END AS whole, CASE WHEN tokens = 0 THEN 0 ELSE share % tokens END AS rest FROM l),
     k AS (SELECT d.*, whole, rest, md5('42:' || CAST(whole + 1 AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM d JOIN q USING (domain, lang, source)),
     p AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM k)
SELECT doc_id, domain, lang, source, CAST(e AS INTEGER) AS epoch, n_tokens FROM p, unnest([1, 2]) AS r(e) WHERE e <= whole OR (e = whole + 1 AND rest > 0 AND upto <= rest)
"""
)
