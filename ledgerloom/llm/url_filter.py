"""URL filters: host and path rules, and pattern rules found by their rarest literal token.

A pattern rule is a regular expression. From it follow the tokens, whole runs of letters
and digits, that every URL holds which it matches. Each rule is filed under the one of its
tokens that the fewest URLs hold, counted over all of them. The tokens of a URL fetch candidate rules by an
equi-join, and only those run their regular expression. Host rules work alike: their
tokens are whole host suffixes, which every URL lists from its own host.

But for the tokens of the rules, everything here is DataFrame functions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load, stored

#: (host, path, verdict): the rule fits the host and its subdomains where the path starts with `path`.
HOST_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Pattern rules, for URLs that no host rule fits; the longest pattern wins. Every word in every shape is blocked.
WORDS = (
    "adserver adult bannerads bet betting bingo blackjack bonus casino cheap cialis clickbait crack credit dating diet escort exploit forex free freebie gamble gambling hack hentai jackpot keygen "
    "loan lottery malware miner nude payday phish phishing pharmacy pills pixel poker popup porn prize promo rolex roulette sex slots spam spyware stream strip sweepstakes "
    "torrent track tracker trojan viagra virus warez webcam win xxx"
).split()
SHAPES = [
    r"[/._-]{w}[/._-]", r"://{w}\.", r"://([^/?#]*\.)?{w}\.[^/]*/", r"/{w}/[0-9]+", r"/{w}-[a-z]+/", r"/{w}\.(html|php|asp)", r"[?&]{w}=", r"[?&](q|tag|cat|ref)={w}(&|#|$)", r"[?&][a-z_]+={w}(&|#|$)", r"#{w}([/&=]|$)",
    r"/(go|out|click|redirect)/{w}/", r"[?&]url=https?(:|%3A)(/|%2F)+([^/]*\.)?{w}\.", r"/online-{w}-", r"/best-{w}-", r"/{w}_[0-9]+\.", r"/tag/{w}([/?#]|$)", r"/category/{w}([/?#]|$)", r"\.{w}\.(com|net|org|info|biz)/", r"-{w}-(online|free|now|today)[/.]", r"/{w};",
]
OTHER_RULES = [
    (r"/wp-login\.php", "block"),
    (r"[?&]utm_source=feed(&|#|$)", "block"),
    (r"\.exe([?#]|$)", "block"),
    (r"\.msi([?#]|$)", "block"),
    (r"/blog/.*[?&]page=[0-9]+", "allow"),
]
PATTERN_RULES = [(shape.replace("{w}", word), "block") for word in WORDS for shape in SHAPES] + OTHER_RULES
DEFAULT_VERDICT = "allow"
#: Up to so many rules are sent to every task; more are joined by a shuffle on the token.
BROADCAST_RULES = 10_000


def is_letter(char: str) -> bool:
    return char.isascii() and char.isalnum()


def never_letters(members: Iterable) -> bool:
    """Whether a parsed set of characters holds no ASCII letter or digit."""
    return all((str(op) == "LITERAL" and not is_letter(chr(arg))) or (str(op) == "RANGE" and not any(is_letter(chr(c)) for c in range(arg[0], min(arg[1], 127) + 1))) for op, arg in members)


def is_border(op: str, arg) -> bool:
    """Whether a parsed item takes exactly one character, never a letter or digit, or is the end of the URL."""
    return op == "LITERAL" and not is_letter(chr(arg)) or op == "IN" and never_letters(arg) or op == "AT" and str(arg) == "AT_END"


def literals_of(pattern: str) -> list[str]:
    """Tokens that a URL must hold for `pattern` (in the syntax that Java and Python share) to match, lower-cased.

    A token counts if the pattern always has it, with a border on both sides: a character that can't go on with it,
    or the start or end. What may be missing or have other forms is passed over, so some tokens may be missed.
    """
    found, run, border = [], None, False  # the letters of a token so far; None if one that began without a border goes on

    def close(whole: bool) -> None:
        nonlocal run
        if whole and run:
            found.append(run.lower())
        run = None

    def walk(items) -> None:
        nonlocal run, border
        for op, arg in items:
            op = str(op)
            if op == "LITERAL" and is_letter(chr(arg)):
                run = chr(arg) if border else run + chr(arg) if run else None
                border = False
            elif is_border(op, arg):
                close(True)
                border = True
            elif op == "AT" and str(arg).startswith("AT_BEGINNING"):
                border = True
            elif op == "SUBPATTERN":
                walk(arg[-1])
            elif op == "BRANCH":
                ways = [list(way) for way in arg[1]]
                close(all(way and is_border(str(way[0][0]), way[0][1]) for way in ways))
                border = all(way and is_border(str(way[-1][0]), way[-1][1]) for way in ways)
            elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                least, _, inner = arg
                inner = list(inner)
                plain = len(inner) == 1 and str(inner[0][0]) != "AT" and is_border(str(inner[0][0]), inner[0][1])
                last = inner
                while last and str(last[-1][0]) == "SUBPATTERN":
                    last = list(last[-1][1][-1])
                ends = plain or bool(last) and is_border(str(last[-1][0]), last[-1][1])
                close(plain and least > 0)
                border = ends and (least > 0 or border)
            else:
                close(False)
                border = False

    walk(re._parser.parse(pattern))
    return list(dict.fromkeys(found))


@F.pandas_udf(T.ArrayType(T.StringType()))
def literals(patterns: pd.Series) -> pd.Series:
    return patterns.map(literals_of)


def upper_to_lower(column):
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_parts(pages: DataFrame, url: str) -> DataFrame:
    """`pages` with `host` and `path`. Null urls, and urls without `://`, have neither (empty strings)."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return pages.withColumn("host", upper_to_lower(host)).withColumn("path", F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0))


def tokens(url: str):
    """Different runs of ASCII letters and digits of a URL, lower-cased."""
    words = F.split(upper_to_lower(F.coalesce(F.col(url), F.lit(""))), "[^a-z0-9]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def filed_rules(rules: DataFrame, urls: DataFrame, url: str) -> DataFrame:
    """Each rule (`pattern`, `verdict`, `literals`) with `token`, the rarest of its literals over all urls. A rule without one could only run on every url, and is an error."""
    named = rules.select("pattern", F.explode(F.when(F.size("literals") > 0, F.col("literals")).otherwise(F.array(F.raise_error(F.concat(F.lit("no literal token in "), "pattern")).cast("string")))).alias("token"))
    wanted = named.select("token").distinct()
    counts = urls.select(F.explode(tokens(url)).alias("token")).join(wanted, "token", "left_semi").groupBy("token").count()
    rarest = Window.partitionBy("pattern").orderBy("n", "token")
    filed = named.join(counts, "token", "left").select("pattern", "token", F.coalesce("count", F.lit(0)).alias("n")).withColumn("place", F.row_number().over(rarest)).where("place = 1")
    return rules.select("pattern", "verdict").join(filed.select("pattern", "token"), "pattern")


def candidates(urls: DataFrame, filed: DataFrame) -> DataFrame:
    """The rules whose regular expression runs on a url: those filed under one of its tokens."""
    return urls.select("url", F.explode(tokens("url")).alias("token")).join(filed, "token")


def judged(pages: DataFrame, host_rules: list = HOST_RULES, pattern_rules: list | DataFrame = PATTERN_RULES, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """`pages` with `host`, `path`, `rule` (a host rule such as `net/`, or null), `pattern` and `verdict`.

    `pattern_rules` are (pattern, verdict), in a list or a table of any size. The longest host rule that fits
    decides; else the longest pattern that matches (of equally long ones the last); else `default`. Null and
    malformed urls have an empty host and path, which no host rule fits; urls without any token fetch no
    pattern rule. Each different url is judged once, however often or in however long a form it occurs, and the
    judgement of those that a rule fits joined to their rows; null urls go past the join. Columns of `pages` with
    the names of new ones are replaced, all others kept. An empty table gives no rows.
    """
    spark: SparkSession = pages.sparkSession
    new = ["host", "path", "rule", "pattern", "verdict"]
    pages = pages.drop(*new)
    urls = pages.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    hosts = spark.createDataFrame([(h, p, v, h + p) for h, p, v in host_rules], "suffix string, prefix string, rule_verdict string, rule string")
    patterns = pattern_rules.select("pattern", "verdict") if isinstance(pattern_rules, DataFrame) else spark.createDataFrame(pattern_rules, "pattern string, verdict string")
    patterns = stored(patterns.distinct().withColumn("literals", literals("pattern")), "url-rules")

    parts = with_parts(urls, "url")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = parts.select("url", "host", "path", F.explode(suffixes).alias("suffix"))
    fitting = asked.join(hosts, "suffix").where(F.startswith("path", "prefix"))
    by_host = fitting.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("long"), "rule", F.col("rule_verdict").alias("verdict"))).alias("h"))

    filed = filed_rules(patterns, urls, "url")
    filed = F.broadcast(filed) if patterns.count() <= BROADCAST_RULES else filed
    matching = candidates(urls, filed).where(F.expr("url RLIKE pattern"))
    by_pattern = matching.groupBy("url").agg(F.max(F.struct(F.length("pattern").alias("long"), "pattern", "verdict")).alias("p"))

    own = "_url"
    while own in pages.columns:
        own += "_"
    known = by_host.join(by_pattern, "url", "full_outer").select(
        F.col("url").alias(own), F.col("h.rule").alias("rule"), F.when(F.col("h").isNull(), F.col("p.pattern")).alias("pattern"), F.coalesce("h.verdict", "p.verdict").alias("verdict")
    )
    known = stored(known, "url-judgements")
    whole = with_parts(pages, url)
    found = whole.where(F.col(url).isNotNull()).join(known, F.col(url) == F.col(own), "left").drop(own)
    nameless = whole.where(F.col(url).isNull()).select("*", *(F.lit(None).cast("string").alias(c) for c in ("rule", "pattern", "verdict")))
    return found.unionByName(nameless).withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def query(spark, sf_dir: str) -> DataFrame:
    return judged(load(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "pattern")


def quoted(texts: Iterable[str]) -> str:
    return ", ".join(f"('{t}')" for t in texts)


ORACLE = r"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
     p AS (SELECT page_id, url, row_number() OVER () AS n, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
     j AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                          WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                          WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                          WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM p),
     r AS (SELECT replace(shape, '{w}', word) AS pattern, 'block' AS verdict FROM (VALUES <shapes>) s(shape), (VALUES <words>) w(word) UNION ALL SELECT * FROM (VALUES <others>) o(pattern, verdict)),
     m AS (SELECT n, pattern, r.verdict, row_number() OVER (PARTITION BY n ORDER BY length(pattern) DESC, pattern DESC) AS place FROM j JOIN r ON regexp_matches(url, pattern) WHERE rule IS NULL)
SELECT page_id, host, path, rule, pattern, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' ELSE coalesce(m.verdict, 'allow') END AS verdict
FROM j LEFT JOIN m ON m.n = j.n AND place = 1
""".replace("<shapes>", quoted(SHAPES)).replace("<words>", quoted(WORDS)).replace("<others>", ", ".join(f"('{p}', '{v}')" for p, v in OTHER_RULES))
