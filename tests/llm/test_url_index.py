"""The index of pattern rules against every rule on every URL."""

import random
import re

from pyspark.sql import functions as F

from conftest import LARGE
from ledgerloom.llm import url_filter


def test_index_is_every_rule_on_every_url(spark):
    urls = ["http://x.com/wp-login.php5", "http://x.com/wp-login.phpx?a=1", "http://x.com/wp-login.php", "http://x.com/my-wp-login.php", "http://x.com/wp/login/", "http://y.com/wp-login", "http://x.com/casino/1", "http://x.com/casinos/", "http://x.com/a?utm_source=feed", "http://x.com/a?utm_source=feeds", "http://x.com/blog/a?page=12b", "http://x.com/a.msi?x"]
    for own in (urls, [u for u in urls if not u.endswith(".php")]):  # in the second list php never stands alone
        found = url_filter.judged(spark.createDataFrame([(u,) for u in own], "url string")).collect()
        fits = {u: [(len(p), p, v) for p, v in url_filter.PATTERN_RULES if re.search(p, u)] for u in own}
        want = {u: max(m)[1:] if m else (None, url_filter.DEFAULT_VERDICT) for u, m in fits.items()}
        assert {r.url: (r.pattern, r.verdict) for r in found} == want


def test_literals_are_in_every_match():
    """Tokens of patterns by hand, and of all rules against urls made to match."""
    cases = {r"/wp-login\.php": ["wp", "login"], r"[/._-]casino[/._-]": ["casino"], r"[?&]utm_source=feed(&|#|$)": ["utm", "source", "feed"], r"/blog/.*[?&]page=[0-9]+": ["blog", "page"], r"\.exe$": ["exe"], r"/a?b/": [], r"/ab+/c/": ["c"], r"/x(a|b)y/": [], r"://([^/]*\.)?win\.": ["win"], r"://([^/]*)?win\.": [], r"/(one|two)/three/": ["three"], r"^abc/": ["abc"], r"/[a-f]x/": [], r"-(now|/)": [], r"(/red)/": ["red"], r"/A1/": ["a1"], r"_?win/": []}
    assert {p: url_filter.literals_of(p) for p in cases} == cases
    for pattern, _ in url_filter.PATTERN_RULES:
        assert url_filter.literals_of(pattern)
    rng = random.Random(2)
    alphabet = ["win", "casino", "/", ".", "-", "_", "?", "&", "=", "#", "://", "x", "q", "tag", "7", "php", "com", "online", "free", "url", "https", "%3A", "%2F", "best", "go", "category", ";"]
    rules = [(p, url_filter.literals_of(p)) for p, _ in url_filter.PATTERN_RULES if "win" in p or "casino" in p]
    hits = 0
    for _ in range(40_000):
        url = "http://" + "".join(rng.choices(alphabet, k=rng.randint(1, 9)))
        own = set(re.findall("[a-z0-9]+", url.lower()))
        for p, words in rules:
            if re.search(p, url):
                hits += 1
                assert own.issuperset(words), (p, url)
    assert hits > 500


def test_few_rules_run_on_a_url(spark):
    """Of over a thousand rules the tokens of a url fetch less than one in a hundred."""
    urls = spark.read.parquet(f"{LARGE}/pages.parquet").select("url").where("url IS NOT NULL").distinct()
    rules = spark.createDataFrame(url_filter.PATTERN_RULES, "pattern string, verdict string").withColumn("literals", url_filter.literals("pattern"))
    runs, n = url_filter.candidates(urls, url_filter.filed_rules(rules, urls, "url")).count(), urls.count()
    assert len(url_filter.PATTERN_RULES) > 1000 and 0 < runs < 0.01 * n * len(url_filter.PATTERN_RULES)


def test_rules_from_a_table(spark):
    rules = spark.range(3000).select(F.concat(F.lit("/w"), "id", F.lit("/")).alias("pattern"), F.when(F.col("id") % 2 == 0, "block").otherwise("allow").alias("verdict"))
    urls = spark.createDataFrame([("http://a.com/w12/",), ("http://a.com/w13/x",), ("http://a.com/w2999/",), ("http://a.com/w12",), ("http://a.com/w12/w1113/",)], "url string")
    found = {r.url: (r.pattern, r.verdict) for r in url_filter.judged(urls, pattern_rules=rules, default="?").collect()}
    assert found == {"http://a.com/w12/": ("/w12/", "block"), "http://a.com/w13/x": ("/w13/", "allow"), "http://a.com/w2999/": ("/w2999/", "allow"), "http://a.com/w12": (None, "?"), "http://a.com/w12/w1113/": ("/w1113/", "allow")}
