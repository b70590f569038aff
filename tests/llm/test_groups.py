"""Top-k, SimHash, mixing and the pipeline against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import LARGE, SMALL
from ledgerloom.llm import mixing, simhash, topk
from ledgerloom.llm.common import load
from test_text_operators import DOCS, LONG, contamination_of


def brute_top_k(rows, queries, k):
    out = set()
    for q, v in queries:
        scored = sorted((-int(np.dot(v, x)), i) for i, x in rows if i != q and len(x) == len(v))
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_top_k_is_brute_force(spark, block):
    rng = np.random.default_rng(1)
    raw = [(i, [float(x) for x in rng.integers(-3, 4, 13) / 512 + (i % 7 == 0)]) for i in range(700)] + [(900, [0.5] * 5), (901, [0.25] * 5)]
    odd = [(1000, None), (1100, [1.0, None]), (1200, [float("nan")] * 13), (1300, [float("inf")] * 13), (None, [1.0] * 13), (1400, [])]
    df = topk.scaled(spark.createDataFrame(raw + odd, "vec_id long, embedding array<float>").repartition(5), "vec_id", "embedding")
    rows = [(i, np.floor(1024 * np.array(v, np.float32).astype(np.float64))) for i, v in raw]
    found = topk.top_k(df.where("vec_id % 100 = 0"), df, block=block)
    assert {tuple(r) for r in found.collect()} == brute_top_k(rows, [r for r in rows if r[0] % 100 == 0], 10)


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, v array<double>")
    assert [tuple(r) for r in topk.top_k(df.where("vec_id = 0"), df).collect()] == [(0, 1, 1, 2)]
    assert topk.top_k(df.limit(0), df).count() == 0 and topk.top_k(df, df.limit(0)).count() == 0


def test_top_k_with_repeated_ids(spark):
    """Rows that repeat a candidate's id count each; ties go to smaller ids; a query's own id never answers."""
    rows = [(0, [1.0, 1.0]), (0, [2.0, 2.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    found = topk.top_k(df.where("vec_id = 0"), df, k=3)
    assert sorted((r.rank, r.vec_id, r.score) for r in found.collect()) == [(1, 1, 1), (2, 1, 1), (3, 2, 1)]
    with pytest.raises(Exception, match="2\\*\\*53"):
        topk.top_k(df.where("vec_id = 0"), df.withColumn("v", F.transform("v", lambda x: x * 1e9 * 1e9))).collect()


def test_bounds_leave_few_pairs(spark):
    """On the given vectors, which spread evenly over a sphere, only the finest level tells much."""
    rows = topk.scaled(load(spark, LARGE, "embeddings"), "vec_id", "embedding").collect()
    [(d, (ids, vectors))] = topk.by_size(rows).items()
    asked = ids % 100 == 0
    seeds = np.argsort(-np.linalg.norm(vectors, axis=1), kind="stable")[: topk.SEEDS]
    block = topk.Block(ids[asked], vectors[asked], 10, topk.floors(ids[asked], vectors[asked], (ids[seeds], vectors[seeds]), 10))
    block.offer(ids, vectors)
    shares = [n / block.pairs for n in block.survived]
    assert shares == sorted(shares, reverse=True) and shares[-1] <= 0.65, shares


def brute_components(fps):
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    order = sorted(fps)
    for i, a in enumerate(order):
        for b in order[:i]:
            if (a ^ b).bit_count() <= 3:
                label[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in fps}


def flipped(rng, f, n):
    for bit in rng.sample(range(64), n):
        f ^= 1 << bit
    return f


@pytest.mark.parametrize("bucket", [2048, 9])
def test_links_keep_every_component(spark, bucket):
    rng = random.Random(7)
    fps = {0, 2**64 - 1}
    for _ in range(3):
        center = rng.getrandbits(64)
        fps |= {flipped(rng, center, rng.randint(0, 3)) for _ in range(40)}
        chain = rng.getrandbits(64)
        for _ in range(25):
            fps.add(chain)
            chain = flipped(rng, chain, 3)
    fps |= {rng.getrandbits(64) for _ in range(300)}
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    roots = {r.fp: r.root for r in simhash.components(simhash.links(df, bucket)).collect()}
    ours, theirs = {}, {}
    for f, want in brute_components(fps).items():
        ours.setdefault(roots.get(simhash.signed(f), simhash.signed(f)), set()).add(f)
        theirs.setdefault(want, set()).add(f)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def plain_fingerprint(text):
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_near_duplicates(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    root = brute_components({f for _, f in fps})
    low = {}
    for i, f in fps:
        low[root[f]] = min(low.get(root[f], i), i)
    return {i: (f, low[root[f]]) for i, f in fps}


def test_near_duplicates_are_brute_force(spark):
    docs = load(spark, SMALL, "documents")
    want = brute_near_duplicates([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    found = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in found} == want
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "some plain text here", "en", "s", "x", "y"), (1, "some plain text here", "en", "s", "x", "y"), (1, "another text with that id", "en", "s", "x", "y"), (None, "no id at all", None, None, None, None), (None, "no id at all", None, None, None, None), (None, None, None, None, None, None), (4, "", "de", "s", "", ""), (6, LONG, "en", "s", None, "y")]
    odd = spark.createDataFrame(rows, DOCS)
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == 8 and {r.component_id for r in found if r.fp == 0} == {4}
    kept = simhash.deduplicate(odd)
    assert sorted((str(r.doc_id), r.text[:5]) for r in kept.collect()) == [("1", "anoth"), ("1", "some "), ("4", ""), ("6", "word "), ("None", "no id")]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0 and simhash.deduplicate(odd.limit(0)).count() == 0


def test_long_texts_have_the_same_fingerprint_by_either_count():
    rng = random.Random(4)
    for n in (1, 2, 3, 50, 65, 66, 67, 500):
        text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n))
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_shortages_go_to_siblings_first(spark):
    leaves = [("d0", "en", "a1", 100), ("d0", "en", "a2", 100_000), ("d0", "de", "a1", 50), ("d1", "en", "b1", 20_000)]
    df = spark.createDataFrame([(*x, 1) for x in leaves], "domain string, lang string, source string, tokens long, docs long")
    quota = {(r.domain, r.lang, r.source): r.quota for r in mixing.budgets(df, 10, 1).collect()}
    budget = sum(x[3] for x in leaves) * 10 // 100
    assert quota["d0", "en", "a1"] == 100 and quota["d0", "de", "a1"] == 50
    assert quota["d0", "en", "a2"] == budget * 40 // 70 - 150  # what d0 is due stays in d0
    assert budget - len(leaves) <= sum(quota.values()) <= budget


def test_mixture_of_odd_rows(spark, monkeypatch):
    rows = [(i, "w " * (i % 5), "en" if i % 3 else None, f"src{i % 2}" if i % 7 else None, "x", "y") for i in range(200)] + [(None, "a b", "en", "src0", None, None), (None, None, None, None, None, None), (3, "w " * 3, None, "src1", "x", "y")]
    docs = spark.createDataFrame(rows, DOCS)
    whole = sorted(tuple(map(str, r)) for r in mixing.mixture(docs).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)  # many buckets, the same prefix
    assert sorted(tuple(map(str, r)) for r in mixing.mixture(docs).collect()) == whole
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert mixing.mixture(docs.limit(0)).count() == 0
    assert mixing.mixture(docs, percent=200, epochs=2).where("n_tokens > 0").count() == 2 * docs.where("text LIKE '%w%' OR text LIKE '%a%'").count()


def test_pipeline_of_odd_and_empty_tables(spark):
    """Every stage but the last keeps all columns, whatever they hold and are called."""
    import corpus_pipeline

    names = ["fp", "row", "h", "root", "n_hit", "tox_flag", "c0", "key", "low", "doc", "seq", "part", "hash_1", "epoch", "fp_more"]
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, "some plain text here", "en", "s1", 20), (1, "some plain text here", "en", "s1", 20), (1, "another text", "en", "s1", 12), (None, "no id at all", None, None, None), (None, None, None, None, None), (4, "", "de", "s2", 0), (5, None, "fr", None, 1), (6, long, "en", "s1", None), (7, "\n \t 12 !! ", None, "s2", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(f"{c} kept") for c in names})
    for df in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            n = df.count()
            out = stage(spark, df, SMALL)
            if name == "token_ids":
                assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == n
            else:
                assert out.columns == docs.columns and out.count() <= n
                assert n == 0 or name == "source_mixing" or out.where("text LIKE 'w0 w1 %'").count() == 1
                assert all(r[c] == f"{c} kept" for r in out.select(names).collect() for c in names)
            if name == "simhash_near_dedup" and n:
                assert sorted(str(r.doc_id) for r in out.select("doc_id").collect()) == ["1", "1", "4", "6", "7", "None"]
            df = out


def test_mixture_counts_long_texts_whole(spark):
    docs = spark.createDataFrame([(1, "w " * 300_000, "en", "src0"), (2, "w " * 100_000, "en", "src1")], "doc_id long, text string, lang string, source string")
    assert sorted(r.n_tokens for r in mixing.mixture(docs, percent=200, epochs=2).where("epoch = 1").collect()) == [100_000, 300_000]


def test_pipeline_is_its_stages_by_brute_force(spark):
    import corpus_pipeline
    from ledgerloom.llm import toxicity
    from test_similar import brute_kept

    docs = load(spark, SMALL, "documents").collect()
    model = toxicity.fit(load(spark, SMALL, "documents"), toxicity.training_labels(load(spark, SMALL, "labels")))
    scorer = toxicity.Scorer(model)
    scores, _ = scorer.scores(pa.array([r.text or "" for r in docs]))
    left = [r for r, score in zip(docs, scores) if score < toxicity.THRESHOLD]
    lowest = set(brute_kept([(r.doc_id, r.text) for r in left]))
    left = [r for r in left if r.doc_id in lowest]
    items = [(r.item_id, r.text) for r in load(spark, SMALL, "benchmark").collect()]
    left = [r for r in left if contamination_of(r.text, items)[1] == 0]
    mixed = mixing.mixed(spark.createDataFrame(left, load(spark, SMALL, "documents").schema))
    want = sorted(r.doc_id for r in mixed.collect())
    found = corpus_pipeline.run(spark, SMALL)
    assert [r.doc_id for r in found.orderBy("start").collect()] == want
    assert found.agg(F.max(F.col("start") + F.col("n_tokens")) == F.sum("n_tokens")).first()[0]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_ids"]
