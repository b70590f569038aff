"""Near-duplicates by shingle similarity against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ledgerloom.llm import similar
from ledgerloom.llm.common import load
from test_groups import DOCS, LONG


def brute_kept(rows):
    """Ids that stay: the smallest of each component of pairs with similarity 0.8 or more."""
    sets = {}
    for i, t in rows:
        words = (t or "").lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(sets)
    for n, a in enumerate(order):
        for b in order[:n]:
            x, y = sets[a], sets[b]
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return sorted(i for i in sets if top(i) == i)


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.randint(0, 999)}"
    return out


def test_stage_drops_edited_copies(spark):
    """Some words of 200 changed: most such pairs differ in more than three bits."""
    import corpus_pipeline

    rng = random.Random(5)
    docs = []
    for i in range(20):
        own = [f"w{rng.randint(0, 5000)}" for _ in range(200)]
        docs += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(edited(rng, own, 2)).upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, df, SMALL)
    assert sorted(r.doc_id for r in found.collect()) == list(range(0, 40, 2)) == brute_kept(docs)


@pytest.mark.parametrize("paired, stars, block", [(16, 2, 1024), (2, 2, 1024), (2, 0, 1024), (2, 0, 8)])
def test_deduplicate_is_brute_force(spark, monkeypatch, paired, stars, block):
    """Without stars every pair of a large group is left to the blocks."""
    compared, real = [], similar.blocked
    for name, value in {"PAIRED": paired, "STARS": stars, "BLOCK": block, "blocked": lambda *a: compared.append(a) or real(*a)}.items():
        monkeypatch.setattr(similar, name, value)
    rng = random.Random(6)
    common = [f"c{i}" for i in range(30)]
    docs = []
    for _ in range(12):
        base = [f"w{rng.randint(0, 300)}" for _ in range(rng.choice([3, 5, 8, 40, 120]))] + common
        for _ in range(10):
            docs.append(" ".join(edited(rng, base, rng.randint(0, 3))))
    docs += [" ".join(common)] * 3 + ["", " \n", None, "a b", "A  b", "a b c d e", "a b c d e f"]
    rows = list(enumerate(docs))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in similar.deduplicate(df).collect()) == brute_kept(rows)
    assert compared or stars


def test_bitmaps_bound_what_is_shared(spark):
    """Of texts of one word to thousands the bound is never too low, and close."""
    rng = random.Random(7)
    texts = ["a"]
    for size in (8, 60, 250, 1000, 4000):
        base = [f"w{rng.randint(0, 9999)}" for _ in range(size)]
        texts += [" ".join(edited(rng, base[: size - size // 9 * k], size // 50)) for k in (0, 0, 1, 2)]
    df = spark.createDataFrame(list(enumerate(texts)), "fp long, text string").coalesce(1)
    rows = sorted(similar.bitmaps(df, 5).collect())
    sets = [similar.shingles(t, 5) for t in texts]
    n = np.array([len(x) for x in sets])
    overlaps = similar.Overlaps([bytes(r.bits) for r in rows], n)
    for x, own in enumerate(sets):
        found = overlaps.most(x, np.arange(len(sets)))
        for k, other in enumerate(sets):
            assert len(own & other) <= found[k]
            if 5 * min(n[x], n[k]) >= 4 * max(n[x], n[k]):
                assert found[k] <= len(own & other) + max(8, n[x] // 5)


def test_table_is_brute_force(spark):
    docs = load(spark, SMALL, "documents")
    kept = similar.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_odd_rows(spark):
    rows = [(1, "some plain text here", "en", "s", "x", "y"), (1, "some plain text here", "en", "s", "x", "y"), (1, "another text with that id", "en", "s", "x", "y"), (None, "no id at all", None, None, None, None), (None, None, None, None, None, None), (4, "", "de", "s", "", ""), (6, LONG, "en", "s", None, "y")]
    odd = spark.createDataFrame(rows, DOCS)
    kept = similar.deduplicate(odd)
    assert sorted((str(r.doc_id), r.text[:5]) for r in kept.collect()) == [("1", "anoth"), ("1", "some "), ("4", ""), ("6", "word "), ("None", "no id")]
    assert similar.deduplicate(odd.limit(0)).count() == 0


def test_texts_that_share_a_hash_are_told_apart(spark):
    rows = spark.createDataFrame([(1, 5, 10), (2, 5, 10), (3, 5, 11), (4, 5, 12), (5, 6, 10)], "doc_id long, fp long, fp_more long")
    several = similar.shared(rows)
    assert several.collect() == [(5, 10)]
    fp = {r.doc_id: r.fp for r in similar.told_apart(rows, several).collect()}
    assert fp[1] == fp[2] == 5 and fp[5] == 6 and len({fp[1], fp[3], fp[4]}) == 3
    assert similar.shared(rows.where("doc_id IN (1, 2, 5)")).isEmpty()


def test_of_equal_ids_and_texts_one_certain_row_stays(spark):
    rows = [(1, "the same text", f"s{i}") for i in range(20)]
    kept = {similar.deduplicate(spark.createDataFrame(random.Random(seed).sample(rows, 20), "doc_id long, text string, source string").repartition(4)).collect()[0].source for seed in range(3)}
    assert len(kept) == 1


def test_a_sieve_holds_back_only_strangers(spark):
    from ledgerloom.llm import common

    keys = common.stored(spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("k")), "keys")
    rows = spark.range(3000).select("id", F.concat(F.lit("k"), "id").alias("own"))
    found = {r.id: r._may for r in common.sieved(rows, "own", keys).collect()}
    assert len(found) == 3000 and all(found[i] for i in range(0, 3000, 3)) and sum(found.values()) < 1300
    assert not any(r._may for r in common.sieved(rows, "own", common.stored(keys.limit(0), "keys")).collect())


def test_a_text_travels_once_for_a_passage(spark):
    """Twenty shingles of one passage were twenty groups of the same texts. Groups that hardly overlap stay apart."""
    passage = [(h, fp, 100, 5 + h % 7, fp, 40) for h in range(20) for fp in range(40)]
    low = spark.range(1000, 2000).orderBy(F.xxhash64("id", F.lit("cell"))).first().id
    apart = [(h, fp, 100, h, fp, 30) for h in range(50, 60) for fp in [low, *range(h * 100, h * 100 + 29)]]
    rows = spark.createDataFrame(passage + apart, "h long, fp long, n int, at int, root long, m long")
    found = similar.dealt(rows).collect()
    joint = [r for r in found if r.fp < 40]
    assert sorted(r.fp for r in joint) == list(range(40)) and {(r.m, r.at) for r in joint} == {(40, 5)} and len({(r.cell, r.h) for r in joint}) == 1
    others = [r for r in found if r.fp >= 40]
    together = {(r.cell, r.h) for r in others}
    assert {r.fp for r in others} == {r[1] for r in apart}
    for a in apart:  # whoever met meets still
        assert any(r.fp == a[1] and r.at <= a[3] for r in others if any(x.fp == low and (x.cell, x.h) == (r.cell, r.h) for x in others))
    assert len(together) == 10 and {r.m for r in others} == {30}


def test_large_working_tables_go(spark):
    from ledgerloom.sources.folders import children, shared_folder

    before = set(children(spark, shared_folder(spark)))
    kept = similar.deduplicate(spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f"), (3, "other")], "doc_id long, text string"))
    new = set(children(spark, shared_folder(spark))) - before
    assert new and not any(x.startswith(("similar-texts", "similar-shingles", "similar-needed")) for x in new)
    assert not any(x.startswith("similar-") and x.count("-") == 1 for x in new)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
