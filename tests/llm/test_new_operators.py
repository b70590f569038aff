"""Packing, the Merkle manifest and tokenizer alignment against plain versions, and on odd tables."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL, compare
from ledgerloom.llm import alignment, bpe, merkle, packing
from ledgerloom.llm.registry import QUERIES

LONG = ("Some words, and 12 numbers.\nThe next line isn't long. " * 6000).strip()
ODD = [
    (5, "Plain words here.", "en", "s1", 17), (5, "Plain words here.", "en", "s1", 17), (7, None, "en", "s1", None), (None, "no id", None, None, 3), (9, "", "de", "s:2", 0),
    (11, "two  spaces and <|endoftext|> </s>", "", "s1", 1), (12, "a▁b", "fr", None, 3), (13, LONG, "en", "s1", len(LONG)), (14, " \n\t ", None, "s", -1), (15, "漢字 é ﬁ x", "fr", "s", 2**62), (21, "x", "en", "s1", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    clashing = ("block", "place", "pair", "planes", "seq", "part", "level", "ids", "_first", "g", "pos", "n", "leaf", "changed", "_tie", "_at", "_part", "hash", "tag")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(clashing)}).repartition(3)


# Packing.


def plain_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.vocabulary(packing.TOKENIZER))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check_pieces(rows, docs, length=packing.LENGTH):
    """Every id of every document is in one piece and sequences are gapless; returns the lengths of the sequences."""
    encode, own, by_sequence = plain_ids(), defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    expected = defaultdict(list)
    for doc_id, text in docs:
        expected[doc_id].append(encode(text))
    assert set(own) == set(expected)
    for doc_id, texts in expected.items():
        if len({tuple(t) for t in texts}) == 1:
            pieces = sorted(own[doc_id], key=lambda r: r.start)
            assert sum(p.length for p in pieces) == sum(map(len, texts))
            for p in pieces:
                ids = np.array(texts[0][p.start : p.start + p.length], "<u4")
                assert len(ids) == p.length and p.ids_crc32 == zlib.crc32(ids.tobytes()) and p.doc_tokens == len(texts[0])
            covered = Counter(i for p in pieces for i in range(p.start, p.start + p.length))
            assert covered == {i: len(texts) for i in range(len(texts[0]))}
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return [sum(p.length for p in pieces) for pieces in by_sequence.values()]


def padding(sizes, length=packing.LENGTH):
    return sum(length - n for n in sizes if n & (n - 1))


def test_packing_of_a_table(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    sizes = check_pieces(packing.query(spark, MEDIUM).collect(), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert padding(sizes) < 0.002 * sum(sizes)


def test_packing_keeps_most_documents_whole(spark):
    rows = packing.query(spark, MEDIUM).collect()
    short = [r.doc_id for r in rows if r.doc_tokens <= packing.LENGTH]
    assert len(short) - len(set(short)) < 0.25 * len(set(short))


def test_packing_merges_leftovers_in_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 3)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(11, "doc_id")
    rows = packing.pack(docs, length=256, windows=4).collect()
    sizes = check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], 256)
    assert padding(sizes, 256) < 0.08 * sum(sizes)


def test_packing_of_odd_rows(spark, odd):
    sizes = check_pieces(packing.pack(odd).collect(), [(r[0], r[1]) for r in ODD])
    assert max(sizes) == packing.LENGTH
    assert packing.pack(odd.limit(0)).count() == 0
    assert packing.pack(odd.where("doc_id = 9")).drop("ids").collect() == [(9, 0, 1, zlib.crc32(b"\x02\0\0\0"), 1, 0, 0)]


def test_sequences_to_train_on(spark):
    pieces = packing.pack(spark.read.parquet(f"{SMALL}/documents.parquet")).cache()
    rows = packing.sequences(pieces).collect()
    held = {(p.sequence_id, p.offset): p.ids for p in pieces.collect()}
    assert len(rows) == pieces.select("sequence_id").distinct().count()
    for r in rows:
        joined = b"".join(bytes(v) for (s, _), v in sorted(held.items()) if s == r.sequence_id)
        assert r.n_tokens * 2 == len(joined) and sum(r.lengths) == r.n_tokens
        assert bytes(r.ids) == (joined if r.n_tokens & (r.n_tokens - 1) == 0 else joined.ljust(2 * packing.LENGTH, b"\0"))


def test_packer_bounds():
    rng = random.Random(4)
    packer = packing.Packer(64, 5, 4)
    closed = []
    for d in range(3000):
        n = rng.choice([1, 2, 3, 10, 33, 63, 64, 65, 200])
        closed += packer.add(packing.Piece(d, 0, n, np.zeros(n, "<u2")))
        assert len(packer.rooms) <= 5 and packer.rooms == sorted(packer.rooms) and {x for _, x in packer.rooms} == set(packer.open)
    sizes = [sum(len(p.ids) for p in w) for w in closed]
    assert max(sizes) <= 64 and min(sizes) > 64 - 4
    rest = packing.divided(packer.left(), 64)
    assert all(n & (n - 1) == 0 for n in (sum(len(p.ids) for p in w) for w in rest))


# Merkle manifest.


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_root(nodes):
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0]


def plain_proof(nodes, at):
    out = []
    while len(nodes) > 1:
        out += [nodes[i] for i in (at ^ 1,) if i < len(nodes)]
        nodes, at = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], at // 2
    return out


def plain_manifest(rows):
    """Every tampered leaf put into a copy of the whole tree."""
    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    leaf = lambda r, more=0: plain_leaf((r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text))
    trees = {g: sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r))) for g in order}
    leaves = {g: [leaf(r) for r in trees[g]] for g in order}
    subroots = [plain_root(leaves[g]) for g in order]
    root, out = plain_root(subroots), []
    for i, g in enumerate(order):
        for at, r in enumerate(trees[g]):
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            changed = list(leaves[g])
            changed[at] = leaf(r, int(tampered))
            now = plain_root([*subroots[:i], plain_root(changed), *subroots[i + 1 :]])
            proof = h(*plain_proof(leaves[g], at), *plain_proof(subroots, i))
            out.append((r.doc_id, leaves[g][at], subroots[i], root, proof, now, now == root))
    return sorted(out, key=str)


def test_manifest_against_sql(spark):
    compare(spark, merkle.query, merkle.ORACLE, SMALL)


def test_manifest_of_odd_rows(spark, odd):
    assert sorted(map(tuple, merkle.manifest(odd).collect()), key=str) == plain_manifest(spark.createDataFrame(ODD, SCHEMA).collect())
    assert merkle.manifest(odd.limit(0)).count() == 0
    one = odd.where("doc_id = 21")
    [r] = merkle.manifest(one).collect()
    assert r.leaf == r.subroot and r.root == r.subroot and r.proof_sha256 == h()


@pytest.mark.parametrize("n", [1, 2, 5, 9, 17, 33])
def test_manifest_of_small_blocks(spark, n):
    """Blocks of four leaves, so that there are several levels of blocks and many languages."""
    rows = [(i, f"t{i}", f"l{i % 6}" if i % 11 else "l0", "s", i) for i in range(n * 4)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, merkle.manifest(df, height=2).collect()), key=str) == plain_manifest(df.collect())


def test_versions_share_all_but_their_path():
    leaves = [h(str(i)) for i in range(13)]
    tree = merkle.Tree(leaves, 4)
    before = [list(nodes) for nodes in tree.levels]
    for at in range(13):
        path = tree.put(at, "other")
        assert tree.levels == before and len(path) == 5
        other = merkle.Tree([*leaves[:at], "other", *leaves[at + 1 :]], 4)
        assert path == [nodes[at >> k] for k, nodes in enumerate(other.levels)]
        assert all(a == b for k, (x, y) in enumerate(zip(tree.levels, other.levels)) for i, (a, b) in enumerate(zip(x, y)) if i != at >> k)
        assert merkle.folded(leaves[at], at, 13, iter(tree.siblings(at))) == tree.top


# Alignment.


def plain_alignment(texts):
    """(id, text) aligned by comparing all byte ranges."""
    own = alignment.kept_aligner((alignment.TOKENIZER_A, alignment.TOKENIZER_B))
    found, links_of, counts = [], [], Counter()
    for doc_id, text in texts:
        want = b" " + (text or "").encode()
        a = [(i, own.a_bytes[i]) for i in own.a.encode(want.decode(), add_special_tokens=False).ids]
        b = [(i, own.b_bytes[i]) for i in own.b.encode(text or "")]
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            found.append([doc_id, 0, 0, 0, ""])
            links_of.append([])
            continue
        spans = lambda ts: [(i, sum(len(x) for _, x in ts[:k]), sum(len(x) for _, x in ts[: k + 1])) for k, (i, _) in enumerate(ts)]
        a, b = spans(a), spans(b)
        ends, at, groups = sorted({e for *_, e in a} & {e for *_, e in b}), 0, []
        for e in ends:
            groups.append(",".join(str(i) for i, s, t in a if s >= at and t <= e) + "|" + ",".join(str(i) for i, s, t in b if s >= at and t <= e))
            at = e
        links = [(i, j) for i, s, t in a for j, u, v in b if s < v and u < t]
        counts.update(links)
        found.append([doc_id, len(a), len(b), len(groups), sha256(";".join(groups).encode()).hexdigest()])
        links_of.append(links)
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return sorted(((d, a, b, g, len(x), sum(counts[i, j] == best[j] for i, j in x), sum(counts[p] for p in x), digest) for (d, a, b, g, digest), x in zip(found, links_of)), key=str)


def test_alignment_of_odd_rows(spark, odd):
    short = odd.where("doc_id IS NULL OR doc_id <> 13")
    expected = plain_alignment([(r[0], r[1]) for r in ODD if r[0] != 13])
    assert sorted(map(tuple, alignment.align(short).collect()), key=str) == expected
    assert sorted(map(tuple, alignment.align(short, block_docs=2).collect()), key=str) == expected
    assert alignment.align(odd.limit(0)).count() == 0
    [long] = alignment.align(odd.where("doc_id = 13")).collect()
    assert long.n_a > 60_000 and long.n_best > 0 and len(long.groups_sha256) == 64


def test_alignment_of_a_table(spark):
    """Documents of up to 1,500 characters, with blocks so small that a pair has postings in many."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) <= 1500")
    expected = plain_alignment([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, alignment.align(docs.repartition(4), block_docs=16).collect()), key=str) == expected
    assert sorted(map(tuple, alignment.align(docs, block_links=1000).collect()), key=str) == expected


def test_alignment_query_counts_every_link(spark):
    rows = QUERIES["op13_alignment"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    index = alignment.indexed(docs).cache()
    counts = alignment.pair_counts(index)
    total = rows.agg(F.sum("n_links"), F.count("*")).first()
    assert counts.agg(F.sum("n_links")).first()[0] == total[0] and total[1] == docs.count()
    assert rows.agg(F.sum("count_sum")).first()[0] == counts.agg(F.sum(F.col("n_links") * F.col("n_links"))).first()[0]
    assert counts.agg(F.max("n_docs")).first()[0] <= total[1]


def test_units_against_whole_texts():
    """Texts of odd signs: cut into units they align as they do whole."""
    import pyarrow as pa

    own, rng = alignment.Aligner(tuple(map(bpe.vocabulary, (alignment.TOKENIZER_A, alignment.TOKENIZER_B)))), random.Random(7)
    signs = ["a", "the", "Wör", "  ", " ", "\n", "\t", "é", "😀", "漢字", "'s", "42", "<|endoftext|>", "<s>", "</s>", "<unk>", "▁", ".", " ", "　", "\0", "\r\n", "\x85", "\x1c", "<0x0A>", "don't", "ﬁ", "é", "​"]
    texts = ["".join(rng.choice(signs) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    for text, (numbers, digest, pairs) in zip(texts, own.documents(pa.array(texts))):
        whole = own.whole(text)
        expected = sha256(whole.groups).hexdigest() if whole is not alignment.NOTHING else ""
        assert (tuple(numbers), digest, pairs) == (whole.numbers, expected, whole.pairs), repr(text)


def test_bitmaps():
    rng = np.random.default_rng(3)
    for size, n in [(10, 0), (10, 10), (1000, 5), (1000, 900), (65536, 60000), (65536, 3)]:
        at = np.sort(rng.choice(size, n, replace=False))
        data = alignment.bitmap(at, size)
        assert (alignment.places(data) == at).all() and alignment.popcount(data) == n and len(data) <= 1 + min(2 * n, (size + 7) // 8)
        other = np.sort(rng.choice(size, n // 2, replace=False))
        both = alignment.merged([data, alignment.bitmap(other, size)])
        assert (alignment.places(both) == np.union1d(at, other)).all()
