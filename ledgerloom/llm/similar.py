"""Near-duplicates by the similarity of word shingles, without loss.

Two texts are near-duplicates if the sets of their five-word shingles have a Jaccard
similarity of 0.8 or more. SimHash links come first: fingerprints of the shingles within
three bits, found by pigeonring (`simhash.links`), name pairs that are checked on their
sets. They find most of what is linked, but not all: at a similarity of 0.8 some ten of 64
bits differ, and no filter of fingerprints tells so many from chance.

A prefix filter completes them. All shingles have one order, rare ones first; two sets of
that similarity share a shingle among the first n - ceil(0.8 n) + 1 of each. So each
different text is filed under those, and texts that meet under one, whose sizes and places
there leave room for the similarity and that no link joins yet are checked too.

Any order is right; rare ones first keeps common passages from gathering candidates. It
comes from counts of hashed shingles in a table of fixed size. Where many texts meet under
one shingle, a few of them are compared with all others first, as whoever is linked already
needs no more comparisons; what is not yet linked is compared block by block, and only pairs
whose bitmaps of shingles leave room for the similarity come out of that.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.folders import new_folder, remove

from .bpe import PieceMemo, different
from .common import kept, sieved, stored, text_slices
from .simhash import LOWER, components, links, one_of_each, with_fingerprints

SHINGLE, SIMILARITY = 5, "0.8"
#: Counters of hashed shingles, and how many a task hands on in a row.
COUNTERS, CHUNK = 1 << 20, 1 << 12
#: Texts under one shingle that are compared in pairs at once; rounds in which one text is compared with all others of larger groups.
PAIRED, STARS = 16, 2
#: Texts of a block of a larger group; a task compares two blocks.
BLOCK = 1024
#: Bytes of bitmaps that one text is compared with at once.
COMPARED_BYTES = 1 << 22
MEMO_WORDS = 500_000
SPACES = r"[\x09-\x0D\x20]+"


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def shingles(text: str | None, shingle: int) -> set:
    """The set of word shingles; a shorter text is one."""
    own = words(text)
    return set(zip(*(own[i:] for i in range(shingle)))) if len(own) >= shingle else {tuple(own)} if own else set()


def content(text: str | None) -> tuple[int, int]:
    """Two signed hashes, 128 bits in all, of the words of a text. Texts with the same words are copies."""
    import xxhash

    value = xxhash.xxh3_128_intdigest(b" ".join(words(text)))
    return tuple(np.array([value & (2**64 - 1), value >> 64], np.uint64).view(np.int64).tolist())


class WordHashes(PieceMemo):
    """64-bit hashes of words."""

    def learn(self, pieces: list[str]) -> list[int]:
        import xxhash

        return [xxhash.xxh3_64_intdigest(p.encode("utf-8")) for p in pieces]


def hashed(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Different hashed shingles of texts: the number of the text, and the hash, sorted by both.

    Equal shingles have equal hashes; unequal ones that share one only add candidates.
    """
    memo = kept(("words",), lambda: WordHashes(MEMO_WORDS))
    plain = pc.utf8_trim(pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), SPACES, " "), " ")
    codes, pieces, starts = different(pc.split_pattern(plain, " "))
    h = np.array(memo.values(pieces), np.uint64)[codes]
    sizes = np.diff(starts)
    sizes[pc.equal(plain, "").to_numpy(zero_copy_only=False)] = 0
    n = np.where(sizes >= shingle, sizes - shingle + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(n)), n)
    at = np.repeat(starts[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    width, total = np.minimum(sizes, shingle)[text], np.zeros(len(at), np.uint64)
    for i in range(shingle):
        use = i < width
        mixed = (total[use] ^ h[at[use] + i]) * np.uint64(0x9E3779B97F4A7C15)
        total[use] = mixed ^ (mixed >> np.uint64(29))
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (total[1:] != total[:-1])
    return text[new], total[new]


def counters(texts: DataFrame, shingle: int) -> np.ndarray:
    """How many texts hold a shingle of each counter: 4 bytes a counter, whatever the table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in text_slices(batches):
            total += np.bincount((hashed(batch.column(0), shingle)[1] % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        parts = [total[i : i + CHUNK].tolist() for i in range(0, COUNTERS, CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.int64()))], names=["chunk", "v"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([x.values.to_numpy() for x in table.column("v")], axis=0)
        return pa.table([table.column("chunk").slice(0, 1), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["chunk", "v"])

    found = texts.select("text").mapInArrow(count, "chunk int, v array<long>").groupBy("chunk").applyInArrow(add, "chunk int, v array<long>")
    total = np.zeros(COUNTERS, np.uint32)
    for r in found.toLocalIterator():  # COUNTERS / CHUNK rows
        total[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.minimum(r.v, 2**32 - 1)
    return total


def filed(texts: DataFrame, shingle: int, level: Fraction) -> DataFrame:
    """Every text `fp` under its rarest shingles `h`: `n` its shingles, `at` the place of h among them."""
    held = texts.sparkSession.sparkContext.broadcast(counters(texts, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            text, h = hashed(batch.column(1), shingle)
            n = np.bincount(text, minlength=batch.num_rows)
            most = n - -(-n * level.numerator // level.denominator) + 1  # n - ceil(level * n) + 1
            order = np.lexsort((h, held.value[(h % np.uint64(COUNTERS)).astype(np.int64)], text))
            text, h = text[order], h[order]
            at = np.arange(len(text)) - (np.cumsum(n) - n)[text]
            first = at < most[text]
            text, h, at = text[first], h[first], at[first]
            fp = batch.column(0).to_numpy(zero_copy_only=False)[text]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(fp), pa.array(n[text], pa.int32()), pa.array(at, pa.int32())], names=["h", "fp", "n", "at"])

    return texts.select("fp", "text").mapInArrow(run, "h long, fp long, n int, at int")


def meetings(rows: DataFrame, level: Fraction) -> DataFrame:
    """`a`, `b`: pairs of texts that meet under a shingle and may be similar; where over `PAIRED` meet, only `h`, with nulls."""
    p, q = level.numerator, level.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None  # the group of shingle `last`: its first rows, and how many there are
        out: list[tuple] = []

        def close() -> None:
            if size > PAIRED:
                out.append((last, None, None))
                return
            for i, (a, n, at) in enumerate(held):
                for b, m, bt in held[:i]:
                    if a != b and min(n, m) * q >= max(n, m) * p and min(n - at, m - bt) * (p + q) >= (n + m) * p:
                        out.append((None, min(a, b), max(a, b)))

        def handed() -> pa.RecordBatch:
            columns = [pa.array(x, pa.int64()) for x in (zip(*dict.fromkeys(out)) if out else ((), (), ()))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["h", "a", "b"])

        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            h = columns[0]
            edges = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1], [True]))) if len(h) else np.zeros(1, np.int64)
            several = np.diff(edges) > 1
            several[:1] = several[-1:] = True  # the first and the last may go on in other batches
            for a, b in zip(edges[:-1][several].tolist(), edges[1:][several].tolist()):
                if h[a] != last:
                    if size > 1:
                        close()
                    held, size, last = [], 0, int(h[a])
                if b - a > 1 or size or b == len(h):
                    held += list(zip(*(c[a : min(b, a + PAIRED)].tolist() for c in columns[1:])))[: PAIRED - len(held)]
                size += b - a
            if len(out) > 10_000:
                yield handed()
        if size > 1:
            close()
        yield handed()

    return rows.select("h", "fp", "n", "at").repartition("h").sortWithinPartitions("h", "fp").mapInArrow(run, "h long, a long, b long")


def bitmaps(texts: DataFrame, shingle: int) -> DataFrame:
    """Every text `fp` with a bitmap of its hashed shingles, of 16 to 32 bits a shingle and a power of two in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            text, h = hashed(batch.column(1), shingle)
            n = np.bincount(text, minlength=batch.num_rows)
            maps = []
            for own in np.split(h, np.cumsum(n)[:-1]):
                bits = max(64, 1 << (16 * len(own) - 1).bit_length())
                held = np.zeros(bits, bool)
                held[(own % np.uint64(bits)).astype(np.int64)] = True
                maps.append(np.packbits(held).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(maps, pa.binary())], names=["fp", "bits"])

    return texts.select("fp", "text").mapInArrow(run, "fp long, bits binary")


class Overlaps:
    """Upper bounds of how many shingles two texts share, from their bitmaps.

    Shingles whose bit the other text lacks are not shared. The longer of two bitmaps is folded to the length of the other.
    """

    def __init__(self, maps: list[bytes], n: np.ndarray):
        self.n, self.sizes, self.row, self.folds = n, np.array([len(x) for x in maps]), np.zeros(len(maps), np.int64), {}
        for size in np.unique(self.sizes).tolist():
            at = np.flatnonzero(self.sizes == size)
            self.row[at] = np.arange(len(at))
            self.hold(size, size, np.frombuffer(b"".join(maps[i] for i in at.tolist()), np.uint64).reshape(len(at), -1))

    def hold(self, size: int, to: int, bits: np.ndarray) -> None:
        self.folds[size, to] = bits, np.bitwise_count(bits).sum(axis=1, dtype=np.int64)

    def folded(self, size: int, to: int) -> tuple[np.ndarray, np.ndarray]:
        if (size, to) not in self.folds:
            bits = self.folds[size, size][0]
            self.hold(size, to, np.bitwise_or.reduce(bits.reshape(len(bits), size // to, to // 8), axis=1))
        return self.folds[size, to]

    def most(self, x: int, y: np.ndarray) -> np.ndarray:
        """The bound of text x with each text of y."""
        found, own = np.zeros(len(y), np.int64), int(self.sizes[x])
        for size in np.unique(self.sizes[y]).tolist():
            to, at = min(size, own), np.flatnonzero(self.sizes[y] == size)
            (mine, ones), (others, others_ones) = self.folded(own, to), self.folded(size, to)
            step = max(1, COMPARED_BYTES // to)
            for part in (at[i : i + step] for i in range(0, len(at), step)):
                rows = self.row[y[part]]
                both = np.bitwise_count(others[rows] & mine[self.row[x]]).sum(axis=1, dtype=np.int64)
                found[part] = both + np.minimum(self.n[x] - ones[self.row[x]], self.n[y[part]] - others_ones[rows])
        return found


def dealt(rows: DataFrame) -> DataFrame:
    """`rows` (`h`, `fp`, `n`, `at`, `root` and `m`, the size of their group) with the groups that texts are compared in, `cell` and `h`.

    A passage that many texts share gives many shingles with much the same group under each. Groups with the same
    smallest hash of a text (the likelier, the more they have in common) are one cell, and a text is in it once, at its
    first place there. Where that makes more comparisons than the groups by themselves, these stay. `m` is the size.
    """
    cells = rows.groupBy("h").agg(F.min(F.xxhash64("fp", F.lit("cell"))).alias("cell"))
    own = stored(rows.join(cells, "h").select("cell", "h", "fp", "n", "at", "root", "m"), "similar-cells")
    # The sum of m over the rows of a group is m * m.
    sizes = own.groupBy("cell", "fp").agg(F.sum("m").alias("m")).groupBy("cell").agg(F.count("*").alias("texts"), F.sum("m").alias("alone"))
    joint = F.col("texts") * F.col("texts") <= F.col("alone")
    placed = own.join(sizes, "cell").select("cell", F.when(joint, 0).otherwise(F.col("h")).alias("h"), "fp", "n", "at", "root", F.when(joint, F.col("texts")).otherwise(F.col("m")).alias("m"))
    return placed.groupBy("cell", "h", "fp", "n", "root", "m").agg(F.min("at").alias("at"))


def blocked(rows: DataFrame, texts: DataFrame, shingle: int, level: Fraction) -> DataFrame:
    """`a`, `b`: pairs of texts that have different roots and may be similar, among them all such that meet first under a shingle of `rows`.

    `rows` are what `dealt` takes. No task holds a whole large group: it gets two blocks of it. Bitmaps of all
    shingles bound what two texts share.
    """
    p, q = level.numerator, level.denominator

    def compare(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        fp, n, at, root, block = (table.column(c).to_numpy().astype(np.int64) for c in ("fp", "n", "at", "root", "block"))
        overlaps = Overlaps(table.column("bits").to_pylist(), n)
        second, found = np.flatnonzero(block == j), []
        for x in np.flatnonzero(block == i).tolist():
            y = second[second > x] if i == j else second
            both = n[y] + n[x]
            y = y[(root[y] != root[x]) & (np.minimum(n[y], n[x]) * q >= np.maximum(n[y], n[x]) * p) & (np.minimum(n[y] - at[y], n[x] - at[x]) * (p + q) >= both * p)]
            y = y[overlaps.most(x, y) * (p + q) >= (n[y] + n[x]) * p]
            found += [(k, x) for k in y.tolist()]
        k, x = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table([pa.array(np.minimum(fp[k], fp[x])), pa.array(np.maximum(fp[k], fp[x]))], names=["a", "b"])

    own = stored(dealt(rows), "similar-dealt")
    named = stored(own.select("fp").distinct(), "similar-named")
    blocks = F.ceil(F.col("m") / BLOCK).cast("long")
    # Texts stay where they are; their bitmaps travel.
    maps = bitmaps(sieved(texts, "fp", named).where("_may"), shingle)
    split = own.withColumn("block", F.pmod(F.xxhash64("fp", F.lit("block")), blocks)).join(maps, "fp")
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    split = split.select("cell", "h", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "fp", "n", "at", "root", "block", "bits")
    return split.groupBy("cell", "h", "i", "j").applyInArrow(compare, "a long, b long")


def checked(pairs: DataFrame, texts: DataFrame, shingle: int, level: Fraction) -> DataFrame:
    """Those of `pairs` (`a`, `b`) that are as similar as `level`, by their sets of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in text_slices(batches, 128):
            keep = []
            for a, b in zip(*(batch.column(c).to_pylist() for c in ("a_text", "b_text"))):
                if a != last:
                    last, own = a, shingles(a, shingle)
                other = shingles(b, shingle)
                both = len(own & other)
                keep.append(both >= level * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = stored(pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct(), "similar-asked")
    # The sieve lets few others pass, and the joins leave them out; so texts are shuffled once for both sides.
    own = sieved(texts, "fp", needed).where("_may")
    of = lambda c: own.select(F.col("fp").alias(c), F.col("text").alias(f"{c}_text"))
    return pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long")


def fingerprint_pairs(texts: DataFrame, shingle: int) -> DataFrame:
    """`a`, `b`: texts of one fingerprint, each with the smallest, and the smallest of linked fingerprints."""
    rows = stored(with_fingerprints(texts.select(F.col("fp").alias("id"), "text"), shingle), "similar-fingerprints")
    low = stored(rows.groupBy("fp").agg(F.min("id").alias("low")), "similar-lows")
    same = rows.join(low, "fp").where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b"))
    of = lambda c: low.select(F.col("fp").alias(c), F.col("low").alias(f"{c}_low"))
    near = links(low.select("fp")).join(of("a"), "a").join(of("b"), "b").select(F.least("a_low", "b_low").alias("a"), F.greatest("a_low", "b_low").alias("b"))
    return same.union(near).distinct()


def similar_links(texts: DataFrame, shingle: int = SHINGLE, similarity: str = SIMILARITY, folder: str | None = None) -> DataFrame:
    """`a`, `b`: links whose components are those of all links between the different `texts` (`fp`, `text`).

    What is returned reads nothing of `texts` or of `folder`, where large working tables go; the caller may remove both.
    """
    level = Fraction(similarity)
    p, q = level.numerator, level.denominator
    found = stored(checked(stored(fingerprint_pairs(texts, shingle), "similar-pairs"), texts, shingle, level), "similar-links")
    roots = stored(components(found), "similar-roots")
    every = stored(filed(texts, shingle, level), "similar-shingles", folder)
    met = stored(meetings(every, level), "similar-met")
    of = lambda c: roots.select(F.col("fp").alias(c), F.col("root").alias(f"{c}_root"))
    pairs = met.where("h IS NULL").select("a", "b").distinct().join(of("a"), "a", "left").join(of("b"), "b", "left")
    pairs = pairs.where("coalesce(a_root, a) <> coalesce(b_root, b)").select("a", "b")
    new = stored(checked(stored(pairs, "similar-pairs"), texts, shingle, level), "similar-links")
    found = found.union(new)
    hot = stored(met.where("h IS NOT NULL").select("h").distinct(), "similar-hot")
    if hot.isEmpty():
        return found
    left = sieved(every, "h", hot).where("_may").drop("_may").join(hot, "h", "left_semi")
    # At the first shingle that two sets share, what follows is all they can share besides it.
    room = f"least(a.n, b.n) * {q}L >= greatest(a.n, b.n) * {p}L AND least(a.n - a.at, b.n - b.at) * {p + q}L >= (a.n + b.n) * {p}L"
    for star in range(STARS + 1):
        roots = components(found)
        left = stored(left.select("h", "fp", "n", "at").join(roots, "fp", "left").select("h", "fp", "n", "at", F.coalesce("root", "fp").alias("root")), "similar-left")
        groups = left.groupBy("h").agg(F.count("*").alias("m"), F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct(F.xxhash64(F.lit(star), "fp").alias("o"), "fp", "n", "at", "root")).alias("pivot"))
        groups = stored(groups.where("low < high").select("h", "m", "pivot.*"), "similar-groups")
        few = groups.where(F.col("m") <= PAIRED)
        own = left.join(few.select("h"), "h", "left_semi")
        pairs = own.alias("a").join(own.alias("b"), "h").where(f"a.fp < b.fp AND a.root <> b.root AND {room}").select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
        many = groups.where(F.col("m") > PAIRED)
        if star < STARS:
            around = many.alias("a").join(left.alias("b"), "h").where(f"a.fp <> b.fp AND a.root <> b.root AND {room}")
            pairs = pairs.union(around.select(F.least("a.fp", "b.fp").alias("a"), F.greatest("a.fp", "b.fp").alias("b")))
        else:
            pairs = pairs.union(blocked(left.join(many.select("h", "m"), "h"), texts, shingle, level))
        new = stored(checked(stored(pairs.distinct(), "similar-pairs"), texts, shingle, level), "similar-links")
        found = found.union(new)
        if star == STARS or many.isEmpty():
            return found
        left = left.join(many.select("h", F.col("fp").alias("pivot")), "h").where("fp <> pivot")


def with_content(rows: DataFrame) -> DataFrame:
    """`rows` with `fp` and `fp_more`, the hashes of their words, in place of `text`, the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            keys = np.array([content(t) for t in batch.columns[-1].to_pylist()], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=[*batch.schema.names[:-1], "fp", "fp_more"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(run, ", ".join([*kinds, "fp long", "fp_more long"]))


def shared(rows: DataFrame) -> DataFrame:
    """The 64-bit `fp` that stand for different texts, each with the smallest `fp_more`. Some three are to be expected among 10^10 texts."""
    return rows.select("fp", "fp_more").distinct().groupBy("fp").agg(F.min("fp_more").alias("own"), F.count("*").alias("n")).where("n > 1").select("fp", "own")


def told_apart(rows: DataFrame, several: DataFrame | None) -> DataFrame:
    """`rows` with an `fp` for each 128 bits: where different texts share one (`several`), all but the first get another, made of both halves."""
    if several is not None:
        rows = rows.join(several, "fp", "left").withColumn("fp", F.when(F.col("own") != F.col("fp_more"), F.xxhash64("fp", "fp_more")).otherwise(F.col("fp"))).drop("own")
    return rows.drop("fp_more")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, similarity: str = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of near-duplicates, as simhash.deduplicate chooses it.

    Texts without words are copies of each other, null texts too; a text of fewer words than a shingle is one
    shingle. A null id is larger than any. Equal rows are one. A text of any length is compared whole. Columns
    stay as they are, whatever their names. An empty table stays empty.
    """
    several, copied = None, None

    def with_ids(rows: DataFrame) -> DataFrame:
        nonlocal several, copied
        found = stored(with_content(rows), "similar-contents")
        several = shared(found)
        several = None if several.isEmpty() else stored(several, "similar-several")
        found = told_apart(found, several)
        copied = stored(found.groupBy("fp").count().where("count > 1").select("fp"), "similar-copied")
        return found

    def links(_: DataFrame) -> DataFrame:
        own = docs.select(F.col(f"`{text}`").cast("string").alias("own"), F.col(f"`{text}`").cast("string").alias("text"))
        marked = sieved(told_apart(with_content(own), several), "fp", copied)
        # Only texts that may have copies are shuffled to lose them.
        once = marked.where("_may").groupBy("fp").agg(F.min("own").alias("text"))
        folder = new_folder(docs.sparkSession, "similar")
        texts = stored(marked.where("NOT _may").select("fp", F.col("own").alias("text")).union(once), "similar-texts", folder)
        found = similar_links(texts, shingle, similarity, folder)
        remove(docs.sparkSession, folder)
        return found

    return one_of_each(docs, with_ids, links, doc_id, text)
