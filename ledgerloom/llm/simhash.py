"""SimHash near-duplicates with pigeonring candidates.

A fingerprint has 64 bits in a ring of four segments of 16. If two fingerprints differ
in at most 3 bits, then by the pigeonring principle there is a segment from which every
chain of consecutive segments stays within its share of the budget: the first segment
differs in 0 bits, the first two in at most 1, three in at most 2, all four in 3.
So the second segment, in two halves, has an equal half, and the third, in three parts,
has an equal part. Each fingerprint is filed under every choice of (first segment, half,
part): 24 keys of about 29 bits. Two that link share a key, and a pair that meets under
a key must pass the chain test before its full difference is counted.

Where many different fingerprints share a key, the bits that remain are cut into four
runs, of which one must be equal, and the fingerprints are filed again under the longer
keys, until no key holds more than `BUCKET`. Each time a quarter of the remaining 35 bits
is fixed, and n free bits tell 2**n fingerprints apart at most, so that five times are enough.
Copies share a fingerprint and are folded before any of this.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import batched, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower_table, load, sieved, stored, text_slices

SHINGLE = 3
MAX_BITS = 3
#: Different fingerprints under one key that one task compares.
BUCKET = 2048
LOWER = ascii_lower_table()
#: Bits of a byte, lowest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the XXH64 (seed 42) values of the word shingles, repeats included."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)])
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, n)
    if n < 64:
        ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0)
    else:
        places = hashes.view(np.uint8).reshape(n, 8) + np.arange(0, 2048, 256)
        ones = (np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ BITS).ravel()
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`rows` with `fp`, the fingerprint as a signed long, in place of `text`, the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch.columns[-1].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*batch.schema.names[:-1], "fp"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(run, ", ".join([*kinds, "fp long"]))


def first_masks() -> list[int]:
    """Bits that the 24 keys keep: a segment, half of the next, a third of the one after."""
    masks = []
    for s in range(4):
        place = lambda k, a, b: sum(1 << ((16 * (s + k) + i) % 64) for i in range(a, b))
        for half in ((0, 8), (8, 16)):
            for part in ((0, 5), (5, 10), (10, 16)):
                masks.append(place(0, 0, 16) | place(1, *half) | place(2, *part))
    return masks


def longer(mask: int) -> list[int]:
    """The bits that `mask` leaves, cut into four runs: `mask` with each of them."""
    rest = [i for i in range(64) if not mask >> i & 1]
    cuts = [len(rest) * k // 4 for k in range(5)]
    return [mask | sum(1 << i for i in rest[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked(fps: np.ndarray, start: int) -> Iterator[tuple[int, int]]:
    """Links that join what is linked among different `fps`: each reached one is compared with those still unreached only."""
    left = fps
    while len(left) > 1:
        front, left, tree = [left[0]], left[1:], [int(left[0])]
        while front and len(left):
            pivot = front.pop()
            x = left ^ pivot
            seg = [np.bitwise_count((x >> np.uint64(16 * ((start + k) % 4))) & np.uint64(0xFFFF)) if start >= 0 else 0 for k in range(3)]
            in_chain = (seg[0] == 0) & (seg[0] + seg[1] <= 1) & (seg[0] + seg[1] + seg[2] <= 2) if start >= 0 else np.ones(len(left), bool)
            near = np.zeros(len(left), bool)
            near[in_chain] = np.bitwise_count(x[in_chain]) <= MAX_BITS
            if near.any():
                own = left[near]
                front.extend(own)
                tree.extend(int(v) for v in own)
                left = left[~near]
        for i in range(1, len(tree)):  # a binary tree: no fingerprint gets many links here, and paths are short
            yield tree[i], tree[(i - 1) // 2]


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(start, fingerprints) of every key with more than one, from rows (mask, key, start, fp) sorted by mask and key."""
    kept = None
    for batch in chain(batches, [None]):
        if batch is not None:
            own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            kept = own if kept is None else [np.concatenate(x) for x in zip(kept, own)]
        if kept is None or not len(kept[0]):
            continue
        mask, key, start, fps = kept
        edges = np.concatenate(([0], np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1, [len(mask)]))
        whole = len(edges) - 1 if batch is None else len(edges) - 2  # the last key may go on in the next batch
        for i in np.flatnonzero(np.diff(edges[: whole + 1]) > 1):
            yield int(start[edges[i]]), np.unique(fps[edges[i] : edges[i + 1]].view(np.uint64))
        kept = [c[edges[whole] :] for c in kept]


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in batched((pair for start, fps in runs(batches) for pair in linked(fps, start)), 10_000):
        pairs = np.array(group, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def filed(rows: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """Every fingerprint under each of the masks (mask, start of the chain)."""
    under = (F.struct(F.lit(signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"), F.lit(s).alias("start")) for m, s in masks)
    return rows.select("fp", F.explode(F.array(*under)).alias("k")).select("k.mask", "k.key", "k.start", "fp")


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """`a`, `b`: links whose components are those of all links between the different fingerprints `fp`."""
    masks, found = [(m, i // 6) for i, m in enumerate(first_masks())], None
    files = filed(distinct, masks)
    while True:
        large = stored(files.groupBy("mask", "key").count().where(F.col("count") > bucket).select("mask", "key"), "simhash-large")
        crowded = {r.mask for r in large.select("mask").distinct().collect()}  # no more than there are masks
        fits = files.join(large, ["mask", "key"], "left_anti").select("mask", "key", "start", "fp") if crowded else files
        new = fits.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(compare, "a long, b long")
        found = new if found is None else found.union(new)
        if not crowded:
            return found
        deeper = [(signed(m), signed(x)) for m, _ in masks if signed(m) in crowded for x in longer(m)]
        masks = [(x % (1 << 64), -1) for x in sorted({x for _, x in deeper})]
        hot = files.join(large, ["mask", "key"], "left_semi").join(F.broadcast(distinct.sparkSession.createDataFrame(deeper, "mask long, longer long")), "mask")
        files = stored(hot.select(F.col("longer").alias("mask"), F.col("fp").bitwiseAND(F.col("longer")).alias("key"), F.lit(-1).alias("start"), "fp").distinct(), "simhash-keys")


def components(pairs: DataFrame) -> DataFrame:
    """`fp`, `root`: one root for each component of the links `a`, `b`.

    Every node points to its smallest neighbour or itself, links are redrawn between the nodes pointed
    to, and so on: each round at least halves the nodes that still have links.
    """
    pairs = stored(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "simhash-links")
    steps = []
    while not pairs.isEmpty():
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("to")), "simhash-step")
        steps.append(step)
        of = lambda name: step.select(F.col("node").alias(name), F.col("to").alias(f"{name}_to"))  # noqa: E731, B023
        moved = pairs.join(of("a"), "a").join(of("b"), "b")
        pairs = stored(moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).where("a <> b").distinct(), "simhash-links")
    if not steps:
        return pairs.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    roots = steps[-1].select(F.col("node").alias("fp"), F.col("to").alias("root"))
    for step in reversed(steps[:-1]):
        onward = roots.select(F.col("fp").alias("to"), F.col("root").alias("onward"))
        roots = stored(step.join(onward, "to", "left").select(F.col("node").alias("fp"), F.coalesce("onward", "to").alias("root")), "simhash-roots")
    return roots


def classes(rows: DataFrame, least, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`fp`, `low`: for every fingerprint of `rows` the minimum of `least` over all rows that the links of `find` lead to."""
    distinct = stored(rows.groupBy("fp").agg(F.min(least).alias("low")), "simhash-distinct")
    roots = stored(components(find(distinct.select("fp"))), "simhash-components")
    placed = stored(distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "low"), "simhash-placed")
    lows = stored(placed.groupBy("root").agg(F.min("low").alias("low")), "simhash-lows")
    return stored(placed.select("fp", "root").join(lows, "root").select("fp", "low"), "simhash-classes")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `doc_id`, `fp`, `component_id`, the smallest doc_id that links of at most 3 bits lead to.

    Null and empty texts have fingerprint 0 and link like any other. Null ids stay null; a component whose
    ids are all null has a null component_id. Repeated rows are kept, each in its component. Other columns,
    whatever their names, are left out. An empty table gives no rows.
    """
    rows = docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text")
    rows = stored(with_fingerprints(rows, shingle), "simhash-fingerprints")
    return rows.join(classes(rows, F.col("doc_id"), lambda distinct: links(distinct, bucket)), "fp").select("doc_id", "fp", F.col("low").alias("component_id"))


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with its columns as they were: the smallest id (nulls last), then the smallest hash of the text.

    Rows that share id and text are one document; of these the one stays whose other columns, as JSON, have the
    smallest hash, so that only rows that are equal altogether are interchangeable.
    """
    return one_of_each(docs, lambda rows: with_fingerprints(rows, shingle), lambda distinct: links(distinct, bucket), doc_id, text)


def one_of_each(docs: DataFrame, with_fp: Callable[[DataFrame], DataFrame], find: Callable[[DataFrame], DataFrame], doc_id: str, text: str) -> DataFrame:
    """`deduplicate` with other fingerprints, put in place of `text` by `with_fp`, and other links, found by `find`."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text_of = F.col("row").getField(text).cast("string")
    named = {"is_null": F.col("row").getField(doc_id).isNull(), "doc_id": F.coalesce(F.col("row").getField(doc_id).cast("long"), F.lit(0)), "hash_1": F.xxhash64(text_of), "hash_2": F.xxhash64(F.lit(7), text_of)}
    rows = stored(with_fp(whole.select(*(c.alias(k) for k, c in named.items()), text_of.alias("text"))), "simhash-fingerprints")
    kept = stored(classes(rows, F.struct(*named), find).select("low.*").distinct(), "simhash-kept")
    others = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in (doc_id, text)]
    tie = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    # Few rows go, so those that certainly stay, alone with their id and text, aren't shuffled.
    counts = rows.groupBy(*named).count().join(kept.withColumn("stays", F.lit(True)), list(named), "left")
    doubtful = stored(counts.where("stays IS NULL OR count > 1").select(F.xxhash64(*named).alias("key")), "simhash-doubtful")
    marked = sieved(whole.withColumns(named).withColumn("key", F.xxhash64(*named)), "key", doubtful)
    rest = marked.where("_may").join(kept, list(named), "left_semi").groupBy(*named).agg(F.min_by("row", tie).alias("row"))
    return marked.where("NOT _may").select("row.*").union(rest.select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    rows = near_duplicates(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
