"""Token ids of a corpus as shard files with a minimal perfect hash index.

A store is one Parquet folder with a row per shard, so that any store Spark writes to
will do. A shard holds the ids of neighbouring documents in ascending id order:

keys      int64 little-endian, one a document
has_key   one byte a document, 0 where the id is null
ends      int64, ids of the shard up to and with each document (its end id included)
ids       the raw payload, unsigned little-endian, `width` bytes an id
before    ids of the shards before it in its part; parts follow each other in order
levels    int64 (bits, bits, ...) of the hash levels, then `filter`, their bits packed
ranks     uint32, set bits before each run of 512 bits of the filter
slots     uint32 (fingerprint, first document, documents with this key) a distinct key

The index is a cascade of bit arrays: a key sits at its hash in the first array where no
other key of the shard falls; the number of set bits before it is its slot. A lookup reads
one bit a level, one rank and at most 64 bytes to count, one slot, compares the
fingerprint and slices the payload: its cost does not grow with the shard.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import load, shared_folder, stored, text_slices

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: A shard is closed once it has so many ids or documents; one document is never divided.
SHARD_IDS = 1 << 21
SHARD_DOCS = 1 << 16
#: Bytes of text in a part.
PART_BYTES = 128 << 20
#: Bits of the filter for which the set ones are counted in advance.
RUN = 512
SHARD_SCHEMA = "part int, seq int, n_docs long, n_ids long, before long, width int, first_key long, last_key long, keys binary, has_key binary, ends binary, ids binary, levels binary, filter binary, ranks binary, slots binary"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A one-to-one 64-bit mix of integer keys."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1_000_003) >> np.uint64(32)).astype(np.uint32)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level sizes, bits of all levels, and the slot of each of the distinct `keys`."""
    sizes, bits, left, slot, used = [], [], np.arange(len(keys)), np.zeros(len(keys), np.int64), 0
    while len(left):
        m = max(8, 2 * len(left))
        at = (mixed(keys[left], len(sizes) + 1) % np.uint64(m)).astype(np.int64)
        alone = np.bincount(at, minlength=m) == 1
        own = alone[at]
        slot[left[own]] = used + (np.cumsum(alone) - 1)[at[own]]
        used += int(alone.sum())
        sizes.append(m)
        bits.append(alone)
        left = left[~own]
    return np.array(sizes, np.int64), np.concatenate(bits) if bits else np.empty(0, bool), slot


class Index:
    """Slots of keys; -1 for keys that the shard doesn't hold (but for fingerprints that agree by chance, 1 in 2**32)."""

    def __init__(self, levels: bytes, filter_: bytes, ranks: bytes, slots: bytes):
        self.sizes = np.frombuffer(levels, np.int64)
        self.filter = np.frombuffer(filter_, np.uint8)
        self.ranks = np.frombuffer(ranks, np.uint32)
        self.slots = np.frombuffer(slots, np.uint32).reshape(-1, 3)

    def is_set(self, at: np.ndarray) -> np.ndarray:
        return self.filter[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each of the places `at`."""
        run = at // RUN
        block = self.filter[run[:, None] * (RUN // 8) + np.arange(RUN // 8)]
        keep = np.clip((at % RUN)[:, None] - 8 * np.arange(RUN // 8), 0, 8)
        return self.ranks[run] + np.bitwise_count(block & ((1 << keep) - 1).astype(np.uint8)).sum(axis=1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        found, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, m in enumerate(self.sizes, 1):
            at = base + (mixed(keys[open_], level) % np.uint64(m)).astype(np.int64)
            hit = self.is_set(at)
            found[open_[hit]] = self.rank(at[hit])
            open_, base = open_[~hit], base + int(m)
        known = found >= 0
        same = self.slots[found[known], 0] == fingerprints(keys[known])
        found[np.flatnonzero(known)[~same]] = -1
        return found


def packed(part: int, seq: int, before: int, keys: list, lengths: list[int], ids: np.ndarray) -> dict:
    has = np.array([k is not None for k in keys], np.uint8)
    values = np.array([0 if k is None else k for k in keys], np.int64)
    named = values[has == 1]
    distinct, first, runs = np.unique(named, return_index=True, return_counts=True)
    sizes, bits, slot = build_index(distinct)
    bits = np.concatenate((bits, np.zeros(-len(bits) % RUN, bool)))
    set_bits = bits.reshape(-1, RUN).sum(axis=1)
    slots = np.zeros((len(distinct), 3), np.uint32)
    slots[slot] = np.column_stack((fingerprints(distinct), first + int((has == 0).sum()), runs)) if len(distinct) else slots
    return {
        "part": part, "seq": seq, "n_docs": len(keys), "n_ids": len(ids), "before": before, "width": ids.dtype.itemsize,
        "first_key": int(named[0]) if len(named) else None, "last_key": int(named[-1]) if len(named) else None,
        "keys": values.tobytes(), "has_key": has.tobytes(), "ends": np.cumsum(lengths, dtype=np.int64).tobytes(), "ids": ids.tobytes(),
        "levels": sizes.tobytes(), "filter": np.packbits(bits, bitorder="little").tobytes(), "ranks": (np.cumsum(set_bits) - set_bits).astype(np.uint32).tobytes(), "slots": slots.tobytes(),
    }


def write_store(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, shard_ids: int = SHARD_IDS, shard_docs: int = SHARD_DOCS, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encodes whole texts (null: empty) and writes the store. Documents are ordered by id, null ids first; rows that
    share an id are ordered by a hash of their text, then by their place, so that many of them spread over tasks.

    There is a part for each `PART_BYTES` of text, and as many as the session's shuffle partitions at least.
    """
    rows = docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"coalesce(CAST(`{text}` AS STRING), '') AS text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()})

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = bpe.kept_memo(bpe.WordIds, tokenizer)
        part, end = TaskContext.get().partitionId(), np.array([end_id], memo.dtype)
        keys, lengths, pieces, size, seq, before = [], [], [], 0, 0, 0
        row = lambda: pa.RecordBatch.from_pylist([packed(part, seq, before, keys, lengths, np.concatenate(pieces))], schema=SHARD_ARROW)
        for batch in text_slices(batches):
            ids, counts = memo.encode(batch.column(1))
            at = 0
            for key, n in zip(batch.column(0).to_pylist(), counts.tolist()):
                keys.append(key)
                lengths.append(n + 1)
                pieces += [ids[at : at + n], end]
                at += n
                size += n + 1
                if size >= shard_ids or len(keys) >= shard_docs:
                    yield row()
                    keys, lengths, pieces, size, seq, before = [], [], [], 0, seq + 1, before + size
        if keys:
            yield row()

    ordered = rows.repartitionByRange(parts, "doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(shards, SHARD_SCHEMA).write.option("compression", "lz4_raw").parquet(path)


BINARY = {"keys", "has_key", "ends", "ids", "levels", "filter", "ranks", "slots"}
INTS = {"part", "seq", "width"}
SHARD_ARROW = pa.schema([(f.split()[0], pa.binary() if f.split()[0] in BINARY else pa.int32() if f.split()[0] in INTS else pa.int64()) for f in SHARD_SCHEMA.split(", ")])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def part_starts(shards: DataFrame) -> np.ndarray:
    """The number of ids before each part: 8 bytes a part, of which there is one for each task that wrote the store."""
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    own = np.zeros(max((r.part for r in sums), default=0) + 1, np.int64)
    for r in sums:
        own[r.part] = r.n
    return np.cumsum(own) - own


def slices(row: dict, keys: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(position in `keys`, document in the shard, ids) for each key that the shard's index holds."""
    index = Index(row["levels"], row["filter"], row["ranks"], row["slots"])
    ends, ids = np.frombuffer(row["ends"], np.int64), np.frombuffer(row["ids"], np.dtype(f"<u{row['width']}"))
    for i, slot in enumerate(index.find(keys)):
        if slot >= 0:
            _, first, run = (int(x) for x in index.slots[slot])
            for d in range(first, first + run):
                yield i, d, ids[ends[d - 1] if d else 0 : ends[d]]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the store, read through the index: `doc_id`, `start`, `n_tokens`, `ids_crc32`."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                [row] = batch.slice(at, 1).to_pylist()
                keys, has = np.frombuffer(row["keys"], np.int64), np.frombuffer(row["has_key"], np.uint8) == 1
                ends = np.concatenate(([0], np.frombuffer(row["ends"], np.int64)))
                ids, crc = np.frombuffer(row["ids"], np.dtype(f"<u{row['width']}")), np.full(len(keys), -1, np.int64)
                for d in np.flatnonzero(~has):  # documents without an id are in no index
                    crc[d] = zlib.crc32(ids[ends[d] : ends[d + 1]].astype("<u4"))
                distinct = np.unique(keys[has])
                for i, d, own in slices(row, distinct):
                    if keys[d] != distinct[i] or not has[d]:
                        raise ValueError(f"the index of shard {row['part']}/{row['seq']} leads key {distinct[i]} to {keys[d]}")
                    crc[d] = zlib.crc32(own.astype("<u4"))
                if (crc < 0).any():
                    raise ValueError(f"the index of shard {row['part']}/{row['seq']} misses keys")
                start = int(starts.value[row["part"]]) + row["before"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=~has), pa.array(ends[:-1] + start), pa.array(np.diff(ends)), pa.array(crc)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    shards = read_shards(spark, path)
    starts = spark.sparkContext.broadcast(part_starts(shards))
    return shards.mapInArrow(walk, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keyed access: `doc_id`, `ids` (array) for every row of the store whose id is in `keys`; unknown keys give no row.

    Keys go to the parts whose range of ids holds them (28 bytes a part, sent to every task) and to all
    shards of those parts whose own range does. Only files of parts that are asked for are read, and of
    them only shards that are asked for leave the reader.
    """
    shards = read_shards(spark, path)
    by_part = shards.where("first_key IS NOT NULL").groupBy("part").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high")).orderBy("low", "high", "part").collect()
    wanted = keys.selectExpr(f"CAST(`{key}` AS BIGINT) AS doc_id").where("doc_id IS NOT NULL").distinct()
    if not by_part:
        return wanted.limit(0).select("doc_id", F.array().cast("array<long>").alias("ids"))
    held = spark.sparkContext.broadcast([np.array(x, np.int64) for x in zip(*((r.part, r.low, r.high) for r in by_part))])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, low, high = held.value
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            a, b = np.searchsorted(high, k, "left"), np.searchsorted(low, k, "right")
            n = np.maximum(b - a, 0)
            at = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(k, n)), pa.array(part[at], pa.int32())], names=["doc_id", "part"])

    routed = stored(wanted.mapInArrow(route, "doc_id long, part int"), "lookup-routes")
    ranges = shards.where("first_key IS NOT NULL").select("part", "seq", "first_key", "last_key")
    asked = routed.join(ranges, "part").where("doc_id BETWEEN first_key AND last_key")
    # A shard holds few of the keys that reach it; keys between its first and last go to it in lists of a bounded length.
    asked = stored(asked.groupBy("part", "seq", F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("split")).agg(F.collect_set("doc_id").alias("asked")), "lookup-keys")
    parts = sorted(r.part for r in asked.select("part").distinct().collect())  # no more than the store has
    near = F.lit(False)
    for low, high in spans(parts):
        near = near | F.col("part").between(low, high)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                [row] = batch.slice(at, 1).to_pylist()
                own = np.array(row["asked"], np.int64)
                found = [(int(own[i]), ids.astype(np.int64).tolist()) for i, _, ids in slices(row, own)]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return shards.where(near).join(asked, ["part", "seq"]).select(*shards.columns, "asked").mapInArrow(fetch, "doc_id long, ids array<long>")


def spans(numbers: list[int], most: int = 64) -> list[tuple[int, int]]:
    """At most `most` ranges that hold all `numbers` (sorted), with the smallest gaps between them filled."""
    gaps = sorted(range(1, len(numbers)), key=lambda i: numbers[i - 1] - numbers[i])[: most - 1]
    cuts = [0, *sorted(i for i in gaps if numbers[i] - numbers[i - 1] > 1), len(numbers)]
    return [(numbers[a], numbers[b - 1]) for a, b in zip(cuts, cuts[1:]) if b > a]


def token_store(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Writes `docs` as a store and reads it back: `doc_id`, `start`, `n_tokens` (with the end id), `ids_crc32`.

    A null text is empty (1 id). A null id stays null and comes first; such documents are stored but not
    indexed. Rows that share an id are each stored, and the index leads to all of them, if they lie in one
    shard; `lookup` asks every shard whose range holds the key. A very long text is encoded alone and never
    divided between shards. Other columns, whatever their names, are left out. An empty table gives an empty store.
    """
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/token-store-{uuid.uuid4().hex}"
    write_store(docs, path, **options)
    return read_documents(spark, path)


def query(spark, sf_dir: str) -> DataFrame:
    return token_store(load(spark, sf_dir, "documents"))
