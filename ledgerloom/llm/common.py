"""What the corpus operators share: reading tables, cutting lineage, reproducible folds."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.folders import shared_folder

#: Rows and bytes of an Arrow batch. Documents are large, and a batch is held by Spark and by Python.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
#: Rows and bytes of what Python works on at once; a longer text comes alone.
SLICE_ROWS, SLICE_BYTES = 1024, 8 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. The session's Arrow batches are bounded here, as every query of this folder begins with it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """`df` written as a table in the shared folder (or in `folder`, which its owner removes) and read back: lineage ends here, and a lost executor costs nothing."""
    path = f"{folder or shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of a sieve a key, and the most it has: 2 ** 27 bits are 2 ** 21 rows of 16 bytes to send to every task.
SIEVE_BITS, MOST_SIEVE_BITS = 16, 1 << 27


def sieved(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """`df` with `_may`: false only where `column` is certainly none of `keys` (stored, one column); so wide rows need no shuffle to learn that.

    A Bloom filter with one hash, as a table of 64-bit words of a bounded size. Where keys are too many for it,
    it lets more rows pass, and an exact join must follow in any case.
    """
    bits = min(MOST_SIEVE_BITS, max(1 << 16, 1 << (SIEVE_BITS * keys.count()).bit_length()))
    at = lambda c: F.pmod(F.xxhash64(c, F.lit("sieve")), F.lit(bits))
    held = keys.select(at(keys.columns[0]).alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(_at & 63 AS INT))")).alias("_held"))
    asked = df.withColumn("_at", at(column)).withColumn("_word", F.shiftright("_at", 6))
    found = asked.join(F.broadcast(held), "_word", "left")
    return found.withColumn("_may", F.coalesce(F.expr("_held & shiftleft(1L, CAST(_at & 63 AS INT)) <> 0"), F.lit(False))).select(*df.columns, "_may")


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


_KEPT: dict = {}


def kept(key: tuple, make: Callable):
    """What `make` returned for `key`, kept by this worker process after its task ends. A worker keeps one thing at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def by_number(docs: DataFrame) -> DataFrame:
    """`docs` with its columns named c0, c1, ..., so that no new column clashes with one."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches in order, halved until each has at most `rows` rows and `size` bytes, or one row."""
    for batch in batches:
        left = [batch] if batch.num_rows else []
        while left:
            part = left.pop()
            if part.num_rows == 1 or part.num_rows <= rows and part.nbytes <= size:
                yield part
            else:
                half = part.num_rows // 2
                left += [part.slice(half), part.slice(0, half)]


def ascii_lower_table(keep: str = "") -> bytes:
    """A table for bytes.translate that lower-cases A-Z."""
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    return bytes(table)
