"""S5. Targets in layers: base files by bucket, small deltas over them, merged on read.

A row belongs to an identity, a text (its key, or what its lineage says). A delta holds
all rows that the identities of a batch have now, and nothing else, so a batch of k keys
writes as many rows as these have, in files of its own. A reader takes the rows of an
identity from the newest delta that holds it, else from the base. Once there are `LAYERS`
deltas, the buckets that they touch are written anew as base.

The manifest of a version is one small file and says all: schema, number of buckets, the
version that each bucket's base is in, and the deltas, each with the range of its
identities and a Bloom filter of them, by which lookups pass over deltas. It is written
last, so readers see all of a version or nothing, and a version that is written again
after a failure is the same. `vacuum` removes what no kept manifest names.
"""

from __future__ import annotations

import base64
import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.folders import children, read_text, remove, write_text
from ledgerloom.sources.tables import current_version, versions

#: Buckets of a target unless it is made with another number; as many as keep a bucket's base near 128 MB are right.
BUCKETS = 16
#: Deltas from which a write folds them into the base.
LAYERS = 16
#: Bits of a delta's Bloom filter, which has one hash.
BLOOM_BITS = 1 << 15
IDENTITY, BUCKET, LAYER = "_identity", "_bucket", "_layer"


class Delta(NamedTuple):
    version: int
    rows: int
    low: str
    high: str
    bits: str
    buckets: list[int]


class Manifest(NamedTuple):
    version: int
    kind: dict
    buckets: int
    base: dict[str, int]
    deltas: list[Delta]
    #: What the owner of the table keeps with a version, such as the next key.
    extra: dict

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.kind)


def read_manifest(spark: SparkSession, path: str, before: int | None = None) -> Manifest:
    """The manifest of the latest version (below `before`): one file is read, however many versions there are."""
    last = current_version(spark, path, before)
    if last is None:
        raise FileNotFoundError(f"no version of {path} is complete")
    x = json.loads(read_text(spark, f"{path}/pointer/version={last}"))
    return Manifest(x["version"], x["kind"], x["buckets"], x["base"], [Delta(*d) for d in x["deltas"]], x["extra"])


def _commit(spark: SparkSession, path: str, m: Manifest) -> None:
    write_text(spark, f"{path}/pointer/version={m.version}", json.dumps(m._asdict()))


def bucket_of(identity: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(identity), F.lit(buckets)).cast("int")


def _bit(identity: Column) -> Column:
    return F.pmod(F.xxhash64(identity, F.lit("bloom")), F.lit(BLOOM_BITS))


class Wanted(NamedTuple):
    """Some identities and what tells the files that may hold them."""

    identities: DataFrame
    rows: int
    low: str | None
    high: str | None
    bits: bytes
    buckets: list[int]

    def may_be_in(self, d: Delta) -> bool:
        own = int.from_bytes(base64.b64decode(d.bits), "little")
        return self.low is not None and self.low <= d.high and d.low <= self.high and bool(own & int.from_bytes(self.bits, "little"))


def wanted(identities: DataFrame, buckets: int) -> Wanted:
    """`identities` (a column `_identity`) with their number, range, filter and buckets: one small row."""
    c = F.col(IDENTITY)
    r = identities.where(c.isNotNull()).agg(F.count("*").alias("rows"), F.min(c.cast("binary")).alias("low"), F.max(c.cast("binary")).alias("high"), F.bitmap_construct_agg(_bit(c)).alias("bits"), F.sort_array(F.collect_set(bucket_of(c, buckets))).alias("buckets")).first()
    text = lambda b: None if b is None else bytes(b).decode("utf-8")
    return Wanted(identities, r.rows, text(r.low), text(r.high), bytes(r.bits), list(r.buckets))


def _with_identity(kind: T.StructType, *more: tuple[str, str]) -> T.StructType:
    out = T.StructType(list(kind)).add(IDENTITY, "string")
    for name, t in more:
        out = out.add(name, t)
    return out


def _read(spark: SparkSession, path: str, m: Manifest, some: Wanted | None = None, only: set[int] | None = None) -> DataFrame:
    """Rows with their identities: all, those of `some` identities, or those in the buckets `only`."""
    touched = only if some is None else set(some.buckets)
    paths = [f"{path}/version={v}/{BUCKET}={b}" for b, v in sorted(m.base.items(), key=lambda x: int(x[0])) if touched is None or int(b) in touched]
    base = spark.read.schema(_with_identity(m.schema)).parquet(*paths) if paths else spark.createDataFrame([], _with_identity(m.schema))
    if some is not None:
        base = base.join(some.identities.select(IDENTITY), IDENTITY, "left_semi")
    deltas = [d for d in m.deltas if (some is None or some.may_be_in(d)) and (only is None or not only.isdisjoint(d.buckets))]
    if not deltas:
        return base.select(*m.schema.names, IDENTITY)
    rows = spark.read.schema(_with_identity(m.schema, (LAYER, "long"), (BUCKET, "integer"))).parquet(*(f"{path}/delta={d.version}" for d in deltas))
    if some is not None:
        rows = rows.join(some.identities.select(IDENTITY), IDENTITY, "left_semi")
    if only is not None:
        rows = rows.where(F.col(BUCKET).isin(sorted(only)))
    newest = rows.groupBy(IDENTITY).agg(F.max(LAYER).alias("_newest"))
    live = rows.join(newest, IDENTITY).where(F.col(LAYER) == F.col("_newest"))
    columns = [*m.schema.names, IDENTITY]
    return base.join(newest, IDENTITY, "left_anti").select(*columns).unionByName(live.select(*columns))


def read(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The table as of its latest version (below `before`)."""
    m = read_manifest(spark, path, before)
    return _read(spark, path, m).drop(IDENTITY)


def lookup(spark: SparkSession, path: str, identities: DataFrame | Wanted, before: int | None = None) -> DataFrame:
    """The rows of some identities: only buckets and deltas that may hold them are read."""
    m = read_manifest(spark, path, before)
    return _read(spark, path, m, identities if isinstance(identities, Wanted) else wanted(identities, m.buckets)).drop(IDENTITY)


def _write_base(df: DataFrame, path: str, version: int, buckets: int) -> set[int]:
    """Writes rows with identities as base files of a version; the buckets that got some."""
    where = f"{path}/version={version}"
    df.withColumn(BUCKET, bucket_of(F.col(IDENTITY), buckets)).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, IDENTITY).write.partitionBy(BUCKET).mode("overwrite").parquet(where)
    return {int(name.split("=")[1]) for name in children(df.sparkSession, where) if name.startswith(f"{BUCKET}=")}


def create(df: DataFrame, path: str, identity: Column, version: int = -1, buckets: int = BUCKETS, extra: dict | None = None) -> None:
    """The first version of a table; the number of its buckets stays with it. Rows without an identity share the empty one."""
    held = _write_base(df.withColumn(IDENTITY, F.coalesce(identity, F.lit(""))), path, version, buckets)
    _commit(df.sparkSession, path, Manifest(version, df.schema.jsonValue(), buckets, {str(b): version for b in held}, [], extra or {}))


def write_delta(df: DataFrame, path: str, version: int, identity: Column, touched: Wanted, extra: dict | None = None, layers: int = LAYERS) -> None:
    """A new version in which the `touched` identities have the rows `df`, and others what they had.

    `df` may have columns that the table lacks, which older rows get as nulls. With `layers` deltas
    the buckets that any of them touches become base files.
    """
    spark, m = df.sparkSession, read_manifest(df.sparkSession, path, version)
    kind = T.StructType([*m.schema, *(f for f in df.schema if f.name not in m.schema.names)])
    own = df.withColumn(IDENTITY, F.coalesce(identity, F.lit(""))).withColumns({LAYER: F.lit(version).cast("long"), BUCKET: bucket_of(F.col(IDENTITY), m.buckets)})
    new = m._replace(version=version, kind=kind.jsonValue(), extra=m.extra if extra is None else extra)
    if touched.rows:
        own.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, IDENTITY).write.mode("overwrite").parquet(f"{path}/delta={version}")
        delta = Delta(version, touched.rows, touched.low, touched.high, base64.b64encode(touched.bits).decode(), touched.buckets)
        new = new._replace(deltas=[*m.deltas, delta])
    if len(new.deltas) >= layers:
        dirty = {b for d in new.deltas for b in d.buckets}
        held = _write_base(_read(spark, path, new, only=dirty), path, version, m.buckets)
        base = {b: v for b, v in m.base.items() if int(b) not in dirty} | {str(b): version for b in held}
        new = new._replace(base=base, deltas=[])
    _commit(spark, path, new)


def vacuum(spark: SparkSession, path: str, keep: int = 3) -> None:
    """Removes manifests but the last `keep`, and files that none of those names."""
    every = versions(spark, path)
    kept = [read_manifest(spark, path, v + 1) for v in every[-keep:]]
    named = {f"version={v}" for m in kept for v in m.base.values()} | {f"delta={d.version}" for m in kept for d in m.deltas}
    last = every[-1] if every else 0
    for v in every[:-keep]:
        remove(spark, f"{path}/pointer/version={v}")
    for name in children(spark, path):
        # What is newer than the last manifest is being written.
        if name.startswith(("version=", "delta=")) and name not in named and int(name.split("=")[1]) <= last:
            remove(spark, f"{path}/{name}")
