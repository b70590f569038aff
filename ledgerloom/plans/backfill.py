"""The back-fill as a job that can be killed: L4 range by range (W5), with its progress (L5) in the versions of the target."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import keys, lineage
from ledgerloom.sources import layers

#: Rows of a range. A range reads the key column of the whole target once, so there should not be many.
RANGE_ROWS = 50_000_000
#: Deltas from which the target's base is written anew: seldom, as each range makes one.
LAYERS = 64
PROGRESS = "table_name string, key_col string, last_key string, rows_labelled long, status string"


def between(key: str, low, high) -> Column:
    above = F.lit(True) if low is None else F.col(key) > F.lit(low)
    return above & (F.col(key) <= F.lit(high))


def run_backfill(spark: SparkSession, path: str, key: str, source_id: str, identity: Callable[[T.StructType], Column], range_rows: int = RANGE_ROWS, declared: str = "datetime2", most_ranges: int | None = None) -> None:
    """Labels the unlabelled rows of a layered target, a version a range.

    A version holds the labels of its range and how far the job has come, in one commit, so that a job which is
    killed at any moment and started again ends as one that was not. Whole-number keys go on after the last
    committed key. Texts and other keys are swept: each start looks at all rows that are unlabelled still. Null
    keys and empty tokens stay unlabelled. `most_ranges` ends a run early.
    """
    m = layers.read_manifest(spark, path)
    kind = m.schema[key].dataType
    state = m.extra.get("backfill", {}).get(source_id, {"last_key": None, "rows": 0})
    whole = isinstance(kind, T.IntegralType)
    open_ = layers.read(spark, path).where(F.col("sync_source_id").isNull() & F.col(key).isNotNull())
    if whole and state["last_key"] is not None:
        open_ = open_.where(F.col(key) > state["last_key"])
    ranges = keys.keyset_batches(open_.select(key), key, range_rows).orderBy("batch").select("low", "high").collect()  # a row a range
    for at, r in enumerate(ranges):
        if most_ranges is not None and at >= most_ranges:
            return
        state = _label_range(spark, path, key, source_id, identity, r.low, r.high, state, declared, whole)
    m = layers.read_manifest(spark, path)
    nothing = layers.wanted(spark.createDataFrame([], f"{layers.IDENTITY} string"), m.buckets)
    layers.write_delta(layers.read(spark, path).limit(0), path, m.version + 1, identity(m.schema), nothing, _with_state(m, source_id, state | {"status": "DONE"}), LAYERS)


def _with_state(m: layers.Manifest, source_id: str, state: dict) -> dict:
    return {**m.extra, "backfill": {**m.extra.get("backfill", {}), source_id: state}}


def _label_range(spark, path, key, source_id, identity, low, high, state, declared, whole) -> dict:
    m = layers.read_manifest(spark, path)
    mine = F.col("sync_source_id").isNull() & between(key, low, high)
    own = lineage.label_legacy(layers.read(spark, path).where(mine), key, source_id, declared=declared).where("_labelled")
    # A label may file a row under another identity: rows of both are written.
    before = own.withColumns({c: F.lit(None).cast("string") for c in lineage.LINEAGE}).select(identity(m.schema).alias(layers.IDENTITY))
    touched = layers.wanted(before.union(own.select(identity(m.schema).alias(layers.IDENTITY))).distinct(), m.buckets)
    part = layers.lookup(spark, path, touched)
    labelled = lineage.label_legacy(part.where(mine), key, source_id, declared=declared)
    n = labelled.where("_labelled").count()
    state = {"last_key": high if whole else str(high), "rows": state["rows"] + n, "status": "RUNNING"}
    rows = labelled.drop("_labelled").unionByName(part.where(~F.coalesce(mine, F.lit(False))))
    layers.write_delta(rows.select(*m.schema.names), path, m.version + 1, identity(m.schema), touched, _with_state(m, source_id, state), LAYERS)
    return state


def progress(spark: SparkSession, targets: dict[str, tuple[str, str]], source_id: str) -> DataFrame:
    """L5. Of each target (its path and key column) the last key, the rows labelled and the status; those not begun are PENDING."""
    rows = []
    for name, (path, key) in targets.items():
        s = layers.read_manifest(spark, path).extra.get("backfill", {}).get(source_id, {})
        rows.append((name, key, None if s.get("last_key") is None else str(s["last_key"]), s.get("rows", 0), s.get("status", "PENDING")))
    return spark.createDataFrame(rows, PROGRESS).orderBy(F.when(F.col("status").isin("DONE", "RUNNING"), 1).otherwise(0), "table_name")
