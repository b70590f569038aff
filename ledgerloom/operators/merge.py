"""Applying changes to a target: by full key, by lineage, or only what is absent.

Parquet has no MERGE; a merge is the next state of the target as a DataFrame. With few
changes the target is not shuffled: the changes are broadcast, if their rows and bytes are
measured and few, to the target's rows, and once more to its keys, to find those without a
match. Else both sides are joined by a shuffle on the key. Changes are used more than
once, so they should be stored (`sources.folders.stored`) before they are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.diff import same

#: Rows and bytes of changes up to which they are sent to every task; `changes_count` says how many rows there are.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 64 << 20
#: Bytes for which a value of fixed size is counted.
VALUE_BYTES = 16
LINEAGE = ("sync_source_id", "source_record_id")


def size_of(df: DataFrame) -> int:
    """Bytes of the values of `df`: texts and bytes by their lengths, nested values by their JSON, others by a fixed size."""
    total = F.lit(0).cast("long")
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        total = total + VALUE_BYTES
    return df.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0]


def are_few(changes: DataFrame, count: int | None) -> bool:
    """Whether `changes`, `count` rows, are small enough for every task; few rows are measured, as they may be wide."""
    return count is not None and count <= BROADCAST_ROWS and size_of(changes) <= BROADCAST_BYTES


def fetch_changed(source: DataFrame, changes: DataFrame, key: str, changes_count: int | None = None) -> DataFrame:
    """J1. The current full rows of the source whose key is among the changed keys (text, as in the log)."""
    keys = changes.select(F.col("pk_value").try_cast(source.schema[key].dataType).alias("_key")).where("_key IS NOT NULL").distinct()
    keys = F.broadcast(keys) if changes_count is not None and changes_count <= BROADCAST_ROWS else keys  # keys are short
    return source.join(keys, source[key] == keys["_key"], "left_semi")


def drop_managed(df: DataFrame, computed: tuple[str, ...] = (), identity: tuple[str, ...] = (), default_cols: tuple[str, ...] = (), key: str | None = None, insert_only: bool = False) -> DataFrame:
    """P4. `df` without what the target makes itself: computed columns always; in insert-only mode identity columns too, and the key if the target generates it."""
    gone = {c.lower() for c in computed}
    if insert_only:
        gone |= {c.lower() for c in identity}
        if key and key.lower() in {c.lower() for c in (*identity, *default_cols)}:
            gone.add(key.lower())
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in gone))


def _merged(target: DataFrame, keys: list[str], on: Column, update: list[str], changed: DataFrame, few: bool) -> DataFrame:
    """Target rows with the columns `update` of a matching change, and changes without a match; `_action` is U, I or null."""
    incoming = changed.withColumn("_hit", F.lit(True))
    names = target.columns
    fresh = lambda c: F.col(f"_c_{c}")
    action = F.when(F.col("_hit") & F.col("_here"), "U").when(F.col("_hit"), "I")
    here = target.withColumn("_here", F.lit(True))
    if few:
        kept = here.join(F.broadcast(incoming), on, "left")
        # The keys that a change has matched are no more than there are changes.
        matched = target.select(*keys).join(F.broadcast(changed), on, "left_semi").distinct()
        new = incoming.join(F.broadcast(matched), on, "left_anti").withColumns({"_here": F.lit(None).cast("boolean"), **{c: F.lit(None).cast(target.schema[c].dataType) for c in names}})
        both = kept.unionByName(new)
    else:
        both = here.join(incoming, on, "full_outer")
    columns = []
    for c in names:
        if f"_c_{c}" not in changed.columns:
            columns.append(F.col(c))
        elif c in update:
            columns.append(F.when(F.col("_hit"), fresh(c)).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c))
        else:
            columns.append(F.when(F.col("_here"), F.col(c)).otherwise(fresh(c)).cast(target.schema[c].dataType).alias(c))
    return both.select(*columns, action.alias("_action"))


def _prefixed(changes: DataFrame) -> DataFrame:
    return changes.select(*(F.col(f"`{c}`").alias(f"_c_{c}") for c in changes.columns))


def merge_upsert(target: DataFrame, changes: DataFrame, keys: list[str], identity: tuple[str, ...] = (), changes_count: int | None = None) -> DataFrame:
    """J7, J9. The target after an upsert by full key, with `_action` (U, I or null for untouched rows).

    A match overwrites all columns that the changes hold but key and identity, nulls included; other rows and
    columns stay. Changes must be unique by key (W2). Nulls match in composite keys, not in single ones. With
    `sync_source_id` among the keys only rows of the same source match.
    """
    changed = _prefixed(changes)
    pairs = [(target[k], changed[f"_c_{k}"]) for k in keys]
    on = pairs[0][0] == pairs[0][1] if len(pairs) == 1 else None
    if on is None:
        on = F.lit(True)
        for a, b in pairs:
            on = on & a.eqNullSafe(b)
    update = [c for c in changes.columns if c not in keys and c not in identity]
    return _merged(target, keys, on, update, changed, are_few(changed, changes_count))


def merge_by_lineage(target: DataFrame, changes: DataFrame, source_id: str, key: str, identity: tuple[str, ...] = (), preserve_pk: bool = False, changes_count: int | None = None) -> DataFrame:
    """J8, J11. The target after an insert-only merge on (sync_source_id, source_record_id), with `_action`.

    A match updates all but key, identity and the pair; what has no match is inserted, without its key unless
    `preserve_pk` (the target gives it one, W4). A null record id never matches: such rows go past the join.
    """
    changes = changes.withColumn("sync_source_id", F.lit(source_id))
    if not preserve_pk:
        changes = changes.withColumn(key, F.lit(None).cast(target.schema[key].dataType))
    update = [c for c in changes.columns if c not in (key, *LINEAGE, *identity)]
    named, nameless = changes.where(F.col("source_record_id").isNotNull()), changes.where(F.col("source_record_id").isNull())
    changed = _prefixed(named)
    on = (target["sync_source_id"] == changed["_c_sync_source_id"]) & (target["source_record_id"] == changed["_c_source_record_id"])
    merged = _merged(target, list(LINEAGE), on, update, changed, are_few(changed, changes_count))
    new = nameless.select(*(F.col(c).cast(target.schema[c].dataType).alias(c) if c in changes.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns), F.lit("I").alias("_action"))
    return merged.unionByName(new)


def merge_counts(merged: DataFrame) -> DataFrame:
    """Rows updated, inserted and untouched by a merge."""
    return merged.groupBy(F.coalesce("_action", F.lit("-")).alias("action")).agg(F.count("*").alias("n_rows"))


def insert_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """J10. The target with the rows whose key it lacks. Doing it twice changes nothing."""
    held = target.select(*keys)
    on = same(rows, held, keys, null_safe=len(keys) > 1)
    return target.unionByName(rows.join(held, on, "left_anti").select(*target.columns))
