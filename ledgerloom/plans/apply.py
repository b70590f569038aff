"""Whole jobs made of the operators: apply a change log, sync what is missing, label what is old."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import changelog, diff, keys, lineage, merge
from ledgerloom.sources.folders import stored


def apply_changes(log: DataFrame, source: DataFrame, target: DataFrame, table: str, key: str, order: list[str]) -> DataFrame:
    """The target after the pending changes of one table: coalesce, count, fetch current rows, deduplicate, store, upsert.

    `order` says which of several source rows with one key counts; the other columns break its ties.
    """
    items = stored(changelog.work_items(log.where(F.col("table_name") == table)).select("pk_value"), "items")
    current = merge.fetch_changed(source, items, key, items.count())
    once = stored(keys.dedup_by_key(current, [key], [*order, *(c for c in current.columns if c not in order)]), "changes")
    return merge.merge_upsert(target, once, [key], changes_count=once.count())


def sync_missing(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The target after a differential sync: rows that it lacks are inserted, others stay."""
    return merge.insert_absent(target, diff.missing_rows(source, target, [key]), [key])


def consolidate_sources(target: DataFrame, sources: dict[str, DataFrame], key: str) -> DataFrame:
    """One target fed by several sources: each is stamped and merged by lineage."""
    for source_id, df in sources.items():
        merged = merge.merge_by_lineage(target, lineage.stamp_lineage(df, source_id, key), source_id, key)
        target = merged.drop("_action")
    return target
