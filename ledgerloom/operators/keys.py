"""Keys: which columns, how good, how many, and new ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.folders import stored

#: Column names that serve as a key where a table declares none.
FALLBACK_NAMES = ("id", "idx")


def resolve_sync_keys(columns: DataFrame, index_cols: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """W1. The sync key of each table: an override, else primary key, unique index, a column named id or idx, any column.

    `columns`: table_name, column_name, ordinal, is_nullable, is_identity, default_def.
    `index_cols`: table_name, index_name, column_name, key_ordinal, is_primary, is_unique, has_filter; included
    columns have key_ordinal 0. Filtered indexes and included columns are skipped. Of several indexes of a
    kind the first name counts. `key_columns` is the whole ordered key, `sync_key` its first column.
    """
    usable = index_cols.where((F.col("key_ordinal") > 0) & ~F.col("has_filter") & (F.col("is_primary") | F.col("is_unique")))
    priority = F.when(F.col("is_primary"), 1).otherwise(2)
    of_index = usable.groupBy("table_name", "index_name", priority.alias("priority")).agg(F.transform(F.array_sort(F.collect_list(F.struct("key_ordinal", "column_name"))), lambda s: s["column_name"]).alias("key_columns"))
    named = F.lower("column_name").isin(*FALLBACK_NAMES)
    of_column = columns.groupBy("table_name").agg(F.min(F.struct(F.when(named, 3).otherwise(4).alias("priority"), "ordinal", "column_name")).alias("c"))
    candidates = of_index.select("table_name", "priority", F.col("index_name").alias("tie"), "key_columns").unionByName(
        of_column.select("table_name", F.col("c.priority").alias("priority"), F.lit("").alias("tie"), F.array("c.column_name").alias("key_columns"))
    )
    if overrides:
        chosen = columns.select("table_name").distinct()
        forced = F.create_map(*(F.lit(x) for kv in overrides.items() for x in kv))
        candidates = candidates.unionByName(chosen.select("table_name", F.lit(0).alias("priority"), F.lit("").alias("tie"), F.array(forced[F.col("table_name")]).alias("key_columns")).where("key_columns[0] IS NOT NULL"))
    best = candidates.groupBy("table_name").agg(F.min(F.struct("priority", "tie", "key_columns")).alias("k"))
    first = best.select("table_name", F.col("k.priority").alias("priority"), F.col("k.key_columns").alias("key_columns"), F.col("k.key_columns")[0].alias("sync_key"))
    about = columns.select("table_name", F.col("column_name").alias("sync_key"), "is_nullable", "is_identity", "default_def")
    verdict = F.when(F.col("is_identity"), "identity").when(F.col("default_def").isNotNull(), "default").when(F.col("is_nullable"), "nullable").otherwise("manual")
    return first.join(about, ["table_name", "sync_key"], "left").select("table_name", "sync_key", "key_columns", "priority", verdict.alias("verdict"))


def dedup_by_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """W2. The first row of each key in the given (total) order."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def collapsed(df: DataFrame, keys: list[str]) -> DataFrame:
    """W2. How many rows a deduplication by key drops."""
    each = df.groupBy(*keys).count()
    return each.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_collapsed"))


def key_quality(df: DataFrame, key: str) -> DataFrame:
    """A6. Rows, distinct keys, null keys, and the verdict: OK only for a key without repeats and nulls, RISK for an empty table."""
    sums = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    found = sums.agg(F.sum("n").alias("n_rows"), F.count("k").alias("n_distinct"), F.sum(F.when(F.col("k").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    ok = (F.col("n_rows") == F.col("n_distinct")) & (F.col("n_null") == 0)
    return found.select(F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "n_distinct", F.col("n_null"), F.when(ok, "OK").otherwise("RISK").alias("verdict"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A7. Key values with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def next_key(df: DataFrame, key: str) -> DataFrame:
    """A8. One above the largest whole-number key; 1 for none. Keys that are no numbers don't count."""
    whole = F.col(key).try_cast("bigint") if not isinstance(df.schema[key].dataType, T.DecimalType) else F.col(key).cast("bigint")
    return df.agg((F.coalesce(F.max(whole), F.lit(0)) + 1).alias("next_key"))


def add_dense_id(df: DataFrame, order: list[str], name: str, start: int | Column = 1) -> DataFrame:
    """H1. Ids `start`, `start` + 1, ... in a total order, without moving all rows to one task.

    Rows are dealt by ranges of the order and sorted within each; ids are the rows of earlier ranges plus the
    place in the own one. Ranges come from a sample, so the dealt rows are written once, for both passes.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mono", F.monotonically_increasing_id())
    dealt = dealt.withColumns({"_part": F.shiftright("_mono", 33), "_place": F.col("_mono").bitwiseAND((1 << 33) - 1)}).drop("_mono")
    dealt = stored(dealt, "dense-ids")
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task, not a row a row
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    own = dealt.join(F.broadcast(offsets), "_part")
    first = start if isinstance(start, Column) else F.lit(start)
    return own.withColumn(name, (F.col("_offset") + F.col("_place") + first).cast("long")).drop("_part", "_place", "_offset")


def add_surrogate_key(df: DataFrame, order: list[str], start: int = 1, name: str = "sync_row_id") -> DataFrame:
    """W3. A dense id for a table without key."""
    return add_dense_id(df, order, name, start)


def allocate_keys(inserts: DataFrame, target: DataFrame, key: str, order: list[str]) -> DataFrame:
    """W4. Rows that come without key get the ids after the largest of the target."""
    start = next_key(target, key).first()[0]
    return add_dense_id(inserts.drop(key), order, key, start)


def keyset_batches(df: DataFrame, key: str, n: int, order: list[str] | None = None) -> DataFrame:
    """W5. Batches of `n` rows in key order, each with its bounds (low, high]; the first has no low."""
    ranked = add_dense_id(df, order or [key], "_rank", 0)
    each = ranked.groupBy(F.expr(f"_rank div {int(n)}").alias("batch")).agg(F.min(key).alias("first_key"), F.max(key).alias("high"), F.count("*").alias("n_rows"))
    previous = each.select((F.col("batch") + 1).alias("batch"), F.col("high").alias("low"))
    return each.join(previous, "batch", "left").select("batch", "low", "high", "n_rows")
