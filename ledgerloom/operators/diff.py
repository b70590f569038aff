"""What a target lacks, and whether both sides hold as much."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import tokens
from ledgerloom.operators.changelog import in_scope


def same(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool = True):
    """The join condition of equal keys; null-safe, it stays an equi-join."""
    equal = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    return reduce(lambda a, b: a & b, (equal(left[k], right[k]) for k in keys))


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.StringType, T.CharType, T.VarcharType))


def missing_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """J2. Rows of the source whose full key the target lacks; null keys compare equal. Only keys of the target move.

    Keys of one type compare as they are. Where one side has texts and the other times or numbers, both compare
    by their tokens (F2).
    """
    form = lambda df, k: tokens.key_token(F.col(k), df.schema[k].dataType) if is_text(source, k) != is_text(target, k) else F.col(k)
    names = [f"_k_{i}" for i in range(len(keys))]
    own = target.select(*(form(target, k).alias(f"_t{n}") for k, n in zip(keys, names)))
    marked = source.withColumns({n: form(source, k) for k, n in zip(keys, names)})
    on = reduce(lambda a, b: a & b, (marked[n].eqNullSafe(own[f"_t{n}"]) for n in names))
    return marked.join(own, on, "left_anti").drop(*names)


def missing_by_lineage(source: DataFrame, target: DataFrame, key: str, source_id: str) -> DataFrame:
    """J3. Rows of the source whose key token is no `source_record_id` of this source on the target."""
    held = target.where((F.col("sync_source_id") == source_id) & F.col("source_record_id").isNotNull()).select(F.col("source_record_id").alias("_token"))
    return source.withColumn("_own", tokens.source_record_token(F.col(key), source.schema[key].dataType)).join(held, F.col("_own") == F.col("_token"), "left_anti").drop("_own")


def watermark(target: DataFrame, source_id: str) -> int | None:
    """The largest numeric record id of this source on the target."""
    number = F.coalesce(F.col("source_record_id").try_cast("bigint"), F.col("source_record_id").try_cast("decimal(38,4)").try_cast("bigint"))
    return target.where(F.col("sync_source_id") == source_id).agg(F.max(number)).first()[0]


def rows_above_watermark(source: DataFrame, target: DataFrame, key: str, source_id: str) -> DataFrame:
    """J4. Rows of the source with a key above the watermark; all, without one. Gaps below it stay unseen (J3 is exact).

    The watermark becomes a literal, so that the filter reaches the source's scan.
    """
    mark = watermark(target, source_id)
    return source if mark is None else source.where(F.col(key) > F.lit(mark))


def table_counts(tables: dict[str, DataFrame], allow: tuple[str, ...] = (), deny: tuple[str, ...] = ()) -> DataFrame:
    """A4. Rows of each table in scope, by name."""
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, counts).where(in_scope(F.col("table_name"), allow, deny)).orderBy("table_name")


def sync_status(source_counts: DataFrame, target_counts: DataFrame, insert_only: bool = False) -> DataFrame:
    """A5. Per source table both counts, `SYNCED` or `NEEDS SYNC`, and whether an initial sync is needed. An absent target counts 0."""
    both = source_counts.withColumnRenamed("n_rows", "source_rows").join(target_counts.withColumnRenamed("n_rows", "target_rows"), "table_name", "left")
    target = F.coalesce("target_rows", F.lit(0))
    return both.select(
        "table_name",
        "source_rows",
        target.alias("target_rows"),
        F.when(F.col("source_rows") == target, "SYNCED").otherwise("NEEDS SYNC").alias("status"),
        (F.lit(insert_only) | (F.col("source_rows") > target)).alias("needs_initial_sync"),
    )


def reconcile_counts(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """J15. Both counts, their difference, and whether the target has fewer or lacks the table."""
    both = source_counts.withColumnRenamed("n_rows", "source_rows").join(target_counts.withColumnRenamed("n_rows", "target_rows"), "table_name", "left")
    return both.select(
        "table_name",
        "source_rows",
        "target_rows",
        (F.col("source_rows") - F.coalesce("target_rows", F.lit(0))).alias("difference"),
        (F.coalesce("target_rows", F.lit(0)) < F.col("source_rows")).alias("target_has_fewer"),
        F.col("target_rows").isNull().alias("absent_on_target"),
    )


