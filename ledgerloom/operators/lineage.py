"""Lineage: which source, which original record; labelling what came before it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import tokens

LINEAGE = ("sync_source_id", "source_record_id")


def stamp_lineage(df: DataFrame, source_id: str, key: str | tuple[str, ...]) -> DataFrame:
    """P5. `df` with its source and the token of its key."""
    return df.withColumns({"sync_source_id": F.lit(source_id), "source_record_id": tokens.record_token(df.schema, (key,) if isinstance(key, str) else key)})


def adopt_legacy(target: DataFrame, changes: DataFrame, key: str | tuple[str, ...], source_id: str, order: list[str] | None = None) -> DataFrame:
    """J12. The target with labels on unlabelled rows whose key is an incoming record id that nothing has matched.

    One row a key is adopted, the first in `order` (by default all columns). A merge by lineage then updates it.
    """
    order = order or target.columns
    token = tokens.record_token(target.schema, (key,) if isinstance(key, str) else key)
    held = target.where((F.col("sync_source_id") == source_id) & F.col("source_record_id").isNotNull()).select("source_record_id")
    wanted = changes.select("source_record_id").where("source_record_id IS NOT NULL").distinct().join(held, "source_record_id", "left_anti")
    loose = target.where(F.col("sync_source_id").isNull()).withColumn("_token", token)
    matched = loose.join(wanted.withColumnRenamed("source_record_id", "_wanted"), F.col("_token") == F.col("_wanted"), "left")
    first = Window.partitionBy("_wanted").orderBy(*order)
    hit = matched.where("_wanted IS NOT NULL").withColumn("_first", F.row_number().over(first) == 1)
    adopted = hit.select(*(F.col(c) for c in target.columns if c not in ("sync_source_id", "source_record_id")), F.when(F.col("_first"), F.lit(source_id)).alias("sync_source_id"), F.when(F.col("_first"), F.col("_token")).otherwise(F.col("source_record_id")).alias("source_record_id"))
    return target.where(F.col("sync_source_id").isNotNull()).unionByName(matched.where("_wanted IS NULL").select(*target.columns)).unionByName(adopted)


def lineage_duplicates(df: DataFrame) -> DataFrame:
    """A9. Lineage pairs that more than one row holds; pairs with a null are free."""
    named = df.where(F.col("sync_source_id").isNotNull() & F.col("source_record_id").isNotNull())
    return named.groupBy("sync_source_id", "source_record_id").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def identity_conflicts(claims: DataFrame) -> DataFrame:
    """A10. Sources claimed by more than one (host, database); null is the empty name."""
    place = claims.select("source_id", F.coalesce("source_host", F.lit("")).alias("host"), F.coalesce("source_db", F.lit("")).alias("db")).distinct()
    return place.groupBy("source_id").agg(F.count("*").alias("n_claims")).where("n_claims > 1")


def label_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """A11. Rows, labelled and unlabelled rows of each table, the worst first."""
    labelled = F.col("sync_source_id").isNotNull() & F.col("source_record_id").isNotNull()
    each = [df.agg(F.count("*").alias("n_rows"), F.count_if(labelled).alias("n_labelled")).select(F.lit(name).alias("table_name"), "n_rows", "n_labelled", (F.col("n_rows") - F.col("n_labelled")).alias("n_unlabelled")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, each).orderBy(F.desc("n_unlabelled"), "table_name")


def label_legacy(df: DataFrame, key: str, source_id: str, last_key: int | None = None, declared: str = "datetime2") -> DataFrame:
    """L4. Unlabelled rows get the source and the token of their key; `_labelled` marks them.

    Whole-number keys: every row above `last_key` (all, without one). Other keys: null and empty tokens stay unlabelled.
    """
    kind = df.schema[key].dataType
    token = tokens.legacy_label(F.col(key), kind, declared)
    free = F.col("sync_source_id").isNull()
    if isinstance(kind, T.IntegralType):
        hit = free & F.col(key).isNotNull() & (F.lit(True) if last_key is None else F.col(key) > last_key)
    else:
        hit = free & token.isNotNull() & (token != "")
    return df.withColumn("_labelled", hit).withColumns({"sync_source_id": F.when(F.col("_labelled"), F.lit(source_id)).otherwise(F.col("sync_source_id")), "source_record_id": F.when(F.col("_labelled"), token).otherwise(F.col("source_record_id"))})


def backfill_progress(labelled: dict[str, tuple[DataFrame, str]], errors: dict[str, str] | None = None) -> DataFrame:
    """L5. Per table its key column, the last key, rows labelled and the status; errors first."""
    each = [df.agg(F.max(F.col(key).try_cast("bigint")).alias("last_key"), F.count_if("_labelled").alias("rows_labelled")).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_col"), "last_key", "rows_labelled", F.lit((errors or {}).get(name, "DONE")).alias("status")) for name, (df, key) in labelled.items()]
    return reduce(DataFrame.unionByName, each).orderBy(F.when(F.col("status").isin("DONE", "RUNNING"), 1).otherwise(0), "table_name")


def backfill_plan(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """L6. Per table: OK for a whole-number key, OK-TEXT for text, times and uuids, SKIP with the reason otherwise.

    `candidates`: table_name, key_columns (W1), data_type of the first. `counts`: table_name, n_rows.
    """
    integers, texts = ("tinyint", "smallint", "int", "bigint"), ("char", "varchar", "nchar", "nvarchar", "datetime", "datetime2", "uniqueidentifier")
    n = F.coalesce(F.size("key_columns"), F.lit(0))
    verdict = F.when(n == 0, "SKIP").when(n > 1, "SKIP").when(F.col("data_type").isin(*integers), "OK").when(F.col("data_type").isin(*texts), "OK-TEXT").otherwise("SKIP")
    reason = F.when(n == 0, "no key").when(n > 1, "composite key").when(~F.coalesce(F.col("data_type").isin(*integers, *texts), F.lit(False)), F.concat(F.lit("key type "), F.coalesce("data_type", F.lit("unknown"))))
    return candidates.join(counts, "table_name", "left").select("table_name", F.when(n == 1, F.col("key_columns")[0]).alias("key_col"), verdict.alias("plan"), reason.alias("reason"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def consolidate(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """U1. Rows of several sources in one table, kept apart by `sync_source_id`; columns that a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (stamp_lineage(df, source_id, key) for source_id, (df, key) in sources.items()))


