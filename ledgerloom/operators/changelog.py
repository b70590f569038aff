"""The change log: capture, poll, coalesce, mark, purge."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import tokens

PENDING, PROCESSED, PARKED = "pending", "processed", "deferred_max"
MAX_RETRIES = 10
#: Operations that lead to a write.
WRITES = ("I", "U")
#: Tables of the system or of replication itself; `\\_` is an underscore.
SYSTEM_NAMES = ("sys%", "MSr%", "%\\_tracking", "sync\\_audit\\_log", "sync\\_source\\_registry", "sync\\_backfill\\_progress")


def in_scope(name: Column, allow: Iterable[str] = (), deny: Iterable[str] = ()) -> Column:
    """P1 as a condition. An empty allow-list allows every table."""
    ok = F.lit(True)
    for pattern in SYSTEM_NAMES:
        ok = ok & ~name.like(pattern)
    allow, deny = list(allow), list(deny)
    if allow:
        ok = ok & name.isin(allow)
    return ok & ~name.isin(deny) if deny else ok


def scope_tables(df: DataFrame, allow: Iterable[str] = (), deny: Iterable[str] = (), column: str = "table_name") -> DataFrame:
    """P1. Rows of tables in scope."""
    return df.where(in_scope(F.col(column), allow, deny))


def change_rows(df: DataFrame, table: str, key: str, op: str, declared: str = "datetime2") -> DataFrame:
    """S2. A pending change row for each row of a batch of inserted or updated records."""
    return df.select(F.lit(table).alias("table_name"), tokens.capture_key_text(F.col(key), df.schema[key].dataType, declared).alias("pk_value"), F.lit(op).alias("operation"), F.lit(PENDING).alias("status"))


def poll_pending(log: DataFrame, n: int) -> DataFrame:
    """S3. The `n` pending rows with the lowest log ids."""
    return log.where(F.col("status") == PENDING).orderBy("log_id").limit(n)


def queue_changes(log: DataFrame, keys: DataFrame, table: str, key: str, op: str = "I") -> DataFrame:
    """S4. The log with a pending change for each key. Queued rows have no log id until the store gives one."""
    new = keys.select(F.lit(table).alias("table_name"), tokens.audit_token(F.col(key), keys.schema[key].dataType).alias("pk_value"), F.lit(op).alias("operation"), F.lit(PENDING).alias("status"), F.lit(0).alias("retry_count"))
    return log.unionByName(new, allowMissingColumns=True)


def coalesce_changes(log: DataFrame, with_ids: bool = True) -> DataFrame:
    """A1. One work item for each (table, key): its operations, its last log id, and with `with_ids` all of them.

    The write path needs only the last id; a key changed a million times then stays one small row.
    """
    ids = [F.sort_array(F.collect_list("log_id")).alias("log_ids")] if with_ids else []
    grouped = log.groupBy("table_name", "pk_value").agg(F.sort_array(F.collect_set("operation")).alias("operations"), F.max("log_id").alias("last_log_id"), F.count("*").alias("n_changes"), *ids)
    return grouped.withColumn("writes", F.arrays_overlap("operations", F.array(*map(F.lit, WRITES))))


def work_items(log: DataFrame, allow: Iterable[str] = (), deny: Iterable[str] = ()) -> DataFrame:
    """Pending (table, key) pairs in scope that lead to a write."""
    return coalesce_changes(scope_tables(log.where(F.col("status") == PENDING), allow, deny), with_ids=False).where("writes")


def status_counts(log: DataFrame) -> DataFrame:
    """A2. Rows of each status."""
    return log.groupBy("status").agg(F.count("*").alias("n_rows"))


def pending_by_table(log: DataFrame) -> DataFrame:
    """A3. Pending rows of each table, largest first."""
    return log.where(F.col("status") == PENDING).groupBy("table_name").agg(F.count("*").alias("n_pending")).orderBy(F.desc("n_pending"), "table_name")


def apply_outcomes(log: DataFrame, outcomes: DataFrame, now: str, source_id: str, max_retries: int = MAX_RETRIES, allow: Iterable[str] = (), deny: Iterable[str] = ()) -> DataFrame:
    """L1. The log after a batch that has read all of it. `outcomes`: (table_name, pk_value, outcome `done` or `deferred`, reason).

    All pending log rows of a key share its outcome. Rows out of scope, and keys whose only changes lead to
    no write (outcome `done`), are processed. A deferred row is parked at `max_retries`.
    """
    known = outcomes.select("table_name", "pk_value", "outcome", "reason")
    rows = log.drop("reason").join(known, ["table_name", "pk_value"], "left").select(*log.columns, "outcome", "reason")
    return marked(rows.withColumn("outcome", F.when(~in_scope(F.col("table_name"), allow, deny), "done").otherwise(F.col("outcome"))), now, source_id, max_retries)


def marked(rows: DataFrame, now: str, source_id: str | None, max_retries: int = MAX_RETRIES) -> DataFrame:
    """L1. Log rows with their `outcome` (done, deferred or null) and `reason`, as they are after it."""
    names = [c for c in rows.columns if c not in ("outcome", "reason", "source_id")]
    open_ = F.col("status") == PENDING
    done = F.coalesce(open_ & (F.col("outcome") == "done"), F.lit(False))
    late = F.coalesce(open_ & (F.col("outcome") == "deferred"), F.lit(False))
    parked = late & (F.col("retry_count") + 1 >= max_retries)
    closed = done | parked
    return rows.withColumns(
        {
            "status": F.when(done, PROCESSED).when(parked, PARKED).otherwise(F.col("status")),
            "retry_count": F.when(late, F.col("retry_count") + 1).otherwise(F.col("retry_count")).cast("int"),
            "processed_at": F.when(closed, F.lit(now).cast(T.TimestampNTZType())).otherwise(F.col("processed_at")),
            "source_id": F.when(closed, F.lit(source_id)).otherwise(F.col("source_id") if "source_id" in rows.columns else F.lit(None).cast("string")),
            "reason": F.when(late, F.col("reason")),
        }
    ).select(*names, "source_id", "reason")


def purge_log(log: DataFrame, days: int, now: str) -> DataFrame:
    """L2. The log without processed rows older than `days` before `now`. None go for 0 days or fewer, or without a time."""
    if days <= 0:
        return log
    old = (F.col("status") == PROCESSED) & (F.col("processed_at") < F.expr(f"CAST('{now}' AS TIMESTAMP_NTZ) - INTERVAL {int(days)} DAYS"))
    return log.where(~F.coalesce(old, F.lit(False)))


def force_resync(log: DataFrame, missing: DataFrame, table: str | None, key: str, queue_table: str | None = None) -> DataFrame:
    """L3. The log without the rows of `table` (all, if None), and the missing keys queued anew."""
    kept = log.where(F.col("table_name") != table) if table else log.limit(0)
    return queue_changes(kept, missing, queue_table or table, key)
