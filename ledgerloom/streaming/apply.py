"""The continuous job: change-log files in, target versions out, by the batch operators.

A micro-batch fetches the source rows that its log rows name, and rows of earlier batches
whose parents have come since. Of the targets it reads what these rows need: their own
identities and those of their parents. It writes their new state as a delta, and the log
rows that it has read with their outcomes. All versions are named by the batch and read
from those before it, so a batch that runs twice after a failure writes the same again.

    <table>      a target (`sources.layers`)
    deferred     keys that wait or are parked: tries, reason, and the batch that tried them last
    waits        of waiting keys the parents they wait for (table, identity); without a key, what
                 the batch has written, which wakes them
    marks        log rows read, closed ones and those whose key waits, a version a batch; rows without
                 a write may be closed before their key waits, and get its outcome when they are read
    work         tables of the batch under way, removed at its end
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import tokens
from ledgerloom.operators import changelog, fk, keys, lineage, merge, schema
from ledgerloom.sources import layers
from ledgerloom.sources import tables as store
from ledgerloom.sources.folders import make_folder, read_text, remove, stored, write_text

LOG_SCHEMA = "log_id long, table_name string, pk_value string, operation string, created_at timestamp_ntz, status string, processed_at timestamp_ntz, retry_count int"
MARKED_SCHEMA = LOG_SCHEMA + ", source_id string, reason string"
DEFERRED_SCHEMA = "table_name string, pk_value string, status string, retry_count int, reason string, batch long"
WAITS_SCHEMA = "table_name string, pk_value string, parent string, token string"
SNAPSHOTS = {"deferred": DEFERRED_SCHEMA, "waits": WAITS_SCHEMA}
#: Versions kept of everything, and batches between two clean-ups.
KEEP, CLEAN_EVERY = 3, 10
#: Stands for any identity of a parent that can't be told from the foreign key.
ANY = "*"
TRIGGER, LATE, REASON = "_trigger", "_late", "_reason"


class Table(NamedTuple):
    """A table of the stream: where current rows come from, its key, and its foreign keys to other tables of it.

    `key` is a column or the columns of a composite key; the log has the values of `trigger` (the first of
    them, by default), so that a change brings all rows that share it. Without `source_id` rows are upserted
    by the whole key. With one, several sources share the target: rows are stamped, foreign keys remapped, and
    the merge goes by lineage; new rows get keys of the target, unless the key is shared with a parent or
    composite (`preserve_pk`).
    """

    name: str
    source: Callable[[SparkSession], DataFrame]
    key: str | tuple[str, ...]
    links: tuple[fk.Link, ...] = ()
    source_id: str | None = None
    preserve_pk: bool = False
    adopt_legacy: bool = False
    limits: dict[str, int] = {}
    computed: tuple[str, ...] = ()
    trigger: str | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.key,) if isinstance(self.key, str) else tuple(self.key)

    @property
    def trigger_column(self) -> str:
        return self.trigger or self.keys[0]

    def identity(self, kind: T.StructType) -> Column:
        """What a row of the target is filed under: its key, or with lineage its record id. A row without label is
        filed under the token of its own key, which is the record id that may adopt it."""
        if self.source_id is None:
            return tokens.identity_text([F.col(f"`{k}`") for k in self.keys])
        return F.coalesce(F.col("source_record_id"), tokens.record_token(kind, self.keys))


def stream_changes(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """S6. The change log as a stream of files, at most `max_files` in a micro-batch."""
    return spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def retry_state(held: DataFrame, new: DataFrame, waits: DataFrame, arrived: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ST2. (items to try, keys that sleep on) of one table: the new ones and the waiting ones for which news has come, with the tries so far.

    `held` are the waiting keys (`pk_value`, `retry_count`), `new` the changed ones (`pk_value`), `waits` what each
    waits for, `arrived` the (parent, token) pairs written since.
    """
    again = new.select("pk_value").join(held.select("pk_value", "retry_count"), "pk_value", "left").select("pk_value", F.coalesce("retry_count", F.lit(0)).alias("retry_count"))
    others = held.join(new, "pk_value", "left_anti")
    woken = waits.join(arrived, ["parent", "token"], "left_semi").select("pk_value").distinct()
    return again.unionByName(others.join(woken, "pk_value", "left_semi").select("pk_value", "retry_count")), others.join(woken, "pk_value", "left_anti")


def tried(items: DataFrame, max_retries: int) -> DataFrame:
    """ST2. Keys after one more try in vain: parked at `max_retries`."""
    tries = (F.col("retry_count") + 1).cast("int")
    return items.withColumns({"status": F.when(tries >= max_retries, changelog.PARKED).otherwise(changelog.PENDING), "retry_count": tries})


def after_tries(items: DataFrame, late: DataFrame, max_retries: int) -> DataFrame:
    """ST2. Those of `items` that `late` rows came of, one try later. Rows carry the value that the log names (`_trigger`).

    Values are compared in their own type, as the log may write a timestamp in another way than a cast does.
    """
    of = late.groupBy(TRIGGER).agg(F.min(REASON).alias("reason"))
    kept = items.withColumn("_own", F.col("pk_value").try_cast(late.schema[TRIGGER].dataType)).join(of, F.col("_own") == F.col(TRIGGER)).select("pk_value", "retry_count", "reason")
    return tried(kept, max_retries)


def need_of(link: fk.Link, child: Table, parent: Table, rows: DataFrame, parent_kind: T.StructType) -> Column | None:
    """The identity of the parent that a foreign key names; None if it is no identity of that table."""
    if parent.keys != (link.parent_col,) or (child.source_id is None) != (parent.source_id is None):
        return None
    own = F.col(f"`{link.child_col}`")
    if child.source_id is not None:
        return tokens.source_record_token(own, rows.schema[link.child_col].dataType)
    return tokens.identity_text([own.try_cast(parent_kind[link.parent_col].dataType)])


def landing(rows: DataFrame, kind: T.StructType, t: Table) -> tuple[DataFrame, T.StructType]:
    """Rows as the target takes them, with `_reason` where it can't, and its schema with what the source has gained: P4, P2, P3, P6, P8.

    Keys and foreign keys stay as they are: they may lose no digit.
    """
    hidden = tuple(c for c in rows.columns if c.startswith("_"))
    plain = merge.drop_managed(rows, computed=t.computed)
    gained = schema.target_schema(T.StructType([f for f in plain.schema if f.name not in hidden and f.name.lower() not in {x.lower() for x in kind.names}]))
    kind = T.StructType([*kind, *(T.StructField(f.name, f.dataType, True, f.metadata) for f in gained if f.name not in schema.LINEAGE_TYPES)])
    plain = tokens.clip_strings(tokens.normalize(plain, keep=(*hidden, *t.keys, *(x.child_col for x in t.links))), t.limits)
    names = {c.lower(): c for c in plain.columns}
    wanted = T.StructType([f for f in kind if f.name.lower() in names])
    plain = plain.select(*(F.col(f"`{names[f.name.lower()]}`").alias(f.name) for f in wanted), *hidden)
    # A key that the target makes itself may come in any form.
    checked = T.StructType([f for f in wanted if t.source_id is None or t.preserve_pk or f.name not in t.keys])
    marked = plain.withColumn(REASON, schema.rejection(plain, checked))
    return marked.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted), *hidden, REASON), kind


class Applied(NamedTuple):
    #: Rows that must wait: `_trigger`, `_reason`, and the identities `_need_i` of the parents they have.
    late: DataFrame
    #: Identities that were written; None without any.
    written: DataFrame | None


def apply_table(spark: SparkSession, t: Table, by_name: dict[str, Table], items: DataFrame, n: int, root: str, batch: int, done: set[str], work: str) -> Applied:
    """Writes version `batch` of a target by its `n` items. Tables in `done` have that version already; others are read from before it."""
    path = f"{root}/{t.name}"
    m = layers.read_manifest(spark, path, batch)
    source = t.source(spark)
    kinds = {x.parent_table: layers.read_manifest(spark, f"{root}/{x.parent_table}", batch + 1 if x.parent_table in done else batch).schema for x in t.links}
    needs = [need_of(x, t, by_name[x.parent_table], source, kinds[x.parent_table]) for x in t.links]
    current = keys.dedup_by_key(merge.fetch_changed(source, items, t.trigger_column, n), list(t.keys), [*t.keys, *(c for c in source.columns if c not in t.keys)])
    named = {f"_need_{i}": (F.when(F.col(f"`{x.child_col}`").isNotNull(), F.lit(ANY)) if need is None else need) for i, (x, need) in enumerate(zip(t.links, needs))}
    current = stored(current.withColumns({TRIGGER: F.col(f"`{t.trigger_column}`"), **named}), "rows", work)
    parents = {}
    for name in kinds:
        own = [i for i, x in enumerate(t.links) if x.parent_table == name]
        before = batch + 1 if name in done else batch
        if any(needs[i] is None for i in own):
            parents[name] = layers.read(spark, f"{root}/{name}", before)
        else:
            asked = reduce(DataFrame.union, [current.select(F.col(f"_need_{i}").alias(layers.IDENTITY)) for i in own]).where(f"{layers.IDENTITY} IS NOT NULL").distinct()
            parents[name] = layers.lookup(spark, f"{root}/{name}", asked, before)
    if t.source_id is not None:
        marked = fk.with_remapped(lineage.stamp_lineage(current, t.source_id, t.keys), parents, list(t.links), t.source_id, t.adopt_legacy)
    else:
        marked = fk.with_found(current, parents, list(t.links))
    late = reduce(lambda a, b: a | b, [F.col(f"_late_{i}") for i in range(len(t.links))], F.lit(False))
    landed, kind = landing(marked.withColumn(LATE, late).drop(*(f"_late_{i}" for i in range(len(t.links)))), m.schema, t)
    rows = stored(landed.withColumn(REASON, F.when(F.col(LATE), F.lit("parent")).otherwise(F.col(REASON))), "landed", work)
    ready = rows.where(F.col(REASON).isNull()).select(*(c for c in rows.columns if not c.startswith("_")))
    waiting = rows.where(F.col(REASON).isNotNull()).select(TRIGGER, REASON, *named)
    identities = ready.select(F.coalesce(t.identity(ready.schema), F.lit("")).alias(layers.IDENTITY)).distinct()
    touched = layers.wanted(identities, m.buckets)
    if not touched.rows:
        return Applied(waiting, None)
    held = layers.lookup(spark, path, touched, batch)
    part = held.withColumns({f.name: F.lit(None).cast(f.dataType) for f in kind if f.name not in held.columns}) if len(kind) > len(held.columns) else held
    extra = None
    if t.source_id is None:
        merged = merge.merge_upsert(part, ready, list(t.keys))
    else:
        part = lineage.adopt_legacy(part, ready, t.keys, t.source_id) if t.adopt_legacy else part
        merged = merge.merge_by_lineage(part, ready, t.source_id, t.keys[0], identity=t.keys[1:], preserve_pk=t.preserve_pk)
        if not t.preserve_pk:
            merged = stored(merged, "merged", work)
            fresh = F.coalesce((F.col("_action") == "I") & F.col(t.keys[0]).isNull(), F.lit(False))
            new, start = merged.where(fresh), m.extra.get("next_key") or keys.next_key(layers.read(spark, path, batch), t.keys[0]).first()[0]
            numbered = keys.add_dense_id(new.drop(t.keys[0]), ["source_record_id", *(c for c in new.columns if c not in (t.keys[0], "source_record_id"))], t.keys[0], start)
            numbered = numbered.withColumn(t.keys[0], F.col(t.keys[0]).cast(kind[t.keys[0]].dataType))
            extra = {**m.extra, "next_key": start + new.count()}
            merged = merged.where(~fresh).unionByName(numbered)
    layers.write_delta(merged.select(*kind.names), path, batch, t.identity(kind), touched, extra)
    return Applied(waiting, identities)


def apply_batch(spark: SparkSession, log: DataFrame, tables: list[Table], root: str, batch: int, max_retries: int = changelog.MAX_RETRIES, allow: Iterable[str] = (), deny: Iterable[str] = (), source_id: str | None = None, now: str | None = None) -> None:
    """ST1. One micro-batch: the versions before `batch` and the log rows become the versions `batch`.

    `allow` and `deny` are the scope (P1): rows of other tables are closed and lead to no write. Rows of tables
    in scope that the stream does not have stay as they are. `source_id` and `now` (the time in UTC) go into the log.
    """
    work = f"{root}/work/version={batch}"
    now = now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    by_name = {t.name: t for t in tables}
    before = lambda name: store.read_snapshot(spark, f"{root}/{name}", store.current_version(spark, f"{root}/{name}", batch))
    held, waits = (before(name) for name in SNAPSHOTS)
    news = waits.where("pk_value IS NULL").select("parent", "token")
    last = store.current_version(spark, f"{root}/marks", batch)
    opened = spark.createDataFrame([], MARKED_SCHEMA) if last is None else spark.read.schema(MARKED_SCHEMA).parquet(f"{root}/marks/version={last}/closed=false")
    scope = changelog.in_scope(F.col("table_name"), allow, deny)
    fresh = stored(log.where(F.col("status") == changelog.PENDING).withColumns({"_scope": scope, "_ours": scope & F.col("table_name").isin(*by_name)}), "log", work)
    # Rows of one file, bounded by maxFilesPerTrigger.
    changes = stored(changelog.coalesce_changes(fresh.where("_ours"), with_ids=False).where("writes").select("table_name", "pk_value"), "changes", work)
    old = held.where(F.col("status") == changelog.PENDING)
    counts = {(r.table_name, r.kind): r["count"] for r in changes.select("table_name", F.lit("new").alias("kind")).union(old.select("table_name", F.lit("old"))).groupBy("table_name", "kind").count().collect()}  # two rows a table
    waiting, waiting_for, arrived, done = [], [], [news], set()
    for name in fk.table_order(list(by_name), {t.name: list(t.links) for t in tables}):
        t, mine = by_name[name], F.col("table_name") == name
        if (name, "new") not in counts and (name, "old") not in counts:  # tables without work are neither read nor written
            continue
        items = changes.where(mine).select("pk_value", F.lit(0).alias("retry_count"))
        if (name, "old") in counts:
            own_waits = waits.where(mine)
            items, asleep = retry_state(old.where(mine), items, own_waits, reduce(DataFrame.union, arrived))
            items = stored(items, "items", work)
            asleep = stored(tried(asleep, max_retries), "asleep", work)
            waiting.append(asleep.select("table_name", "pk_value", "status", "retry_count", "reason"))
            waiting_for.append(own_waits.join(asleep.where(F.col("status") == changelog.PENDING), "pk_value", "left_semi").select(*waits.columns))
        n = items.count() if (name, "old") in counts else counts[name, "new"]
        if not n:
            continue
        found = apply_table(spark, t, by_name, items, n, root, batch, done, work)
        done.add(name)
        late = stored(after_tries(items, found.late, max_retries).withColumn("table_name", F.lit(name)), "late", work)
        waiting.append(late.select("table_name", "pk_value", "status", "retry_count", "reason"))
        if t.links:
            kind = found.late.schema[TRIGGER].dataType
            pairs = reduce(DataFrame.union, [found.late.where(F.col(REASON) == "parent").select(TRIGGER, F.lit(x.parent_table).alias("parent"), F.col(f"_need_{i}").alias("token")) for i, x in enumerate(t.links)]).where("token IS NOT NULL").distinct()
            waiting_for.append(late.where(F.col("status") == changelog.PENDING).withColumn("_own", F.col("pk_value").try_cast(kind)).join(pairs, F.col("_own") == F.col(TRIGGER)).select(*waits.columns))
        if found.written is not None:
            arrived.append(found.written.select(F.lit(name).alias("parent"), F.col(layers.IDENTITY).alias("token")))
            arrived.append(spark.range(1).select(F.lit(name), F.lit(ANY)))
    # A parked key stays parked until a change of it succeeds.
    parked = held.where(F.col("status") == changelog.PARKED).join(changes, ["table_name", "pk_value"], "left_anti")
    state = reduce(DataFrame.unionByName, [x.withColumn("batch", F.lit(batch).cast("long")) for x in waiting], parked.select(*held.columns))
    state.write.mode("overwrite").parquet(f"{root}/deferred/version={batch}")
    state = spark.read.schema(held.schema).parquet(f"{root}/deferred/version={batch}")
    outcomes = state.where(F.col("batch") == batch).select("table_name", "pk_value", F.lit("deferred").alias("outcome"), "reason", (F.col("status") == changelog.PARKED).alias("_parked"))
    read = opened.unionByName(fresh.where("_ours OR NOT _scope").drop("_scope", "_ours"), allowMissingColumns=True).drop("source_id", "reason")
    # All rows read of a key share its outcome, however often each was tried.
    read = read.join(outcomes, ["table_name", "pk_value"], "left").withColumn("retry_count", F.when(F.col("_parked"), F.greatest("retry_count", F.lit(max_retries - 1))).otherwise(F.when(F.col("outcome").isNotNull(), F.least("retry_count", F.lit(max_retries - 2))).otherwise(F.col("retry_count"))).cast("int"))
    settled = read.select(*(f.name for f in log.schema), F.coalesce("outcome", F.lit("done")).alias("outcome"), "reason")
    marked = changelog.marked(settled, now, source_id, max_retries).select(*opened.columns, (F.col("status") != changelog.PENDING).alias("closed"))
    marked.write.mode("overwrite").partitionBy("closed").parquet(f"{root}/marks/version={batch}")
    for closed in ("true", "false"):  # both are there, if empty
        make_folder(spark, f"{root}/marks/version={batch}/closed={closed}")
    write_text(spark, f"{root}/marks/pointer/version={batch}", now)
    none = F.lit(None).cast("string")
    store.write_snapshot(reduce(DataFrame.union, [*waiting_for, *(x.select(none, none, "*") for x in arrived[1:])], waits.limit(0)), f"{root}/waits", batch)
    store.commit_snapshot(held, f"{root}/deferred", batch)  # the last: with it the batch counts
    if batch % CLEAN_EVERY == CLEAN_EVERY - 1:
        clean(spark, root, tables)
    remove(spark, work)


def start_versions(spark: SparkSession, targets: dict[str, DataFrame], root: str, tables: list[Table], buckets: int = layers.BUCKETS) -> None:
    """Version -1: the targets before the first batch, and nothing deferred. The number of buckets stays with each target."""
    by_name = {t.name: t for t in tables}
    for name, df in targets.items():
        t = by_name[name]
        if t.source_id is not None and len(t.keys) > 1 and not t.preserve_pk:
            raise ValueError(f"{name}: a composite key can't be given out; it must be preserved")
        numbered = t.source_id is not None and not t.preserve_pk
        layers.create(df, f"{root}/{name}", t.identity(df.schema), buckets=buckets, extra={"next_key": keys.next_key(df, t.keys[0]).first()[0]} if numbered else {})
    for name, kind in SNAPSHOTS.items():
        store.write_snapshot(spark.createDataFrame([], kind), f"{root}/{name}", -1)


def clean(spark: SparkSession, root: str, tables: list[Table], keep: int = KEEP) -> None:
    """Removes versions that no batch can need any more; closed log rows stay until they are purged."""
    for t in tables:
        layers.vacuum(spark, f"{root}/{t.name}", keep)
    for name in SNAPSHOTS:
        store.drop_snapshots(spark, f"{root}/{name}", keep)
    for v in store.versions(spark, f"{root}/marks")[:-keep]:
        remove(spark, f"{root}/marks/version={v}/closed=false")


def read_target(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of a target."""
    return layers.read(spark, f"{root}/{name}")


def read_deferred(spark: SparkSession, root: str) -> DataFrame:
    return store.read_snapshot(spark, f"{root}/deferred")


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """L1. The log rows that batches have read and that no purge has taken, with their outcomes; those of waiting keys are pending.

    A row that leads to no write has the outcome of the next rows of its key that do, also if its own batch has
    closed it before these were read: so it does not matter into which batches the log falls.
    """
    last = store.current_version(spark, f"{root}/deferred")
    done = [v for v in store.versions(spark, f"{root}/marks") if v <= last]
    folders = [f"{root}/marks/version={v}/closed=true" for v in done] + [f"{root}/marks/version={last}/closed=false"] * (last in done)
    none = spark.createDataFrame([], MARKED_SCHEMA)
    if not folders:
        return none
    seen = spark.read.schema(MARKED_SCHEMA + ", version long").option("basePath", f"{root}/marks").parquet(*folders).select(*none.columns, "version")
    key, status, writes = ["table_name", "pk_value"], F.col("status"), F.coalesce(F.col("operation").isin(*changelog.WRITES), F.lit(False))
    waiting = read_deferred(spark, root).where(status == changelog.PENDING).select(*key, F.struct("status", "retry_count", "reason", F.lit(None).cast("timestamp_ntz").alias("processed_at"), F.lit(None).cast("string").alias("source_id")).alias("_now"))
    # Closed rows of other keys are as they should be.
    asked = waiting.select(*key).union(seen.where(status == changelog.PARKED).select(*key)).distinct()
    ends = seen.where(writes & (status != changelog.PENDING)).join(asked, key, "left_semi").groupBy(*key, "version").agg(F.max(F.struct("status", "retry_count", "reason", "processed_at", "source_id")).alias("end"))
    fates = asked.join(ends.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("version", "end"))).alias("_ends")), key, "left").join(waiting, key, "left")
    idle = F.coalesce(~writes & (status == changelog.PROCESSED), F.lit(False))
    fate = F.coalesce(F.get(F.filter("_ends", lambda x: x["version"] >= F.col("version")), F.lit(0))["end"], F.col("_now"))
    shared = seen.where(idle).join(fates, key, "left").withColumn("_fate", F.when(fate["status"] != changelog.PROCESSED, fate))
    own = [F.when(F.col("_fate").isNotNull(), F.col(f"_fate.{c}")).otherwise(F.col(c)).alias(c) if c in ("status", "retry_count", "reason", "processed_at", "source_id") else F.col(c) for c in none.columns]
    return seen.where(~idle).select(*none.columns).unionByName(shared.select(*own))


def marked_log(spark: SparkSession, root: str, log: DataFrame) -> DataFrame:
    """L1. A log with the outcomes of the rows that batches have read, told by their ids; what none has read is as it was."""
    seen = read_log(spark, root)
    marks = seen.select("log_id", *(F.col(c).alias(f"_{c}") for c in ("status", "retry_count", "processed_at", "source_id", "reason")))
    both = log.join(marks, "log_id", "left")
    return both.select(*(F.when(F.col("_status").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in ("status", "retry_count", "processed_at") else F.col(c) for c in log.columns), F.col("_source_id").alias("source_id"), F.col("_reason").alias("reason"))


def purge_marks(spark: SparkSession, root: str, days: int, now: str) -> list[int]:
    """L2 for the stream: log rows closed over `days` days before `now` go, batch by batch. No row is read for that; pending ones are elsewhere. Returns the batches."""
    if days <= 0:
        return []
    limit = dt.datetime.fromisoformat(now) - dt.timedelta(days=days)
    # The last version has the rows that are open, and stays.
    old = [v for v in store.versions(spark, f"{root}/marks")[:-1] if dt.datetime.fromisoformat(read_text(spark, f"{root}/marks/pointer/version={v}")) < limit]
    for v in old:
        remove(spark, f"{root}/marks/pointer/version={v}")
        remove(spark, f"{root}/marks/version={v}")
    return old


def run_stream(spark: SparkSession, log_path: str, tables: list[Table], root: str, max_files: int = 1, max_retries: int = changelog.MAX_RETRIES, every: str | None = None, allow: Iterable[str] = (), deny: Iterable[str] = (), source_id: str | None = None, keep_days: int = 0, purge_every: float = 3600) -> int:
    """Runs the stream, until it has read all files, or with `every` (such as `1 second`) until it is stopped.

    Every `purge_every` seconds closed log rows older than `keep_days` are purged (never, for 0). Returns the
    last version, also if no batch was left to run.
    """
    purged = None

    def each(log: DataFrame, batch: int) -> None:
        nonlocal purged
        apply_batch(log.sparkSession, log, tables, root, batch, max_retries, allow, deny, source_id)
        if keep_days and (purged is None or time.monotonic() - purged >= purge_every):
            purge_marks(log.sparkSession, root, keep_days, dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
            purged = time.monotonic()

    writer = stream_changes(spark, log_path, max_files).writeStream.foreachBatch(each).option("checkpointLocation", f"{root}/checkpoint")
    query = (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    query.awaitTermination()
    return store.current_version(spark, f"{root}/deferred")
