"""Every query of the table-sync operators, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import tokens
from ledgerloom.operators import changelog, diff, fk, keys, lineage, merge, schema
from ledgerloom.plans import apply, backfill
from ledgerloom.plans.fixtures import TABLES, fixture, with_fixtures
from ledgerloom.sources import layers, tables
from ledgerloom.sources.folders import new_folder
from ledgerloom.streaming import apply as streaming

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
NOW, DAYS = "2024-01-31 00:00:00", 7


def register(name: str, names: str = "", sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_fixtures(names, sql)
        return f

    return add


def load(spark, sf: str, name: str) -> DataFrame:
    return tables.read_table(spark, sf, name)


# The job as a whole.

CHANGED = "changed AS (SELECT DISTINCT CAST(pk_value AS BIGINT) AS k FROM audit_log WHERE status = 'pending' AND table_name = 'orders' AND operation IN ('I', 'U'))"


@register(
    "flagship_apply_changes",
    "tgt_orders audit_log",
    f""", {CHANGED}
    SELECT o.*, CASE WHEN t.o_orderkey IS NULL THEN 'I' ELSE 'U' END AS action FROM orders o JOIN changed ON o.o_orderkey = k LEFT JOIN tgt_orders t ON t.o_orderkey = o.o_orderkey
    UNION ALL SELECT t.*, '-' FROM tgt_orders t WHERE o_orderkey NOT IN (SELECT k FROM changed JOIN orders ON k = orders.o_orderkey)""",
)
def flagship(spark, sf):
    log = fixture(spark, sf, "audit_log")
    out = apply.apply_changes(log, load(spark, sf, "orders"), fixture(spark, sf, "tgt_orders"), "orders", "o_orderkey", ["o_orderkey"])
    return out.withColumn("action", F.coalesce("_action", F.lit("-"))).drop("_action")


@register("job_sync_missing", "tgt_orders", f"SELECT {ORDER_COLUMNS} FROM tgt_orders UNION ALL SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt_orders)")
def job_sync_missing(spark, sf):
    return apply.sync_missing(load(spark, sf, "orders"), fixture(spark, sf, "tgt_orders"), "o_orderkey")


# Sources and sinks.


@register("s1_read_table", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def s1(spark, sf):
    return tables.read_table(spark, sf, "orders", drop=("O_ORDERPRIORITY",))


@register("s2_change_rows", sql="SELECT 'events' AS table_name, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS pk_value, 'I' AS operation, 'pending' AS status FROM events")
def s2(spark, sf):
    return changelog.change_rows(load(spark, sf, "events"), "events", "ts", "I")


@register("s3_poll_pending", "audit_log", "SELECT log_id, table_name, pk_value, operation FROM audit_log WHERE status = 'pending' ORDER BY log_id LIMIT 500")
def s3(spark, sf):
    return changelog.poll_pending(fixture(spark, sf, "audit_log"), 500).select("log_id", "table_name", "pk_value", "operation")


@register(
    "s4_queue_changes",
    "tgt_orders audit_log",
    """SELECT log_id, table_name, pk_value, operation, status, retry_count FROM audit_log
    UNION ALL SELECT NULL, 'orders', CAST(o_orderkey AS VARCHAR), 'I', 'pending', 0 FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt_orders)""",
)
def s4(spark, sf):
    missing = diff.missing_rows(load(spark, sf, "orders"), fixture(spark, sf, "tgt_orders"), ["o_orderkey"])
    return changelog.queue_changes(fixture(spark, sf, "audit_log"), missing, "orders", "o_orderkey").select("log_id", "table_name", "pk_value", "operation", "status", "retry_count")


@register("s5_write_snapshot", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def s5(spark, sf):
    path = new_folder(spark, "snapshot")
    tables.write_snapshot(load(spark, sf, "orders").limit(0).drop("o_orderpriority"), path, 1)
    tables.write_snapshot(load(spark, sf, "orders").drop("o_orderpriority"), path, 2)
    return tables.read_snapshot(spark, path)


def written_log(spark, sf, files: int, log: str = "audit_log") -> str:
    """The pending log as files split by log id."""
    path = new_folder(spark, "log")
    log = fixture(spark, sf, log).where("status = 'pending'").select("log_id", "table_name", "pk_value", "operation", "created_at", "status", "processed_at", "retry_count")
    log.repartitionByRange(files, "log_id").write.parquet(path)
    return path


@register("s6_stream_changes", "audit_log", "SELECT log_id, table_name, pk_value, operation FROM audit_log WHERE status = 'pending'")
def s6(spark, sf):
    out = new_folder(spark, "stream")
    stream = streaming.stream_changes(spark, written_log(spark, sf, 4), max_files=1).select("log_id", "table_name", "pk_value", "operation")
    stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows")


STREAM_CTES = """, pend AS (SELECT DISTINCT table_name, CAST(pk_value AS BIGINT) AS k FROM audit_log WHERE status = 'pending' AND operation IN ('I', 'U')),
    cust AS (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0 UNION SELECT c_custkey FROM customer JOIN pend ON table_name = 'customer' AND k = c_custkey),
    ready AS (SELECT o.* FROM orders o JOIN pend ON table_name = 'orders' AND k = o_orderkey WHERE o_custkey IN (SELECT c_custkey FROM cust))"""


def run_orders_stream(spark, sf, log: str = "audit_log") -> str:
    root = new_folder(spark, "targets")
    jobs = [streaming.Table("orders", lambda s: load(s, sf, "orders"), "o_orderkey", (fk.Link("o_custkey", "customer", "c_custkey"),)), streaming.Table("customer", lambda s: load(s, sf, "customer"), "c_custkey")]
    streaming.start_versions(spark, {"orders": fixture(spark, sf, "tgt_orders"), "customer": load(spark, sf, "customer").where("c_custkey % 5 <> 0")}, root, jobs)
    streaming.run_stream(spark, written_log(spark, sf, 3, log), jobs, root)
    return root


@register("st1_streaming_apply", "audit_log tgt_orders", STREAM_CTES + f" SELECT {ORDER_COLUMNS} FROM ready UNION ALL SELECT {ORDER_COLUMNS} FROM tgt_orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ready)")
def st1(spark, sf):
    return streaming.read_target(spark, run_orders_stream(spark, sf), "orders")


LATE = "SELECT DISTINCT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS pk_value, 'pending' AS status FROM orders JOIN pend ON table_name = 'orders' AND k = o_orderkey WHERE o_custkey NOT IN (SELECT c_custkey FROM cust)"


@register("st2_deferred_state", "audit_log", STREAM_CTES + " " + LATE)
def st2(spark, sf):
    return streaming.read_deferred(spark, run_orders_stream(spark, sf)).select("table_name", "pk_value", "status")


@register("st1_lineage_apply", "audit_log", STREAM_CTES + " SELECT CAST(o_orderkey AS VARCHAR) AS source_record_id, CAST(o_custkey AS VARCHAR) AS customer_record, o_totalprice, true AS own_key FROM ready")
def st1_lineage(spark, sf):
    """The stream in the mode of several sources: stamped, foreign keys remapped, merged by lineage, keys of the target.

    New keys are to be unique and to follow the largest old one without gaps (`own_key`).
    """
    root = new_folder(spark, "targets")
    customers = fixture(spark, sf, "tgt_customer")
    orders = lineage.stamp_lineage(load(spark, sf, "orders"), "A", "o_orderkey").limit(0)
    jobs = [
        streaming.Table("orders", lambda s: load(s, sf, "orders"), "o_orderkey", (fk.Link("o_custkey", "customer", "c_custkey"),), source_id="A"),
        streaming.Table("customer", lambda s: load(s, sf, "customer"), "c_custkey", source_id="A"),
    ]
    streaming.start_versions(spark, {"orders": orders, "customer": customers}, root, jobs)
    streaming.run_stream(spark, written_log(spark, sf, 3), jobs, root)
    parents = streaming.read_target(spark, root, "customer").select("c_custkey", F.col("source_record_id").alias("customer_record"))
    own = streaming.read_target(spark, root, "orders")
    dense = own.agg((F.countDistinct("o_orderkey") == F.count("*")) & (F.min("o_orderkey") == 1) & (F.max("o_orderkey") == F.count("*"))).first()[0]
    found = own.join(parents, F.col("o_custkey") == F.col("c_custkey"))
    return found.select("source_record_id", "customer_record", "o_totalprice", (F.col("o_orderkey").isNotNull() & F.lit(dense)).alias("own_key"))


@register(
    "st3_marked_log",
    "audit_log audit_seen",
    STREAM_CTES.replace("audit_log", "audit_seen")
    + f""", late AS ({LATE}) SELECT a.log_id, a.table_name, a.pk_value,
    CASE WHEN a.status = 'pending' AND s.log_id IS NOT NULL AND (a.table_name LIKE 'sys%' OR (a.table_name IN ('orders', 'customer') AND late.pk_value IS NULL)) THEN 'processed' ELSE a.status END AS status
    FROM audit_log a LEFT JOIN audit_seen s ON s.log_id = a.log_id LEFT JOIN late ON late.table_name = a.table_name AND late.pk_value = a.pk_value""",
)
def st3(spark, sf):
    """The whole log after a stream that has not read all of it: only what it has read is marked."""
    log = fixture(spark, sf, "audit_log").withColumn("retry_count", F.lit(0))
    return streaming.marked_log(spark, run_orders_stream(spark, sf, "audit_seen"), log).select("log_id", "table_name", "pk_value", "status")


@register(
    "st4_composite_keys",
    "src_lines tgt_lines audit_log",
    """, changed AS (SELECT DISTINCT CAST(pk_value AS BIGINT) AS k FROM audit_log WHERE status = 'pending' AND table_name = 'orders' AND operation IN ('I', 'U')),
    s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_quantity, l_extendedprice) AS n FROM src_lines WHERE l_orderkey IN (SELECT k FROM changed))
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM s WHERE n = 1
    UNION ALL SELECT t.* FROM tgt_lines t LEFT JOIN s ON s.n = 1 AND s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber WHERE s.n IS NULL""",
)
def st4(spark, sf):
    """A table with a composite key: the log names orders, and all lines of an order come with it."""
    root, log = new_folder(spark, "targets"), new_folder(spark, "log")
    fixture(spark, sf, "audit_log").where("table_name = 'orders' AND status = 'pending'").withColumn("table_name", F.lit("lines")).select(*(x.split()[0] for x in streaming.LOG_SCHEMA.split(", "))).repartitionByRange(2, "log_id").write.parquet(log)
    jobs = [streaming.Table("lines", lambda s: fixture(s, sf, "src_lines"), ("l_orderkey", "l_linenumber"))]
    streaming.start_versions(spark, {"lines": fixture(spark, sf, "tgt_lines")}, root, jobs)
    streaming.run_stream(spark, log, jobs, root)
    return streaming.read_target(spark, root, "lines")


@register(
    "st5_adopt_legacy",
    "legacy_customer audit_log",
    """, changed AS (SELECT DISTINCT CAST(pk_value AS BIGINT) AS k FROM audit_log WHERE status = 'pending' AND table_name = 'customer' AND operation IN ('I', 'U')),
    n AS (SELECT c.*, row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) + (SELECT max(c_custkey) FROM legacy_customer) AS new_key FROM customer c JOIN changed ON k = c_custkey WHERE c_custkey NOT IN (SELECT c_custkey FROM legacy_customer))
    SELECT l.c_custkey, c.c_acctbal, CASE WHEN k IS NULL THEN l.sync_source_id ELSE 'A' END AS sync_source_id, CASE WHEN k IS NULL THEN l.source_record_id ELSE CAST(l.c_custkey AS VARCHAR) END AS source_record_id
    FROM legacy_customer l JOIN customer c ON c.c_custkey = l.c_custkey LEFT JOIN changed ON k = l.c_custkey
    UNION ALL SELECT new_key, c_acctbal, 'A', CAST(c_custkey AS VARCHAR) FROM n""",
)
def st5(spark, sf):
    """Changed rows adopt the unlabelled rows of the target that have their keys; others get new keys."""
    root = new_folder(spark, "targets")
    jobs = [streaming.Table("customer", lambda s: load(s, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), "c_custkey", source_id="A", adopt_legacy=True)]
    streaming.start_versions(spark, {"customer": fixture(spark, sf, "legacy_customer")}, root, jobs)
    streaming.run_stream(spark, written_log(spark, sf, 1), jobs, root)
    return streaming.read_target(spark, root, "customer").select("c_custkey", "c_acctbal", "sync_source_id", "source_record_id")


@register(
    "st6_odd_keys",
    "src_codes tgt_codes src_moments tgt_moments",
    """SELECT 'codes' AS table_name, code AS key_text, p_brand AS value FROM src_codes
    UNION ALL SELECT 'codes', code, p_brand FROM tgt_codes WHERE code NOT IN (SELECT code FROM src_codes)
    UNION ALL SELECT 'moments', CAST(epoch_us(moment) AS VARCHAR), event_type FROM src_moments""",
)
def st6(spark, sf):
    """Keys with outer white space, and timestamps that differ in microseconds: each stays its own."""
    root, log = new_folder(spark, "targets"), new_folder(spark, "log")
    codes, moments = fixture(spark, sf, "src_codes"), fixture(spark, sf, "src_moments")
    changes = changelog.change_rows(codes, "codes", "code", "U").union(changelog.change_rows(moments, "moments", "moment", "U"))
    changes.selectExpr("monotonically_increasing_id() AS log_id", "table_name", "pk_value", "operation", "CAST(NULL AS TIMESTAMP_NTZ) AS created_at", "status", "CAST(NULL AS TIMESTAMP_NTZ) AS processed_at", "0 AS retry_count").coalesce(1).write.parquet(log)
    jobs = [streaming.Table("codes", lambda s: codes, "code"), streaming.Table("moments", lambda s: moments, "moment")]
    streaming.start_versions(spark, {"codes": fixture(spark, sf, "tgt_codes"), "moments": fixture(spark, sf, "tgt_moments")}, root, jobs)
    streaming.run_stream(spark, log, jobs, root)
    found = streaming.read_target(spark, root, "codes").select(F.lit("codes").alias("table_name"), F.col("code").alias("key_text"), F.col("p_brand").alias("value"))
    return found.union(streaming.read_target(spark, root, "moments").select(F.lit("moments"), F.unix_micros(F.col("moment").cast("timestamp")).cast("string"), "event_type"))


# Projections and filters.

SCOPED = "table_name NOT LIKE 'sys%' AND table_name NOT LIKE 'MSr%' AND table_name NOT LIKE '%\\_tracking' ESCAPE '\\'"


@register("p1_scope_tables", "audit_log", f"SELECT log_id, table_name FROM audit_log WHERE {SCOPED} AND table_name <> 'part'")
def p1(spark, sf):
    return changelog.scope_tables(fixture(spark, sf, "audit_log"), deny=["part"]).select("log_id", "table_name")


@register(
    "p2_normalize",
    "text_keys",
    """SELECT p_partkey, CASE WHEN regexp_matches(s, '^\\d{4}-\\d{2}-\\d{2}[T ]\\d{2}:\\d{2}:\\d{2}\\.\\d{6}$') THEN substr(s, 1, 23) ELSE s END AS label, p_brand, p_retailprice,
    CASE WHEN stamp > 100000000000 THEN strftime(make_timestamp(stamp * 1000), '%Y-%m-%d %H:%M:%S.%g') ELSE CAST(stamp AS VARCHAR) END AS stamp
    FROM (SELECT *, nullif(regexp_replace(label, '^\\s+|\\s+$', '', 'g'), '') AS s FROM text_keys)""",
)
def p2(spark, sf):
    return tokens.normalize(fixture(spark, sf, "text_keys"), epoch_ms=("stamp",))


@register("p3_clip_strings", sql="SELECT p_partkey, substr(p_name, 1, 6) AS p_name, substr(p_type, 1, 3) AS p_type FROM part")
def p3(spark, sf):
    return tokens.clip_strings(load(spark, sf, "part").select("p_partkey", "p_name", "p_type"), {"p_name": 6, "p_type": 3})


@register("p4_drop_managed", sql="SELECT l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem")
def p4(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_discount")
    return merge.drop_managed(df, computed=("L_TAX",), identity=("l_discount",), default_cols=("l_orderkey",), key="l_orderkey", insert_only=True)


@register("p5_stamp_lineage", sql="SELECT o_orderkey, o_totalprice, 'A' AS sync_source_id, CAST(o_orderkey AS VARCHAR) AS source_record_id FROM orders")
def p5(spark, sf):
    return lineage.stamp_lineage(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "A", "o_orderkey")


@register("p6_align_schema", "source_a", "SELECT *, CAST(NULL AS VARCHAR) AS o_orderstatus, CAST(NULL AS VARCHAR) AS sync_source_id, CAST(NULL AS VARCHAR) AS source_record_id FROM source_a")
def p6(spark, sf):
    return schema.align_schema(fixture(spark, sf, "source_a"), fixture(spark, sf, "source_b"))


@register("p7_target_schema", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS sync_source_id, CAST(NULL AS VARCHAR) AS source_record_id FROM orders")
def p7(spark, sf):
    df = load(spark, sf, "orders")
    return schema.cast_to(df, schema.target_schema(df.schema))


P8_SCHEMA = T.StructType([T.StructField("p_partkey", T.LongType(), False), T.StructField("label", T.TimestampNTZType()), T.StructField("stamp", T.LongType(), False)])


@register(
    "p8_split_rejects",
    "text_keys",
    """SELECT CAST(p_partkey AS VARCHAR) AS pk_value, CASE WHEN label IS NOT NULL AND p_partkey % 9 NOT IN (1, 2) THEN 'label: not timestamp_ntz' WHEN p_partkey % 4 = 3 THEN 'stamp: null' END AS reason
    FROM text_keys WHERE (label IS NOT NULL AND p_partkey % 9 NOT IN (1, 2)) OR p_partkey % 4 = 3
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), '-' FROM text_keys WHERE NOT ((label IS NOT NULL AND p_partkey % 9 NOT IN (1, 2)) OR p_partkey % 4 = 3)""",
)
def p8(spark, sf):
    df = fixture(spark, sf, "text_keys").select("p_partkey", "label", F.when(F.col("p_partkey") % 4 != 3, F.col("stamp")).alias("stamp"))
    ok, rejected = schema.split_rejects(df, P8_SCHEMA, "p_partkey")
    return rejected.unionByName(ok.select(F.col("p_partkey").cast("string").alias("pk_value"), F.lit("-").alias("reason")))


# Joins.


@register("j1_fetch_changed", "audit_log", f", {CHANGED} SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderkey IN (SELECT k FROM changed)")
def j1(spark, sf):
    return merge.fetch_changed(load(spark, sf, "orders"), changelog.work_items(fixture(spark, sf, "audit_log"), allow=["orders"]), "o_orderkey")


@register("j2_missing_rows", "tgt_orders", "SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM tgt_orders t WHERE t.o_orderkey = o.o_orderkey AND t.o_custkey IS NOT DISTINCT FROM o.o_custkey)")
def j2(spark, sf):
    return diff.missing_rows(load(spark, sf, "orders"), fixture(spark, sf, "tgt_orders"), ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey")


@register("j3_missing_by_lineage", "lineage_orders", "SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT source_record_id FROM lineage_orders WHERE sync_source_id = 'A')")
def j3(spark, sf):
    return diff.missing_by_lineage(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), fixture(spark, sf, "lineage_orders"), "o_orderkey", "A")


@register("j4_rows_above_watermark", "tgt_orders_behind", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > (SELECT max(CAST(CAST(source_record_id AS DECIMAL(18, 1)) AS BIGINT)) FROM tgt_orders_behind WHERE sync_source_id = 'A')")
def j4(spark, sf):
    return diff.rows_above_watermark(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), fixture(spark, sf, "tgt_orders_behind"), "o_orderkey", "A")


@register(
    "j5_remap_fks",
    "orders_null_fk tgt_customer",
    """SELECT o.o_orderkey, CASE WHEN o.o_custkey IS NULL THEN NULL WHEN t.c_custkey IS NOT NULL THEN t.c_custkey ELSE o.o_custkey END AS o_custkey, o.o_custkey IS NOT NULL AND t.c_custkey IS NULL AS deferred
    FROM orders_null_fk o LEFT JOIN tgt_customer t ON t.sync_source_id = 'A' AND t.source_record_id = CAST(o.o_custkey AS VARCHAR)""",
)
def j5(spark, sf):
    ready, late = fk.remap_fks(fixture(spark, sf, "orders_null_fk"), {"customer": fixture(spark, sf, "tgt_customer")}, [fk.Link("o_custkey", "customer", "c_custkey")], "A")
    both = ready.withColumn("deferred", F.lit(False)).unionByName(late.withColumn("deferred", F.lit(True)))
    return both.select("o_orderkey", "o_custkey", "deferred")


@register(
    "j12_legacy_parents",
    "orders_null_fk legacy_customer",
    "SELECT o_orderkey, o_custkey, o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM legacy_customer) AS deferred FROM orders_null_fk",
)
def j12_parents(spark, sf):
    """Unlabelled parents stand for their own keys; every parent is given twice, which must not multiply its children."""
    parents = fixture(spark, sf, "legacy_customer")
    ready, late = fk.remap_fks(fixture(spark, sf, "orders_null_fk"), {"customer": parents.union(parents)}, [fk.Link("o_custkey", "customer", "c_custkey")], "A", adopt_legacy=True)
    return ready.withColumn("deferred", F.lit(False)).unionByName(late.withColumn("deferred", F.lit(True))).select("o_orderkey", "o_custkey", "deferred")


@register("j6_split_by_parent", "orders_null_fk legacy_customer", "SELECT o_orderkey, o_custkey, o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM legacy_customer) AS deferred FROM orders_null_fk")
def j6(spark, sf):
    ready, late = fk.split_by_parent(fixture(spark, sf, "orders_null_fk"), {"customer": fixture(spark, sf, "legacy_customer")}, [fk.Link("o_custkey", "customer", "c_custkey")])
    return ready.withColumn("deferred", F.lit(False)).unionByName(late.withColumn("deferred", F.lit(True))).select("o_orderkey", "o_custkey", "deferred")


@register(
    "j7_merge_upsert",
    "tgt_orders",
    """SELECT coalesce(o.o_orderkey, t.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NOT NULL THEN CASE WHEN o.o_orderkey % 8 <> 0 THEN o.o_custkey END ELSE t.o_custkey END AS o_custkey, t.o_orderstatus,
    CASE WHEN o.o_orderkey IS NOT NULL THEN o.o_totalprice ELSE t.o_totalprice END AS o_totalprice, t.o_orderdate, t.o_orderpriority,
    CASE WHEN o.o_orderkey IS NULL THEN NULL WHEN t.o_orderkey IS NULL THEN 'I' ELSE 'U' END AS action
    FROM orders o FULL OUTER JOIN tgt_orders t ON o.o_orderkey = t.o_orderkey""",
)
def j7(spark, sf):
    changes = load(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 8 != 0, F.col("o_custkey")).alias("o_custkey"), "o_totalprice")
    return merge.merge_upsert(fixture(spark, sf, "tgt_orders"), changes, ["o_orderkey"]).withColumnRenamed("_action", "action")


@register(
    "j8_merge_by_lineage",
    "lineage_orders source_a",
    """, c AS (SELECT *, CASE WHEN o_orderkey % 12 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS rid FROM source_a)
    SELECT t.o_orderkey, coalesce(c.o_custkey, t.o_custkey) AS o_custkey, coalesce(c.o_totalprice, t.o_totalprice) AS o_totalprice, t.sync_source_id, t.source_record_id, CASE WHEN c.rid IS NOT NULL THEN 'U' END AS action
    FROM lineage_orders t LEFT JOIN c ON t.sync_source_id = 'A' AND t.source_record_id = c.rid
    UNION ALL SELECT NULL, o_custkey, o_totalprice, 'A', rid, 'I' FROM c WHERE rid IS NULL OR rid NOT IN (SELECT source_record_id FROM lineage_orders WHERE sync_source_id = 'A')""",
)
def j8(spark, sf):
    changes = lineage.stamp_lineage(fixture(spark, sf, "source_a"), "A", "o_orderkey").withColumn("source_record_id", F.when(F.col("o_orderkey") % 12 != 0, F.col("source_record_id")))
    merged = merge.merge_by_lineage(fixture(spark, sf, "lineage_orders"), changes, "A", "o_orderkey")
    return merged.select("o_orderkey", "o_custkey", "o_totalprice", "sync_source_id", "source_record_id", F.col("_action").alias("action"))


@register(
    "j9_upsert_by_source",
    "lineage_orders source_b",
    """SELECT coalesce(t.o_custkey, b.o_custkey) AS o_custkey, coalesce(b.o_totalprice, t.o_totalprice) AS o_totalprice, coalesce(t.sync_source_id, b.sid) AS sync_source_id, coalesce(t.source_record_id, b.rid) AS source_record_id,
    CASE WHEN b.rid IS NULL THEN NULL WHEN t.source_record_id IS NULL THEN 'I' ELSE 'U' END AS action
    FROM lineage_orders t FULL OUTER JOIN (SELECT *, 'B' AS sid, CAST(o_orderkey AS VARCHAR) AS rid FROM source_b) b ON t.sync_source_id = b.sid AND t.source_record_id = b.rid""",
)
def j9(spark, sf):
    changes = lineage.stamp_lineage(fixture(spark, sf, "source_b"), "B", "o_orderkey").select("sync_source_id", "source_record_id", "o_custkey", "o_totalprice")
    merged = merge.merge_upsert(fixture(spark, sf, "lineage_orders"), changes, ["sync_source_id", "source_record_id"])
    return merged.select("o_custkey", "o_totalprice", "sync_source_id", "source_record_id", F.col("_action").alias("action"))


@register("j10_insert_absent", "tgt_orders", f"SELECT {ORDER_COLUMNS} FROM tgt_orders UNION ALL SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt_orders)")
def j10(spark, sf):
    once = merge.insert_absent(fixture(spark, sf, "tgt_orders"), load(spark, sf, "orders"), ["o_orderkey"])
    return merge.insert_absent(once, load(spark, sf, "orders"), ["o_orderkey"])


@register(
    "j11_shared_key_child",
    "tgt_customer tgt_shared",
    """SELECT t.c_custkey AS c_custkey, c.c_acctbal AS balance, 'A' AS sync_source_id, CAST(c.c_custkey AS VARCHAR) AS source_record_id, CASE WHEN s.c_custkey IS NULL THEN 'I' ELSE 'U' END AS action
    FROM customer c JOIN tgt_customer t ON t.source_record_id = CAST(c.c_custkey AS VARCHAR) LEFT JOIN tgt_shared s ON s.source_record_id = t.source_record_id""",
)
def j11(spark, sf):
    parents = fixture(spark, sf, "tgt_customer")
    child = lineage.stamp_lineage(load(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance")), "A", "c_custkey")
    ready, _ = fk.remap_fks(child, {"customer": parents}, [fk.Link("c_custkey", "customer", "c_custkey")], "A")
    return merge.merge_by_lineage(fixture(spark, sf, "tgt_shared"), ready, "A", "c_custkey", preserve_pk=True).withColumnRenamed("_action", "action")


@register(
    "j12_adopt_legacy",
    "legacy_customer",
    """SELECT c_custkey, c_name, CASE WHEN sync_source_id IS NULL THEN 'A' ELSE sync_source_id END AS sync_source_id,
    CASE WHEN sync_source_id IS NULL THEN CAST(c_custkey AS VARCHAR) ELSE source_record_id END AS source_record_id FROM legacy_customer""",
)
def j12(spark, sf):
    changes = lineage.stamp_lineage(load(spark, sf, "customer"), "A", "c_custkey")
    return lineage.adopt_legacy(fixture(spark, sf, "legacy_customer"), changes, "c_custkey", "A", ["c_name"]).select("c_custkey", "c_name", "sync_source_id", "source_record_id")


@register(
    "j13_schema_conflicts",
    "columns source_keys",
    """, p AS (SELECT a.table_name, a.source_id AS sa, b.source_id AS sb FROM (SELECT DISTINCT table_name, source_id FROM columns) a JOIN (SELECT DISTINCT table_name, source_id FROM columns) b ON a.table_name = b.table_name AND a.source_id < b.source_id),
    l AS (SELECT p.*, column_name, data_type, length FROM p JOIN columns c ON c.table_name = p.table_name AND c.source_id = sa), r AS (SELECT p.*, column_name, data_type, length FROM p JOIN columns c ON c.table_name = p.table_name AND c.source_id = sb),
    f AS (SELECT coalesce(l.table_name, r.table_name) AS table_name, coalesce(l.sa, r.sa) AS sa, coalesce(l.sb, r.sb) AS sb, coalesce(l.column_name, r.column_name) AS column_name, l.data_type AS ta, r.data_type AS tb, l.length AS la, r.length AS lb
          FROM l FULL OUTER JOIN r ON l.table_name = r.table_name AND l.sa = r.sa AND l.sb = r.sb AND l.column_name = r.column_name),
    k AS (SELECT table_name, source_id, string_agg(column_name, '|' ORDER BY ordinal, column_name) AS key FROM source_keys GROUP BY ALL)
    SELECT table_name, CASE WHEN ta IS NULL THEN sb ELSE sa END AS first_source, CASE WHEN ta IS NULL THEN sa ELSE sb END AS second_source, column_name,
           CASE WHEN ta IS NULL OR tb IS NULL THEN 'MISSING' WHEN ta <> tb THEN 'TYPE' ELSE 'LENGTH' END AS kind, CASE WHEN ta IS NULL OR tb IS NULL THEN 'WARNING' WHEN ta <> tb THEN 'CRITICAL' ELSE 'INFO' END AS severity
    FROM f WHERE ta IS NULL OR tb IS NULL OR ta <> tb OR (la > 0 AND lb > 0 AND la <> lb)
    UNION ALL SELECT p.table_name, sa, sb, NULL, 'KEY', 'CRITICAL' FROM p LEFT JOIN k x ON x.table_name = p.table_name AND x.source_id = sa LEFT JOIN k y ON y.table_name = p.table_name AND y.source_id = sb WHERE coalesce(x.key, '') <> coalesce(y.key, '')""",
)
def j13(spark, sf):
    return schema.schema_conflicts(fixture(spark, sf, "columns"), fixture(spark, sf, "source_keys"))


@register(
    "j14_column_set_check",
    "columns",
    """, s AS (SELECT DISTINCT table_name, lower(column_name) AS c FROM columns WHERE source_id = 'src_A'), t AS (SELECT DISTINCT table_name, lower(column_name) AS c FROM columns WHERE source_id = 'src_N'),
    n AS (SELECT table_name, list_sort(list(c)) AS s FROM s GROUP BY table_name), m AS (SELECT table_name, list_sort(list(c)) AS t FROM t GROUP BY table_name),
    b AS (SELECT n.table_name, n.s, m.t, list_sort(list_filter(n.s, lambda x: NOT list_contains(coalesce(m.t, []), x))) AS missing, list_sort(list_filter(coalesce(m.t, []), lambda x: NOT list_contains(n.s, x))) AS extra FROM n LEFT JOIN m USING (table_name))
    SELECT table_name, CASE WHEN t IS NULL THEN 'ABSENT' WHEN len(s) <> len(t) THEN 'COUNT' WHEN len(missing) > 0 THEN 'MISSING' WHEN len(extra) > 0 THEN 'EXTRA' ELSE 'OK' END AS verdict,
           array_to_string(missing, ',') AS missing, array_to_string(extra, ',') AS extra FROM b""",
)
def j14(spark, sf):
    columns = fixture(spark, sf, "columns")
    return schema.column_set_check(columns.where("source_id = 'src_A'"), columns.where("source_id = 'src_N'"))


@register(
    "j15_reconcile_counts",
    "line_counts line_counts_target",
    """SELECT s.table_name, s.n_rows AS source_rows, t.n_rows AS target_rows, s.n_rows - coalesce(t.n_rows, 0) AS difference, coalesce(t.n_rows, 0) < s.n_rows AS target_has_fewer, t.n_rows IS NULL AS absent_on_target
    FROM line_counts s LEFT JOIN line_counts_target t ON s.table_name = t.table_name""",
)
def j15(spark, sf):
    return diff.reconcile_counts(fixture(spark, sf, "line_counts"), fixture(spark, sf, "line_counts_target"))


# Aggregates.


@register(
    "a1_coalesce_changes",
    "audit_log",
    """SELECT table_name, pk_value, array_to_string(list_sort(list(DISTINCT operation)), ',') AS operations, max(log_id) AS last_log_id, count(*) AS n_changes, string_agg(CAST(log_id AS VARCHAR), ',' ORDER BY log_id) AS log_ids,
    bool_or(operation IN ('I', 'U')) AS writes FROM audit_log WHERE status = 'pending' GROUP BY table_name, pk_value""",
)
def a1(spark, sf):
    found = changelog.coalesce_changes(fixture(spark, sf, "audit_log").where("status = 'pending'"))
    return found.withColumns({"operations": F.array_join("operations", ","), "log_ids": F.array_join("log_ids", ",")})


@register("a2_status_counts", "audit_log", "SELECT status, count(*) AS n_rows FROM audit_log GROUP BY status")
def a2(spark, sf):
    return changelog.status_counts(fixture(spark, sf, "audit_log"))


@register("a3_pending_by_table", "audit_log", "SELECT table_name, count(*) AS n_pending FROM audit_log WHERE status = 'pending' GROUP BY table_name")
def a3(spark, sf):
    return changelog.pending_by_table(fixture(spark, sf, "audit_log"))


@register("a4_table_counts", sql=" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def a4(spark, sf):
    return diff.table_counts({t: load(spark, sf, t) for t in TABLES} | {"sysdiagrams": load(spark, sf, "region")})


@register(
    "a5_sync_status",
    "line_counts line_counts_target",
    """SELECT s.table_name, s.n_rows AS source_rows, coalesce(t.n_rows, 0) AS target_rows, CASE WHEN s.n_rows = coalesce(t.n_rows, 0) THEN 'SYNCED' ELSE 'NEEDS SYNC' END AS status, s.n_rows > coalesce(t.n_rows, 0) AS needs_initial_sync
    FROM line_counts s LEFT JOIN line_counts_target t ON s.table_name = t.table_name""",
)
def a5(spark, sf):
    return diff.sync_status(fixture(spark, sf, "line_counts"), fixture(spark, sf, "line_counts_target"))


WEAK_KEYS = {"l_orderkey": "l_orderkey", "pair": "l_orderkey * 100 + l_linenumber", "with_null": "nullif(l_linenumber, 3)"}


@register(
    "a6_key_quality",
    sql=" UNION ALL ".join(f"SELECT '{n}' AS key_name, count(*) AS n_rows, count(DISTINCT {e}) AS n_distinct, count(*) - count({e}) AS n_null, 'RISK' AS verdict FROM lineitem" for n, e in WEAK_KEYS.items())
    + " UNION ALL SELECT 'o_orderkey', count(*), count(DISTINCT o_orderkey), 0, 'OK' FROM orders UNION ALL SELECT 'empty', 0, 0, NULL, 'RISK'",
)
def a6(spark, sf):
    lines = load(spark, sf, "lineitem")
    found = [keys.key_quality(lines.select(F.expr(e).alias("k")), "k").withColumn("key_name", F.lit(n)) for n, e in WEAK_KEYS.items()]
    found += [keys.key_quality(load(spark, sf, "orders"), "o_orderkey").withColumn("key_name", F.lit("o_orderkey")), keys.key_quality(load(spark, sf, "orders").where("o_orderkey < 0"), "o_orderkey").withColumn("key_name", F.lit("empty"))]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


@register("a7_duplicate_keys", sql="SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def a7(spark, sf):
    return keys.duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("a8_next_key", "tgt_orders", "SELECT max(o_orderkey) + 1 AS next_key FROM tgt_orders")
def a8(spark, sf):
    return keys.next_key(fixture(spark, sf, "tgt_orders"), "o_orderkey")


@register(
    "a9_lineage_duplicates",
    "source_a source_b",
    """SELECT 'A' AS sync_source_id, CAST(o_orderkey AS VARCHAR) AS source_record_id, count(*) AS n_rows FROM (SELECT o_orderkey FROM source_a UNION ALL SELECT o_orderkey FROM source_b) GROUP BY o_orderkey HAVING count(*) > 1""",
)
def a9(spark, sf):
    return lineage.lineage_duplicates(lineage.consolidate({"A": (fixture(spark, sf, "source_a"), "o_orderkey")}).unionByName(lineage.stamp_lineage(fixture(spark, sf, "source_b"), "A", "o_orderkey"), allowMissingColumns=True))


@register("a10_identity_conflicts", "claims", "SELECT source_id, count(DISTINCT coalesce(source_host, '') || '|' || coalesce(source_db, '')) AS n_claims FROM claims GROUP BY source_id HAVING count(DISTINCT coalesce(source_host, '') || '|' || coalesce(source_db, '')) > 1")
def a10(spark, sf):
    return lineage.identity_conflicts(fixture(spark, sf, "claims"))


@register(
    "a11_label_coverage",
    "legacy_customer lineage_orders",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) FILTER (sync_source_id IS NOT NULL AND source_record_id IS NOT NULL) AS n_labelled, count(*) FILTER (sync_source_id IS NULL OR source_record_id IS NULL) AS n_unlabelled FROM {t}" for t in ("legacy_customer", "lineage_orders")),
)
def a11(spark, sf):
    return lineage.label_coverage({t: fixture(spark, sf, t) for t in ("legacy_customer", "lineage_orders")})


@register(
    "a12_captured_tables",
    sql="""WITH r AS (SELECT 'tbl_' || CAST(user_id AS VARCHAR) AS table_name, event_type FROM events), f AS (SELECT table_name FROM r GROUP BY table_name HAVING count(DISTINCT event_type) >= 4)
    SELECT 'tbl_' || CAST(c_custkey AS VARCHAR) AS table_name, 'tbl_' || CAST(c_custkey AS VARCHAR) IN (SELECT table_name FROM f) AS captured FROM customer""",
)
def a12(spark, sf):
    rules = load(spark, sf, "events").selectExpr("concat('tbl_', user_id) AS table_name", "event_type AS rule_name")
    return schema.captured_tables(rules, load(spark, sf, "customer").selectExpr("concat('tbl_', c_custkey) AS table_name"), 4)


@register("a13_scope_list", "line_counts", "SELECT string_agg(table_name, ', ' ORDER BY table_name) AS names, string_agg(table_name || '=' || CAST(n_rows AS VARCHAR), ', ' ORDER BY table_name || '=' || CAST(n_rows AS VARCHAR)) AS names_with_counts FROM line_counts")
def a13(spark, sf):
    return schema.scope_list(fixture(spark, sf, "line_counts"))


# Windows, keys, ids.


@register(
    "w1_resolve_sync_keys",
    "catalog index_cols",
    """, i AS (SELECT table_name, CASE WHEN bool_or(is_primary) THEN 1 ELSE 2 END AS priority, index_name AS tie, string_agg(column_name, ',' ORDER BY key_ordinal, column_name) AS key_columns
          FROM index_cols WHERE key_ordinal > 0 AND NOT has_filter AND (is_primary OR is_unique) GROUP BY table_name, index_name, is_primary),
    c AS (SELECT table_name, CASE WHEN lower(column_name) IN ('id', 'idx') THEN 3 ELSE 4 END AS priority, '' AS tie, column_name AS key_columns, row_number() OVER (PARTITION BY table_name ORDER BY CASE WHEN lower(column_name) IN ('id', 'idx') THEN 3 ELSE 4 END, ordinal, column_name) AS n FROM catalog),
    a AS (SELECT * FROM i UNION ALL SELECT table_name, priority, tie, key_columns FROM c WHERE n = 1 UNION ALL SELECT DISTINCT table_name, 0, '', 'col_2' FROM catalog WHERE table_name = 'tbl_7'),
    b AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY priority, tie) AS n FROM a)
    SELECT b.table_name, split_part(key_columns, ',', 1) AS sync_key, key_columns, priority, CASE WHEN is_identity THEN 'identity' WHEN default_def IS NOT NULL THEN 'default' WHEN is_nullable THEN 'nullable' ELSE 'manual' END AS verdict
    FROM b LEFT JOIN catalog k ON k.table_name = b.table_name AND k.column_name = split_part(key_columns, ',', 1) WHERE n = 1 AND b.table_name IN (SELECT table_name FROM catalog)""",
)
def w1(spark, sf):
    found = keys.resolve_sync_keys(fixture(spark, sf, "catalog"), fixture(spark, sf, "index_cols"), {"tbl_7": "col_2"})
    return found.withColumn("key_columns", F.array_join("key_columns", ","))


@register("w2_dedup_by_key", sql="SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS n FROM lineitem) WHERE n = 1")
def w2(spark, sf):
    return keys.dedup_by_key(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@register("w3_add_surrogate_key", sql=f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) AS sync_row_id FROM lineitem")
def w3(spark, sf):
    return keys.add_surrogate_key(load(spark, sf, "lineitem"), LINE_ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "sync_row_id")


@register("w4_allocate_keys", "tgt_orders", "SELECT o_custkey, o_totalprice, o_orderdate, (SELECT max(o_orderkey) FROM tgt_orders) + row_number() OVER (ORDER BY o_custkey, o_orderdate, o_totalprice) AS o_orderkey FROM orders")
def w4(spark, sf):
    new = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return keys.allocate_keys(new, fixture(spark, sf, "tgt_orders"), "o_orderkey", ["o_custkey", "o_orderdate", "o_totalprice"])


@register(
    "w5_keyset_batches",
    sql="""WITH r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 2000 AS batch FROM orders), b AS (SELECT batch, max(o_orderkey) AS high, count(*) AS n_rows FROM r GROUP BY batch)
    SELECT batch, lag(high) OVER (ORDER BY batch) AS low, high, n_rows FROM b""",
)
def w5(spark, sf):
    return keys.keyset_batches(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 2000)


# Log state and labels.

OUTCOMES = "SELECT DISTINCT table_name, pk_value, CASE WHEN CAST(pk_value AS BIGINT) % 3 = 0 THEN 'deferred' ELSE 'done' END AS outcome, CASE WHEN CAST(pk_value AS BIGINT) % 3 = 0 THEN 'parent' END AS reason FROM audit_log WHERE table_name IN ('orders', 'customer')"


@register(
    "l1_apply_outcomes",
    "audit_log",
    f""", oc AS ({OUTCOMES}), j AS (SELECT l.*, outcome, reason AS why, l.status = 'pending' AND (coalesce(outcome = 'done', false) OR l.table_name LIKE 'sys%') AS done, l.status = 'pending' AND coalesce(outcome = 'deferred', false) AS late FROM audit_log l LEFT JOIN oc USING (table_name, pk_value))
    SELECT log_id, table_name, pk_value, CASE WHEN done THEN 'processed' WHEN late AND retry_count + 1 >= 10 THEN 'deferred_max' ELSE status END AS status, CASE WHEN late THEN retry_count + 1 ELSE retry_count END AS retry_count,
    CASE WHEN done OR (late AND retry_count + 1 >= 10) THEN TIMESTAMP '{NOW}' ELSE processed_at END AS processed_at, CASE WHEN done OR (late AND retry_count + 1 >= 10) THEN 'A' END AS source_id, CASE WHEN late THEN why END AS reason FROM j""",
)
def l1(spark, sf):
    log = fixture(spark, sf, "audit_log")
    outcomes = spark.sql(OUTCOMES.replace("FROM audit_log", "FROM {log}"), log=log)
    return changelog.apply_outcomes(log, outcomes, NOW, "A").select("log_id", "table_name", "pk_value", "status", "retry_count", "processed_at", "source_id", "reason")


@register("l2_purge_log", "audit_log", f"SELECT log_id, status, processed_at FROM audit_log WHERE NOT (status = 'processed' AND processed_at < TIMESTAMP '{NOW}' - INTERVAL {DAYS} DAY)")
def l2(spark, sf):
    return changelog.purge_log(fixture(spark, sf, "audit_log"), DAYS, NOW).select("log_id", "status", "processed_at")


@register(
    "l3_force_resync",
    "audit_log tgt_orders",
    """SELECT log_id, table_name, pk_value, operation, status FROM audit_log WHERE table_name <> 'orders'
    UNION ALL SELECT NULL, 'orders', CAST(o_orderkey AS VARCHAR), 'I', 'pending' FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt_orders)""",
)
def l3(spark, sf):
    missing = diff.missing_rows(load(spark, sf, "orders"), fixture(spark, sf, "tgt_orders"), ["o_orderkey"])
    return changelog.force_resync(fixture(spark, sf, "audit_log"), missing, "orders", "o_orderkey").select("log_id", "table_name", "pk_value", "operation", "status")


@register(
    "l4_label_legacy",
    "legacy_customer",
    """SELECT c_custkey, CASE WHEN sync_source_id IS NULL AND c_custkey > 300 THEN 'L' ELSE sync_source_id END AS sync_source_id, CASE WHEN sync_source_id IS NULL AND c_custkey > 300 THEN CAST(c_custkey AS VARCHAR) ELSE source_record_id END AS source_record_id,
    sync_source_id IS NULL AND c_custkey > 300 AS labelled FROM legacy_customer""",
)
def l4(spark, sf):
    return lineage.label_legacy(fixture(spark, sf, "legacy_customer"), "c_custkey", "L", last_key=300).select("c_custkey", "sync_source_id", "source_record_id", F.col("_labelled").alias("labelled"))


@register(
    "l5_backfill_progress",
    "legacy_customer text_keys",
    """SELECT 'customer' AS table_name, 'c_custkey' AS key_col, max(c_custkey) AS last_key, count(*) FILTER (sync_source_id IS NULL) AS rows_labelled, 'DONE' AS status FROM legacy_customer
    UNION ALL SELECT 'part', 'label', NULL, count(*) FILTER (trim(label, ' ') <> ''), 'ERROR' FROM text_keys""",
)
def l5(spark, sf):
    texts = fixture(spark, sf, "text_keys").select("label", F.lit(None).cast("string").alias("sync_source_id"), F.lit(None).cast("string").alias("source_record_id"))
    labelled = {"customer": (lineage.label_legacy(fixture(spark, sf, "legacy_customer"), "c_custkey", "L"), "c_custkey"), "part": (lineage.label_legacy(texts, "label", "L"), "label")}
    return lineage.backfill_progress(labelled, {"part": "ERROR"})


@register(
    "l6_backfill_plan",
    "index_cols catalog",
    """, i AS (SELECT table_name, string_agg(column_name, ',' ORDER BY key_ordinal, column_name) AS kc, row_number() OVER (PARTITION BY table_name ORDER BY CASE WHEN bool_or(is_primary) THEN 1 ELSE 2 END, index_name) AS n, count(*) AS parts
          FROM index_cols WHERE key_ordinal > 0 AND NOT has_filter AND (is_primary OR is_unique) GROUP BY table_name, index_name, is_primary),
    t AS (SELECT 'tbl_' || CAST(l_partkey AS VARCHAR) AS table_name, count(*) AS n_rows FROM lineitem GROUP BY l_partkey),
    c AS (SELECT t.table_name, coalesce(parts, 0) AS parts, kc, data_type, t.n_rows FROM t LEFT JOIN i ON i.table_name = t.table_name AND i.n = 1 LEFT JOIN catalog k ON k.table_name = t.table_name AND k.column_name = split_part(kc, ',', 1))
    SELECT table_name, CASE WHEN parts = 1 THEN kc END AS key_col, CASE WHEN parts <> 1 THEN 'SKIP' WHEN data_type IN ('bigint', 'int') THEN 'OK' WHEN data_type = 'nvarchar' THEN 'OK-TEXT' ELSE 'SKIP' END AS plan,
    CASE WHEN parts = 0 THEN 'no key' WHEN parts > 1 THEN 'composite key' WHEN coalesce(data_type, '') NOT IN ('bigint', 'int', 'nvarchar') THEN 'key type ' || coalesce(data_type, 'unknown') END AS reason, n_rows FROM c""",
)
def l6(spark, sf):
    columns = fixture(spark, sf, "catalog")
    found = keys.resolve_sync_keys(columns, fixture(spark, sf, "index_cols")).where("priority <= 2").select("table_name", "key_columns", "sync_key")
    counts = load(spark, sf, "lineitem").groupBy(F.concat(F.lit("tbl_"), "l_partkey").alias("table_name")).agg(F.count("*").alias("n_rows"))
    kinds = columns.select("table_name", F.col("column_name").alias("sync_key"), "data_type")
    candidates = columns.select("table_name").distinct().join(found, "table_name", "left").join(kinds, ["table_name", "sync_key"], "left")
    return lineage.backfill_plan(candidates.select("table_name", "key_columns", "data_type"), counts)


@register(
    "u1_consolidate",
    "source_a source_b",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, 'A' AS sync_source_id, CAST(o_orderkey AS VARCHAR) AS source_record_id, NULL AS o_orderstatus FROM source_a
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, NULL, 'B', CAST(o_orderkey AS VARCHAR), o_orderstatus FROM source_b""",
)
def u1(spark, sf):
    return lineage.consolidate({"A": (fixture(spark, sf, "source_a"), "o_orderkey"), "B": (fixture(spark, sf, "source_b"), "o_orderkey")})


@register(
    "l7_backfill_job",
    "legacy_customer",
    "SELECT c_custkey, c_acctbal, coalesce(sync_source_id, 'L') AS sync_source_id, coalesce(source_record_id, CAST(c_custkey AS VARCHAR)) AS source_record_id FROM legacy_customer",
)
def l7(spark, sf):
    """A back-fill in ranges that ends early and is started again."""
    path = new_folder(spark, "backfill")
    table = streaming.Table("customer", lambda s: load(s, sf, "customer"), "c_custkey", source_id="L")
    df = fixture(spark, sf, "legacy_customer")
    layers.create(df, path, table.identity(df.schema))
    rows = max(1, df.count() // 10)
    backfill.run_backfill(spark, path, "c_custkey", "L", table.identity, rows, most_ranges=1)
    backfill.run_backfill(spark, path, "c_custkey", "L", table.identity, rows)
    return layers.read(spark, path).select("c_custkey", "c_acctbal", "sync_source_id", "source_record_id")


# Scalar functions, each over a column of every type it treats in its own way.


@register(
    "f1_source_record_token",
    "text_keys",
    """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS whole, regexp_replace(label, '^\\s+|\\s+$', '', 'g') AS text, CAST(p_retailprice AS VARCHAR) AS number, regexp_replace(label, '^\\s+|\\s+$', '', 'g') AS bytes FROM text_keys""",
)
def f1(spark, sf):
    df = fixture(spark, sf, "text_keys").withColumns({"price": F.col("p_retailprice").cast("decimal(18,4)"), "raw": F.encode("label", "UTF-8")})
    token = lambda c: tokens.source_record_token(F.col(c), df.schema[c].dataType)
    return df.select("p_partkey", token("p_partkey").alias("whole"), token("label").alias("text"), token("price").alias("number"), token("raw").alias("bytes"))


@register(
    "f2_key_token",
    "text_keys",
    """SELECT p_partkey, CASE WHEN p_partkey % 9 = 1 THEN replace(substr(label, 1, 21), 'T', ' ') ELSE regexp_replace(label, '^\\s+|\\s+$', '', 'g') END AS token FROM text_keys""",
)
def f2(spark, sf):
    df = fixture(spark, sf, "text_keys")
    return df.select("p_partkey", tokens.key_token(F.col("label"), df.schema["label"].dataType).alias("token"))


@register("f3_audit_token", sql="SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS of_time, CAST(user_id AS VARCHAR) AS of_number, event_type AS of_text FROM events")
def f3(spark, sf):
    df = load(spark, sf, "events")
    return df.select("event_id", *(tokens.audit_token(F.col(c), df.schema[c].dataType).alias(n) for c, n in (("ts", "of_time"), ("user_id", "of_number"), ("event_type", "of_text"))))


@register("f4_capture_key_text", sql="SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS as_datetime, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS as_datetime2, CAST(event_id AS VARCHAR) AS as_number FROM events")
def f4(spark, sf):
    df = load(spark, sf, "events")
    ts, kind = F.col("ts"), df.schema["ts"].dataType
    return df.select("event_id", tokens.capture_key_text(ts, kind, "datetime").alias("as_datetime"), tokens.capture_key_text(ts, kind).alias("as_datetime2"), tokens.capture_key_text(F.col("event_id"), df.schema["event_id"].dataType).alias("as_number"))


@register("f5_epoch_ms_text", "text_keys", "SELECT p_partkey, CASE WHEN stamp > 100000000000 THEN strftime(make_timestamp(stamp * 1000), '%Y-%m-%d %H:%M:%S.%g') ELSE CAST(stamp AS VARCHAR) END AS text FROM text_keys")
def f5(spark, sf):
    return fixture(spark, sf, "text_keys").select("p_partkey", tokens.epoch_ms_text(F.col("stamp")).alias("text"))


@register("f6_legacy_label", "text_keys", "SELECT p_partkey, trim(label, ' ') AS text, CAST(p_partkey AS VARCHAR) AS number FROM text_keys")
def f6(spark, sf):
    df = fixture(spark, sf, "text_keys")
    return df.select("p_partkey", tokens.legacy_label(F.col("label"), df.schema["label"].dataType).alias("text"), tokens.legacy_label(F.col("p_partkey"), df.schema["p_partkey"].dataType).alias("number"))


@register(
    "f7_clean_text",
    "text_keys",
    """SELECT p_partkey, CASE WHEN regexp_matches(s, '^\\d{4}-\\d{2}-\\d{2}[T ]\\d{2}:\\d{2}:\\d{2}\\.\\d{6}$') THEN substr(s, 1, 23) ELSE s END AS text
    FROM (SELECT p_partkey, nullif(regexp_replace(label, '^\\s+|\\s+$', '', 'g'), '') AS s FROM text_keys)""",
)
def f7(spark, sf):
    return fixture(spark, sf, "text_keys").select("p_partkey", tokens.clean_text(F.col("label")).alias("text"))
