"""Source, target and log tables derived from the given tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

FIXTURES = {
    "tgt_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 10 <> 3
        UNION ALL
        SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM {orders} WHERE o_orderkey % 50 = 0""",
    "audit_log": """
        SELECT event_id AS log_id,
               CASE event_id % 10 WHEN 0 THEN 'customer' WHEN 1 THEN 'sysdiagrams' WHEN 2 THEN 'part' ELSE 'orders' END AS table_name,
               CAST(user_id AS STRING) AS pk_value, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS operation, ts AS created_at,
               CASE WHEN event_id % 4 = 0 THEN 'processed' WHEN event_id % 97 = 0 THEN 'deferred_max' ELSE 'pending' END AS status,
               CASE WHEN event_id % 4 = 0 THEN ts + INTERVAL 1 HOUR END AS processed_at, CAST(event_id % 12 AS INT) AS retry_count
        FROM {events}""",
    "tgt_customer": """
        SELECT c_custkey + 100000 AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'A' AS sync_source_id, CAST(c_custkey AS STRING) AS source_record_id
        FROM {customer} WHERE c_custkey % 5 <> 0""",
    "legacy_customer": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CASE WHEN c_custkey % 3 <> 0 THEN 'A' END AS sync_source_id,
               CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS STRING) END AS source_record_id
        FROM {customer} WHERE c_custkey % 5 <> 0""",
    "orders_null_fk": "SELECT o_orderkey, CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice FROM {orders}",
    "source_a": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM {orders} WHERE o_orderkey % 2 = 0 OR o_orderkey % 6 = 0",
    "source_b": "SELECT o_orderkey, o_custkey, o_totalprice + 5 AS o_totalprice, o_orderdate, o_orderstatus FROM {orders} WHERE o_orderkey % 2 = 1 OR o_orderkey % 6 = 0",
    "lineage_orders": """
        SELECT o_orderkey + 5000000 AS o_orderkey, o_custkey, o_totalprice - 1 AS o_totalprice, o_orderdate, o_orderpriority, CASE WHEN o_orderkey % 4 = 0 THEN 'A' ELSE 'B' END AS sync_source_id,
               CAST(o_orderkey AS STRING) AS source_record_id
        FROM {orders} WHERE o_orderkey % 3 <> 1 AND o_orderkey % 10 < 8""",
    "text_keys": """
        SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN '   ' WHEN p_partkey % 9 = 1 THEN '2024-01-0' || CAST(1 + p_partkey % 8 AS STRING) || 'T10:20:30.500000Z'
               WHEN p_partkey % 9 = 2 THEN '2024-01-05 10:20:30.123456' WHEN p_partkey % 9 = 3 THEN 'A T Z' ELSE '  ' || p_name || chr(9) END AS label, p_brand, p_retailprice,
               CASE WHEN p_partkey % 2 = 0 THEN 1700000000123 + p_partkey ELSE p_partkey END AS stamp
        FROM {part}""",
    "tgt_orders_behind": """
        SELECT o_orderkey + 5000000 AS o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'B' ELSE 'A' END AS sync_source_id, CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 6 = 0 THEN '.0' ELSE '' END AS source_record_id
        FROM {orders} WHERE o_orderkey * 5 < (SELECT max(o_orderkey) FROM {orders}) * 4""",
    "tgt_shared": """
        SELECT c_custkey + 100000 AS c_custkey, CAST(0 AS DOUBLE) AS balance, 'A' AS sync_source_id, CAST(c_custkey AS STRING) AS source_record_id
        FROM {customer} WHERE c_custkey % 5 <> 0 AND c_custkey % 2 = 0""",
    "src_lines": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM {lineitem}",
    "tgt_lines": """
        SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_quantity) + 1 AS l_quantity, max(l_extendedprice) AS l_extendedprice
        FROM {lineitem} WHERE l_linenumber <> 3 GROUP BY l_orderkey, l_linenumber""",
    "src_codes": "SELECT '  ' || CAST(p_partkey AS STRING) || chr(9) AS code, p_brand, p_retailprice FROM {part}",
    "tgt_codes": "SELECT CASE WHEN p_partkey % 2 = 0 THEN '  ' || CAST(p_partkey AS STRING) || chr(9) ELSE CAST(p_partkey AS STRING) END AS code, 'old' AS p_brand, p_retailprice FROM {part}",
    "src_moments": "SELECT ts + event_id * INTERVAL 1 MICROSECOND AS moment, event_id, event_type FROM {events}",
    "tgt_moments": "SELECT ts + event_id * INTERVAL 1 MICROSECOND AS moment, event_id, 'old' AS event_type FROM {events} WHERE event_id % 3 <> 0",
    "claims": """
        SELECT 'src_' || CAST(user_id AS STRING) AS source_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE 'h' || CAST(user_id % 7 AS STRING) END AS source_host,
               CASE event_type WHEN 'signup' THEN '' WHEN 'error' THEN NULL ELSE 'db' END AS source_db
        FROM {events} WHERE user_id % 3 = 0 OR (event_id % 50 <> 0 AND event_type = 'view')""",
    "columns": """
        SELECT 'src_' || l_returnflag AS source_id, 'tbl_' || CAST(l_partkey AS STRING) AS table_name, 'col_' || CAST(l_linenumber AS STRING) AS column_name,
               CASE WHEN max(l_suppkey) % 9 = 0 THEN 'int' WHEN l_linenumber = 5 THEN 'decimal' ELSE 'varchar' END AS data_type, CAST(max(l_quantity) AS INT) % 3 * 20 AS length, l_linenumber AS ordinal
        FROM {lineitem} GROUP BY l_returnflag, l_partkey, l_linenumber""",
    "source_keys": """
        SELECT 'src_' || l_returnflag AS source_id, 'tbl_' || CAST(l_partkey AS STRING) AS table_name, 'col_' || CAST(l_linenumber AS STRING) AS column_name, l_linenumber AS ordinal
        FROM {lineitem} WHERE l_linenumber <= 2 AND l_suppkey % 4 <> 0 GROUP BY l_returnflag, l_partkey, l_linenumber""",
    "catalog": """
        SELECT 'tbl_' || CAST(l_partkey AS STRING) AS table_name, CASE WHEN l_linenumber = 4 AND l_partkey % 2 = 0 THEN 'Id' ELSE 'col_' || CAST(l_linenumber AS STRING) END AS column_name, l_linenumber AS ordinal,
               l_linenumber % 2 = 0 AS is_nullable, l_linenumber = 1 AND l_partkey % 3 = 0 AS is_identity, CASE WHEN l_partkey % 5 = 1 THEN '0' END AS default_def,
               CASE l_linenumber WHEN 1 THEN 'bigint' WHEN 2 THEN 'nvarchar' WHEN 3 THEN 'money' ELSE 'int' END AS data_type
        FROM {lineitem} GROUP BY l_partkey, l_linenumber""",
    "index_cols": """
        SELECT 'tbl_' || CAST(l_partkey AS STRING) AS table_name, 'ix_' || l_returnflag AS index_name, 'col_' || CAST(l_linenumber AS STRING) AS column_name, CAST(max(l_suppkey) % 3 AS INT) AS key_ordinal,
               l_returnflag = 'A' AND l_partkey % 4 = 0 AS is_primary, l_returnflag <> 'N' AS is_unique, l_returnflag = 'R' AND l_partkey % 2 = 0 AS has_filter
        FROM {lineitem} WHERE l_partkey % 3 <> 2 GROUP BY l_returnflag, l_partkey, l_linenumber""",
    "line_counts": "SELECT 'tbl_' || CAST(l_suppkey AS STRING) AS table_name, count(*) AS n_rows FROM {lineitem} GROUP BY l_suppkey",
    "line_counts_target": "SELECT 'tbl_' || CAST(l_suppkey AS STRING) AS table_name, count(*) AS n_rows FROM {lineitem} WHERE l_suppkey % 7 <> 0 AND (l_suppkey % 3 <> 0 OR l_linenumber > 2) GROUP BY l_suppkey",
}

#: The log without the rows that a stream has not read yet.
FIXTURES["audit_seen"] = FIXTURES["audit_log"] + " WHERE event_id % 13 <> 0"


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = FIXTURES[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", sql))}
    return spark.sql(sql, **used)


def with_fixtures(names: str, body: str) -> str:
    """`body` as SQL for DuckDB, with the named fixtures as common tables."""
    parts = [f"{n} AS ({FIXTURES[n].format(**{t: t for t in TABLES})})" for n in names.split()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
