"""Small cases for the decisions and rules of the table-sync operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import tokens
from ledgerloom.operators import changelog, diff, fk, keys, lineage, merge, schema
from ledgerloom.sources import tables
from ledgerloom.sources.folders import new_folder
from ledgerloom.streaming import apply as streaming


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, value, kind, f):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", kind)]))
    return df.select(f(F.col("c"), kind)).first()[0]


MOMENT = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)


@pytest.mark.parametrize(
    "value, kind, text",
    [
        (b" ab\xff ", T.BinaryType(), "ab"),
        (MOMENT, T.TimestampNTZType(), "2024-01-02 03:04:05.123"),
        (12345678.0, T.DoubleType(), "12345678.0"),
        ("\t x ", T.StringType(), "x"),
        ("a1b2c3d4-0000-1111-2222-abcdefabcdef", T.StringType(), "A1B2C3D4-0000-1111-2222-ABCDEFABCDEF"),
        ("y" * 100, T.StringType(), "y" * 100),
        (None, T.StringType(), None),
        (7, T.LongType(), "7"),
    ],
)
def test_source_record_token(spark, value, kind, text):
    assert one(spark, value, kind, tokens.source_record_token) == text


def test_decimal_token_is_float_text(spark):
    from decimal import Decimal

    assert one(spark, Decimal("5.0000"), T.DecimalType(18, 4), tokens.source_record_token) == "5.0"


def test_long_keys_stay_apart(spark):
    a, b = (one(spark, "y" * 120 + x, T.StringType(), tokens.source_record_token) for x in "ab")
    assert a != b and len(a) == len(b) == 100 and a[:67] == b[:67] == "y" * 67
    assert a == one(spark, "y" * 120 + "a", T.StringType(), tokens.legacy_label)


@pytest.mark.parametrize("kind", [T.DecimalType(15, 4), T.DecimalType(18, 4)])
@pytest.mark.parametrize("value", ["5", "-12.34", "0.0001", "1234567.5", "0"])
def test_decimals_are_float_texts(spark, kind, value):
    from decimal import Decimal

    assert one(spark, Decimal(value), kind, tokens.source_record_token) == one(spark, Decimal(value), kind, tokens.key_token) == str(float(value))


def test_key_token_rewrites_only_timestamps(spark):
    assert one(spark, " ATBZ\t", T.StringType(), tokens.key_token) == "ATBZ"
    assert one(spark, "2024-01-02T03:04:05.500Z", T.StringType(), tokens.key_token) == "2024-01-02 03:04:05.5"
    assert one(spark, MOMENT.replace(microsecond=0), T.TimestampNTZType(), tokens.key_token) == "2024-01-02 03:04:05"
    assert one(spark, dt.date(2024, 1, 2), T.DateType(), tokens.key_token) == "2024-01-02 00:00:00"


def test_legacy_label_trims_spaces_only(spark):
    assert one(spark, " a\t ", T.StringType(), tokens.legacy_label) == "a\t"


def test_deletes_lead_to_no_write_and_are_processed(spark):
    log = spark.createDataFrame([(1, "t", "1", "D", "pending", None, 0), (2, "t", "2", "U", "pending", None, 9)], "log_id long, table_name string, pk_value string, operation string, status string, processed_at timestamp_ntz, retry_count int")
    assert [r.pk_value for r in changelog.work_items(log).collect()] == ["2"]
    outcomes = spark.createDataFrame([("t", "1", "done", None), ("t", "2", "deferred", "parent")], "table_name string, pk_value string, outcome string, reason string")
    after = {r.log_id: r for r in changelog.apply_outcomes(log, outcomes, "2024-01-01 00:00:00", "A").collect()}
    assert after[1].status == "processed" and after[1].source_id == "A"
    assert after[2].status == "deferred_max" and after[2].retry_count == 10 and after[2].reason == "parent"


def test_scope(spark):
    names = spark.createDataFrame([("sysx",), ("MSrepl",), ("a_tracking",), ("atracking",), ("t",)], "table_name string")
    assert rows(changelog.scope_tables(names)) == [("atracking",), ("t",)]
    assert rows(changelog.scope_tables(names, allow=["t"])) == [("t",)]


def test_purge_of_no_days_keeps_all(spark):
    log = spark.createDataFrame([("processed", MOMENT), ("processed", None)], "status string, processed_at timestamp_ntz")
    assert changelog.purge_log(log, 0, "2030-01-01 00:00:00").count() == 2
    assert changelog.purge_log(log, 1, "2030-01-01 00:00:00").count() == 1


def test_null_keys_match_in_composite_keys_only(spark):
    target = spark.createDataFrame([(1, None, "old"), (None, 5, "old")], "a int, b int, v string")
    both = merge.merge_upsert(target, spark.createDataFrame([(1, None, "new")], "a int, b int, v string"), ["a", "b"])
    assert rows(both.select("a", "v", "_action")) == rows(spark.createDataFrame([(1, "new", "U"), (None, "old", None)], "a int, v string, x string"))
    single = merge.merge_upsert(target, spark.createDataFrame([(None, "new")], "a int, v string"), ["a"])
    assert single.where("_action = 'I'").count() == 1 and single.count() == 3


@pytest.mark.parametrize("few", [None, 10])
def test_merge_overwrites_with_nulls_and_is_idempotent(spark, few):
    target = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0)], "k int, v string, own double")
    changes = spark.createDataFrame([(1, None), (3, "n")], "k int, v string")
    once = merge.merge_upsert(target, changes, ["k"], changes_count=few)
    assert rows(once) == sorted([(1, None, 1.0, "U"), (1, None, 2.0, "U"), (2, "c", 3.0, None), (3, "n", None, "I")], key=str)
    twice = merge.merge_upsert(once.drop("_action"), changes, ["k"], changes_count=few)
    assert rows(twice.drop("_action")) == rows(once.drop("_action"))
    assert diff.missing_rows(changes, once, ["k"]).count() == 0


def test_nameless_records_are_always_inserted(spark):
    target = spark.createDataFrame([(1, "x", "A", "7"), (2, "y", "A", None)], "k int, v string, sync_source_id string, source_record_id string")
    changes = spark.createDataFrame([(9, "n", None), (9, "m", "7")], "k int, v string, source_record_id string")
    merged = merge.merge_by_lineage(target, changes, "A", "k")
    assert rows(merged) == sorted([(1, "m", "A", "7", "U"), (2, "y", "A", None, None), (None, "n", "A", None, "I")], key=str)


def test_two_links_to_one_parent_do_not_mix(spark):
    parent = spark.createDataFrame([(101, "A", "1"), (102, "A", "2"), (103, "B", "3")], "id long, sync_source_id string, source_record_id string")
    child = spark.createDataFrame([(1, 1, 2), (2, 2, None), (3, 1, 3)], "k long, a long, b long")
    ready, late = fk.remap_fks(child, {"p": parent}, [fk.Link("a", "p", "id"), fk.Link("b", "p", "id")], "A")
    assert rows(ready) == [(1, 101, 102), (2, 102, None)]
    assert rows(late) == [(3, 1, 3)]


def test_table_order():
    links = {"child": [fk.Link("p", "parent", "id")], "parent": [fk.Link("p", "parent", "id")], "x": [fk.Link("y", "y", "id")], "y": [fk.Link("x", "x", "id")]}
    order = fk.table_order(["child", "parent", "x", "y"], links)
    assert order.index("parent") < order.index("child") and set(order) == {"child", "parent", "x", "y"}


def test_adoption_takes_one_row_a_key(spark):
    target = spark.createDataFrame([(1, "b", None, None), (1, "a", None, None), (2, "c", "A", "2")], "k long, v string, sync_source_id string, source_record_id string")
    changes = spark.createDataFrame([("1",), ("2",)], "source_record_id string")
    adopted = lineage.adopt_legacy(target, changes, "k", "A", ["v"])
    assert rows(adopted.where("sync_source_id = 'A'").select("v")) == [("a",), ("c",)]
    assert adopted.count() == 3 and lineage.lineage_duplicates(adopted).count() == 0


def test_watermark_reads_decimal_texts(spark):
    target = spark.createDataFrame([("A", "5.0"), ("A", "x"), ("B", "99")], "sync_source_id string, source_record_id string")
    source = spark.createDataFrame([(i,) for i in range(8)], "k long")
    assert rows(diff.rows_above_watermark(source, target, "k", "A")) == [(6,), (7,)]
    assert diff.rows_above_watermark(source, target, "k", "C").count() == 8


def test_dense_ids_equal_row_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(5)
    assert rows(keys.add_surrogate_key(df, ["k"], start=10)) == [(i, i + 10) for i in sorted(range(1000), key=lambda i: str((i, i + 10)))]


def test_empty_table_is_a_risk(spark):
    assert keys.key_quality(spark.range(0), "id").first().verdict == "RISK"
    assert keys.next_key(spark.range(0), "id").first()[0] == 1


def test_rejects_keep_the_rest(spark):
    want = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("n", T.IntegerType())])
    ok, bad = schema.split_rejects(spark.createDataFrame([("1", "5"), ("2", "x"), (None, "7")], "k string, n string"), want, "k")
    assert rows(ok) == [(1, 5)]
    assert {r.reason for r in bad.collect()} == {"n: not int", "k: null"}


def test_target_schema_keeps_precision_and_adds_lineage():
    made = schema.target_schema(T.StructType([T.StructField("d", T.DecimalType(12, 2)), T.StructField("s", T.VarcharType(20)), T.StructField("t", T.VarcharType(80)), T.StructField("b", T.BooleanType())]))
    assert [f.name for f in made] == ["d", "s", "t", "b", "sync_source_id", "source_record_id"]
    assert made["d"].dataType == T.DecimalType(12, 2) and made["s"].metadata == {"length": 20} and made["t"].metadata == {}


def test_snapshots_and_jdbc(spark, tmp_path):
    path = new_folder(spark, "snapshots")
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, path)
    tables.write_snapshot(spark.range(3), path, 1)
    tables.write_snapshot(spark.range(5), path, 2)
    assert tables.read_snapshot(spark, path).count() == 5 and tables.read_snapshot(spark, path, 1).count() == 3
    url = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(100).withColumnRenamed("id", "k").write.format("jdbc").options(**url, dbtable="t").mode("overwrite").save()
    assert tables.read_table(spark, url, "t", split=("k", 0, 100, 3)).count() == 100


LOG = "log_id long, table_name string, pk_value string, operation string, created_at timestamp_ntz, status string, processed_at timestamp_ntz, retry_count int"


def log_file(spark, path, changes):
    spark.createDataFrame([(i, t, k, "I", None, "pending", None, 0) for i, t, k in changes], LOG).coalesce(1).write.mode("append").parquet(path)


def test_late_parent_releases_its_child(spark):
    root, log = new_folder(spark, "root"), new_folder(spark, "log")
    parents, children = spark.createDataFrame([(1, "p")], "id long, v string"), spark.createDataFrame([(10, 1), (11, 99)], "id long, parent long")
    jobs = [streaming.Table("child", lambda s: children, "id", (fk.Link("parent", "parent", "id"),)), streaming.Table("parent", lambda s: parents, "id")]
    streaming.start_versions(spark, {"parent": parents.limit(0), "child": children.limit(0)}, root, jobs)
    for changes in ([(1, "child", "10"), (2, "child", "11")], [(3, "child", "11")], [(4, "parent", "1")]):
        log_file(spark, log, changes)
    last = streaming.run_stream(spark, log, jobs, root, max_files=1, max_retries=3)
    assert last == 2 and rows(streaming.read_target(spark, root, "child")) == [(10, 1)]
    left = streaming.read_deferred(spark, root).first()
    assert (left.pk_value, left.status, left.retry_count) == ("11", "deferred_max", 3)
    assert streaming.run_stream(spark, log, jobs, root, max_files=1, max_retries=3) == 2  # nothing new: the same version


def test_late_rows_with_temporal_keys_stay_deferred(spark):
    root = new_folder(spark, "temporal")
    children = spark.createDataFrame([(dt.datetime(2024, 1, 1), 5)], "id timestamp_ntz, parent long")
    parents = spark.createDataFrame([(5, "p")], "id long, v string")
    jobs = [streaming.Table("child", lambda s: children, "id", (fk.Link("parent", "parent", "id"),)), streaming.Table("parent", lambda s: parents, "id")]
    streaming.start_versions(spark, {"parent": parents.limit(0), "child": children.limit(0)}, root, jobs)
    one_change = lambda t, k: spark.createDataFrame([(1, t, k, "I", None, "pending", None, 0)], LOG)
    streaming.apply_batch(spark, one_change("child", "2024-01-01 00:00:00.000000"), jobs, root, 0)
    assert [r.pk_value for r in streaming.read_deferred(spark, root).collect()] == ["2024-01-01 00:00:00.000000"]
    streaming.apply_batch(spark, one_change("parent", "5"), jobs, root, 1)
    assert streaming.read_target(spark, root, "child").count() == 1 and streaming.read_deferred(spark, root).count() == 0


def test_parked_key_is_free_once_it_succeeds(spark):
    root = new_folder(spark, "parked")
    source = spark.createDataFrame([(1, 5)], "id long, parent long")
    parents = spark.createDataFrame([(5,)], "id long")
    jobs = [streaming.Table("child", lambda s: source, "id", (fk.Link("parent", "parent", "id"),)), streaming.Table("parent", lambda s: parents, "id")]
    streaming.start_versions(spark, {"parent": parents.limit(0), "child": source.limit(0)}, root, jobs)
    change = lambda t, k: spark.createDataFrame([(1, t, k, "U", None, "pending", None, 0)], LOG)
    streaming.apply_batch(spark, change("child", "1"), jobs, root, 0, max_retries=1)
    assert streaming.read_deferred(spark, root).first().status == "deferred_max"
    streaming.apply_batch(spark, change("parent", "5"), jobs, root, 1, max_retries=1)
    assert streaming.read_deferred(spark, root).count() == 1
    streaming.apply_batch(spark, change("child", "1"), jobs, root, 2, max_retries=1)
    assert streaming.read_deferred(spark, root).count() == 0 and streaming.read_target(spark, root, "child").count() == 1


def test_rows_that_cannot_land_wait(spark):
    root = new_folder(spark, "rejects")
    source = spark.createDataFrame([(1, "7"), (2, "x")], "id long, n string")
    job = [streaming.Table("t", lambda s: source, "id")]
    streaming.start_versions(spark, {"t": spark.createDataFrame([(1, 0), (3, 3)], "id long, n int")}, root, job)
    streaming.apply_batch(spark, spark.createDataFrame([(i, "t", str(i), "U", None, "pending", None, 0) for i in (1, 2)], LOG), job, root, 0)
    assert rows(streaming.read_target(spark, root, "t")) == [(1, 7), (3, 3)]
    assert [r.pk_value for r in streaming.read_deferred(spark, root).collect()] == ["2"]


def test_replayed_batch_changes_nothing(spark):
    root = new_folder(spark, "replay")
    source = spark.createDataFrame([(1, "new")], "id long, v string")
    job = [streaming.Table("t", lambda s: source, "id")]
    streaming.start_versions(spark, {"t": spark.createDataFrame([(1, "old"), (2, "kept")], "id long, v string")}, root, job)
    log = spark.createDataFrame([(1, "t", "1", "U", None, "pending", None, 0)], LOG)
    for _ in range(2):
        streaming.apply_batch(spark, log, job, root, 0)
    assert rows(streaming.read_target(spark, root, "t")) == [(1, "new"), (2, "kept")]


def test_repeated_lineage_does_not_multiply_children(spark):
    parent = spark.createDataFrame([(102, "A", "1"), (101, "A", "1")], "id long, sync_source_id string, source_record_id string")
    child = spark.createDataFrame([(1, 1)], "k long, a long")
    ready, late = fk.remap_fks(child, {"p": parent}, [fk.Link("a", "p", "id")], "A")
    assert rows(ready) == [(1, 101)] and late.count() == 0


def test_few_changes_do_not_shuffle_the_target(spark):
    path = new_folder(spark, "target")
    spark.range(1000).withColumn("v", F.lit("old")).write.parquet(path)
    target = spark.read.parquet(path)
    changes = spark.createDataFrame([(5, "new"), (5000, "new")], "id long, v string")
    merged = merge.merge_upsert(target, changes, ["id"], changes_count=2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 3
    assert rows(merged.where("v = 'new'")) == [(5, "new", "U"), (5000, "new", "I")] and merged.count() == 1001


def test_keys_of_text_and_of_time_compare_by_token(spark):
    source = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0)), (2, dt.datetime(2024, 1, 1, 10, 0, 0, 500000)), (3, dt.datetime(2024, 1, 1, 11, 0)), (4, None)], "n int, k timestamp_ntz")
    target = spark.createDataFrame([("2024-01-01T10:00:00Z",), (" 2024-01-01 10:00:00.500",), (None,)], "k string")
    assert rows(diff.missing_rows(source, target, ["k"]).select("n")) == [(3,)]
    numbers = spark.createDataFrame([("7",), ("8",)], "k string")
    assert rows(diff.missing_rows(spark.range(7, 10).withColumnRenamed("id", "k"), numbers, ["k"])) == [(9,)]
