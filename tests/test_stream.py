"""The continuous job on cases that go wrong easily, and the layered targets under it."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import changelog, fk, lineage, merge
from ledgerloom.plans import apply as plans
from ledgerloom.plans import backfill
from ledgerloom.sources import layers
from ledgerloom.sources import tables as store
from ledgerloom.sources.folders import children, new_folder
from ledgerloom.streaming import apply as streaming
from test_semantics import LOG, rows


def log_of(spark, changes):
    """Pending log rows (table, key, operation), numbered."""
    return spark.createDataFrame([(i, t, k, op, None, "pending", None, 0) for i, (t, k, op) in enumerate(changes, 1)], LOG)


def updates(spark, table, texts, first=1):
    return spark.createDataFrame([(first + i, table, k, "U", None, "pending", None, 0) for i, k in enumerate(texts)], LOG)


def deferred(spark, root):
    return sorted((r.pk_value, r.status, r.retry_count) for r in streaming.read_deferred(spark, root).collect())


# The stream.


def test_unlabelled_rows_are_adopted(spark):
    root = new_folder(spark, "adopt")
    target = spark.createDataFrame([(i, f"old{i}", None, None) for i in range(1, 7)], "id long, v string, sync_source_id string, source_record_id string")
    source = spark.createDataFrame([(i, f"new{i}") for i in range(1, 7)], "id long, v string")
    job = [streaming.Table("t", lambda s: source, "id", source_id="A", adopt_legacy=True)]
    streaming.start_versions(spark, {"t": target}, root, job)
    streaming.apply_batch(spark, updates(spark, "t", ["1", "2", "3"]), job, root, 0)
    found = rows(streaming.read_target(spark, root, "t"))
    assert found == rows(spark.createDataFrame([(i, f"new{i}", "A", str(i)) if i < 4 else (i, f"old{i}", None, None) for i in range(1, 7)], target.schema))
    streaming.apply_batch(spark, updates(spark, "t", ["1", "5"], 9), job, root, 1)
    assert streaming.read_target(spark, root, "t").count() == 6 and lineage.lineage_duplicates(streaming.read_target(spark, root, "t")).count() == 0


def test_keys_stay_whole(spark):
    cases = [
        ("string", [" a ", "a", "b\t"], [" a ", "a", "b\t"]),
        ("timestamp_ntz", [dt.datetime(2024, 1, 1, 0, 0, 0, 123456), dt.datetime(2024, 1, 1, 0, 0, 0, 123999)], ["2024-01-01 00:00:00.123456", "2024-01-01 00:00:00.123999"]),
        ("decimal(20,0)", [Decimal("12345678901234567891"), Decimal("12345678901234567892")], ["12345678901234567891", "12345678901234567892"]),
    ]
    for kind, values, texts in cases:
        root = new_folder(spark, "keys")
        source = spark.createDataFrame([(v, f" v{i} ") for i, v in enumerate(values)], f"k {kind}, v string")
        job = [streaming.Table("t", lambda s, df=source: df, "k")]
        streaming.start_versions(spark, {"t": source.limit(0)}, root, job)
        streaming.apply_batch(spark, updates(spark, "t", texts), job, root, 0)
        assert rows(streaming.read_target(spark, root, "t")) == sorted(((v, f"v{i}") for i, v in enumerate(values)), key=str)
        assert deferred(spark, root) == []


def test_only_read_log_rows_are_marked(spark):
    root = new_folder(spark, "marks")
    source = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    job = [streaming.Table("t", lambda s: source, "id")]
    streaming.start_versions(spark, {"t": source.limit(0)}, root, job)
    log = log_of(spark, [("t", "1", "U"), ("t", "1", "U"), ("t", "2", "D"), ("sysx", "1", "U"), ("unknown", "1", "U")])
    streaming.apply_batch(spark, log.where("log_id <> 2"), job, root, 0, source_id="A", now="2024-01-31 00:00:00")
    marked = {r.log_id: (r.status, r.source_id) for r in streaming.marked_log(spark, root, log).collect()}
    assert marked == {1: ("processed", "A"), 2: ("pending", None), 3: ("processed", "A"), 4: ("processed", "A"), 5: ("pending", None)}
    streaming.apply_batch(spark, log.where("log_id = 2"), job, root, 1)
    assert streaming.marked_log(spark, root, log).where("status = 'pending'").count() == 1
    assert rows(streaming.read_target(spark, root, "t")) == [(1, "x")]


def test_rows_without_a_write_share_the_next_outcome_of_their_key(spark):
    """Batches may close deletes before they read that the key changes; what becomes of the key holds for these too."""
    root, fetched = new_folder(spark, "idle"), []
    jobs, parents, kids = waiting_jobs(spark, fetched)
    streaming.start_versions(spark, {"parent": parents.limit(0), "child": kids.limit(0)}, root, jobs)
    log = log_of(spark, [("child", "10", "D"), ("child", "20", "D"), ("child", "10", "U"), ("child", "20", "U"), ("child", "20", "D"), ("parent", "1", "U"), ("child", "20", "D"), ("child", "20", "U")])
    status = lambda: {r.log_id: r.status for r in streaming.marked_log(spark, root, log).collect()}
    for batch, (ids, want) in enumerate(
        [
            ((1, 2), "processed processed pending pending pending pending pending pending"),
            ((3, 4), "pending pending pending pending pending pending pending pending"),
            ((5, 6), "processed deferred_max processed deferred_max deferred_max processed pending pending"),
            ((7,), "processed deferred_max processed deferred_max deferred_max processed processed pending"),
            ((8,), "processed deferred_max processed deferred_max deferred_max processed pending pending"),
        ]
    ):
        streaming.apply_batch(spark, log.where(F.col("log_id").isin(*ids)), jobs, root, batch, max_retries=2, source_id="A", now=f"2024-01-0{batch + 1} 00:00:00")
        assert [s for _, s in sorted(status().items())] == want.split()
    found = {r.log_id: (r.retry_count, r.processed_at, r.source_id, r.reason) for r in streaming.read_log(spark, root).collect()}
    assert len(found) == streaming.read_log(spark, root).count() == 8
    assert found[1] == (0, dt.datetime(2024, 1, 1), "A", None) and found[2] == found[4] == (2, dt.datetime(2024, 1, 3), "A", "parent")
    assert found[7] == found[8] == (1, None, None, "parent")


def test_rejected_children_with_a_shared_key_wait(spark):
    root = new_folder(spark, "shared")
    parents = spark.createDataFrame([(101, "A", "1"), (102, "A", "2")], "id long, sync_source_id string, source_record_id string")
    source = spark.createDataFrame([(1, "5"), (2, "no number")], "id long, n string")
    target = spark.createDataFrame([], "id long, n int, sync_source_id string, source_record_id string")
    jobs = [streaming.Table("p", lambda s: parents.select("id"), "id", source_id="A"), streaming.Table("c", lambda s: source, "id", (fk.Link("id", "p", "id"),), source_id="A", preserve_pk=True)]
    streaming.start_versions(spark, {"p": parents, "c": target}, root, jobs)
    log = updates(spark, "c", ["1", "2"])
    streaming.apply_batch(spark, log, jobs, root, 0, max_retries=3)
    assert rows(streaming.read_target(spark, root, "c")) == [(101, 5, "A", "1")]
    assert deferred(spark, root) == [("2", "pending", 1)]
    assert {r.log_id: r.status for r in streaming.marked_log(spark, root, log).collect()} == {1: "processed", 2: "pending"}
    assert "not int" in streaming.read_deferred(spark, root).first().reason


def test_number_of_buckets_stays_with_the_target(spark):
    root = new_folder(spark, "buckets")
    source = spark.range(40).withColumn("v", F.lit("new"))
    job = [streaming.Table("t", lambda s: source, "id")]
    streaming.start_versions(spark, {"t": spark.range(40).withColumn("v", F.lit("old"))}, root, job, buckets=64)
    streaming.apply_batch(spark, updates(spark, "t", [str(i) for i in range(0, 40, 3)]), job, root, 0)
    assert rows(streaming.read_target(spark, root, "t")) == sorted(((i, "old" if i % 3 else "new") for i in range(40)), key=str)
    assert layers.read_manifest(spark, f"{root}/t").buckets == 64


def test_composite_keys(spark):
    root = new_folder(spark, "composite")
    source = spark.createDataFrame([(1, 1, "n11"), (1, 2, "n12"), (1, None, "n1-"), (1, None, "n1-again"), (2, 1, "n21"), (3, 1, "n31")], "a long, b int, v string")
    target = spark.createDataFrame([(1, 1, "o11"), (1, None, "o1-"), (1, 9, "o19"), (2, 1, "o21")], "a long, b int, v string")
    job = [streaming.Table("t", lambda s: source, ("a", "b"))]
    streaming.start_versions(spark, {"t": target}, root, job)
    streaming.apply_batch(spark, updates(spark, "t", ["1", "3"]), job, root, 0)
    assert rows(streaming.read_target(spark, root, "t")) == sorted([(1, 1, "n11"), (1, 2, "n12"), (1, None, "n1-"), (1, 9, "o19"), (2, 1, "o21"), (3, 1, "n31")], key=str)


def test_composite_keys_by_lineage(spark):
    root = new_folder(spark, "composite")
    source = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a long, b int, v string")
    target = lineage.stamp_lineage(source, "A", ("a", "b")).limit(0)
    job = [streaming.Table("t", lambda s: source, ("a", "b"), source_id="A", preserve_pk=True)]
    streaming.start_versions(spark, {"t": target}, root, job)
    for batch in (0, 1):
        streaming.apply_batch(spark, updates(spark, "t", ["1"], batch + 1), job, root, batch)
    assert rows(streaming.read_target(spark, root, "t")) == [(1, 1, "x", "A", "1|1"), (1, 2, "y", "A", "1|2")]
    with pytest.raises(ValueError):
        streaming.start_versions(spark, {"t": target}, new_folder(spark, "composite"), [job[0]._replace(preserve_pk=False)])


def waiting_jobs(spark, fetched):
    """A child and its parent; `fetched` records how often the child's source is asked."""
    parents, children_ = spark.createDataFrame([(1, "p"), (2, "q")], "id long, v string"), spark.createDataFrame([(10, 1), (20, 2)], "id long, parent long")

    def source(s):
        fetched.append(1)
        return children_

    return [streaming.Table("child", source, "id", (fk.Link("parent", "parent", "id"),)), streaming.Table("parent", lambda s: parents, "id")], parents, children_


def test_waiting_rows_are_fetched_only_on_news(spark):
    root, fetched = new_folder(spark, "waiting"), []
    jobs, parents, kids = waiting_jobs(spark, fetched)
    streaming.start_versions(spark, {"parent": parents.limit(0), "child": kids.limit(0)}, root, jobs)
    empty = spark.createDataFrame([], LOG)
    streaming.apply_batch(spark, updates(spark, "child", ["10", "20"]), jobs, root, 0)
    assert len(fetched) == 1 and deferred(spark, root) == [("10", "pending", 1), ("20", "pending", 1)]
    streaming.apply_batch(spark, empty, jobs, root, 1)
    assert len(fetched) == 1 and deferred(spark, root) == [("10", "pending", 2), ("20", "pending", 2)]
    streaming.apply_batch(spark, updates(spark, "parent", ["1"], 5), jobs, root, 2)
    assert len(fetched) == 2 and deferred(spark, root) == [("20", "pending", 3)]
    assert rows(streaming.read_target(spark, root, "child")) == [(10, 1)]
    for batch in range(3, 10):
        streaming.apply_batch(spark, empty, jobs, root, batch)
    assert len(fetched) == 2 and deferred(spark, root) == [("20", "deferred_max", 10)]
    assert rows(streaming.read_log(spark, root).select("pk_value", "status")) == [("1", "processed"), ("10", "processed"), ("20", "deferred_max")]


def test_parents_that_come_later_in_a_batch_wake_their_children_in_the_next(spark):
    """Tables that refer to each other, and a table that refers to itself."""
    root = new_folder(spark, "cycle")
    x, y = spark.createDataFrame([(1, 7)], "id long, y long"), spark.createDataFrame([(7, None)], "id long, x long")
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2)], "id long, up long")
    jobs = [streaming.Table("x", lambda s: x, "id", (fk.Link("y", "y", "id"),)), streaming.Table("y", lambda s: y, "id", (fk.Link("x", "x", "id"),)), streaming.Table("tree", lambda s: tree, "id", (fk.Link("up", "tree", "id"),))]
    streaming.start_versions(spark, {"x": x.limit(0), "y": y.limit(0), "tree": tree.limit(0)}, root, jobs)
    streaming.apply_batch(spark, log_of(spark, [("x", "1", "I"), ("y", "7", "I"), ("tree", "1", "I"), ("tree", "2", "I"), ("tree", "3", "I")]), jobs, root, 0)
    for batch in (1, 2):
        for _ in range(2):  # each batch runs twice, as after a failure
            streaming.apply_batch(spark, spark.createDataFrame([], LOG), jobs, root, batch)
    assert rows(streaming.read_target(spark, root, "x")) == [(1, 7)] and rows(streaming.read_target(spark, root, "y")) == [(7, None)]
    assert streaming.read_target(spark, root, "tree").count() == 3 and deferred(spark, root) == []


def test_scope_of_the_stream(spark):
    root = new_folder(spark, "scope")
    source = spark.createDataFrame([(1, "x")], "id long, v string")
    jobs = [streaming.Table(n, lambda s: source, "id") for n in ("a", "b")]
    streaming.start_versions(spark, {"a": source.limit(0), "b": source.limit(0)}, root, jobs)
    log = log_of(spark, [("a", "1", "I"), ("b", "1", "I")])
    streaming.apply_batch(spark, log, jobs, root, 0, deny=("b",))
    assert streaming.read_target(spark, root, "a").count() == 1 and streaming.read_target(spark, root, "b").count() == 0
    assert streaming.marked_log(spark, root, log).where("status = 'processed'").count() == 2


def test_a_column_that_the_source_gains_arrives(spark):
    root = new_folder(spark, "gained")
    old, new = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string"), spark.createDataFrame([(1, "x", Decimal("1.5"), dt.datetime(2024, 1, 1))], "id long, v string, price decimal(8,2), at timestamp_ntz")
    job = [streaming.Table("t", lambda s: new, "id")]
    streaming.start_versions(spark, {"t": old}, root, job)
    streaming.apply_batch(spark, updates(spark, "t", ["1"]), job, root, 0)
    assert rows(streaming.read_target(spark, root, "t")) == sorted([(1, "x", Decimal("1.50"), dt.datetime(2024, 1, 1)), (2, "y", None, None)], key=str)


def test_purge_removes_closed_rows_only(spark):
    root, fetched = new_folder(spark, "purge"), []
    jobs, parents, kids = waiting_jobs(spark, fetched)
    streaming.start_versions(spark, {"parent": parents.limit(0), "child": kids.limit(0)}, root, jobs)
    log = log_of(spark, [("child", "10", "I"), ("parent", "2", "I")])
    streaming.apply_batch(spark, log, jobs, root, 0, now="2024-01-01 00:00:00")
    streaming.apply_batch(spark, updates(spark, "parent", ["2"], 7), jobs, root, 1, now="2024-01-20 00:00:00")
    assert streaming.purge_marks(spark, root, 0, "2024-02-01 00:00:00") == []
    assert streaming.purge_marks(spark, root, 7, "2024-01-21 00:00:00") == [0]
    assert rows(streaming.read_log(spark, root).select("log_id", "status")) == [(1, "pending"), (7, "processed")]


def test_new_keys_follow_the_largest_and_are_unique(spark):
    root = new_folder(spark, "numbers")
    source = spark.createDataFrame([(i, f"v{i}") for i in range(1, 9)], "id long, v string")
    target = spark.createDataFrame([(500, "x", "B", "1")], "id long, v string, sync_source_id string, source_record_id string")
    job = [streaming.Table("t", lambda s: source, "id", source_id="A")]
    streaming.start_versions(spark, {"t": target}, root, job)
    for batch, texts in enumerate((["1", "2", "3"], ["3", "4"], ["5"])):
        for _ in range(2):
            streaming.apply_batch(spark, updates(spark, "t", texts), job, root, batch)
    found = {r.id: r.source_record_id for r in streaming.read_target(spark, root, "t").where("sync_source_id = 'A'").collect()}
    assert sorted(found) == [501, 502, 503, 504, 505] and sorted(found.values()) == list("12345")


def test_working_tables_and_old_versions_go(spark):
    root = new_folder(spark, "clean")
    source = spark.createDataFrame([(1, "x")], "id long, v string")
    job = [streaming.Table("t", lambda s: source, "id")]
    streaming.start_versions(spark, {"t": source.limit(0)}, root, job)
    for batch in range(streaming.CLEAN_EVERY):
        streaming.apply_batch(spark, updates(spark, "t", ["1"], batch), job, root, batch)
    assert children(spark, f"{root}/work") == []
    assert len(store.versions(spark, f"{root}/deferred")) == streaming.KEEP and len(store.versions(spark, f"{root}/t")) == streaming.KEEP
    assert rows(streaming.read_target(spark, root, "t")) == [(1, "x")]


# Layered targets.


def put(spark, path, version, df, m_buckets=16, **options):
    c = F.col("id").cast("string")
    layers.write_delta(df, path, version, c, layers.wanted(df.select(c.alias(layers.IDENTITY)).distinct(), m_buckets), **options)


def test_a_batch_writes_as_many_rows_as_it_has(spark):
    path = new_folder(spark, "layers")
    layers.create(spark.range(20_000).withColumn("v", F.lit(0)), path, F.col("id").cast("string"))
    want = {i: 0 for i in range(20_000)}
    for version in range(6):
        ids = list(range(version * 7, 25_000, 400))
        put(spark, path, version, spark.createDataFrame([(i, version + 1) for i in ids], "id long, v int"))
        want |= {i: version + 1 for i in ids}
        assert spark.read.parquet(f"{path}/delta={version}").count() == len(ids)
        assert children(spark, f"{path}/version={version}") == []
        assert {r.id: r.v for r in layers.read(spark, path).collect()} == want
    some = spark.createDataFrame([("7",), ("400",), ("24999",), ("none",)], f"{layers.IDENTITY} string")
    assert {r.id: r.v for r in layers.lookup(spark, path, some).collect()} == {i: want[i] for i in (7, 400)}
    assert layers.read(spark, path, 0).where("v <> 0").count() == 0


def test_layers_are_folded_and_swept(spark):
    path = new_folder(spark, "layers")
    layers.create(spark.range(100).withColumn("v", F.lit(-1)), path, F.col("id").cast("string"))
    for version in range(7):
        put(spark, path, version, spark.createDataFrame([(version, version), (1000 + version, version)], "id long, v int"), layers=3)
        assert len(layers.read_manifest(spark, path).deltas) == (version + 1) % 3
    before = rows(layers.read(spark, path))
    layers.vacuum(spark, path, keep=2)
    assert rows(layers.read(spark, path)) == before and len(store.versions(spark, path)) == 2
    assert len(before) == 107 and layers.read(spark, path, 6).count() == 106
    assert not any(name in children(spark, path) for name in ("delta=0", "delta=1", "delta=3"))


def test_one_manifest_is_read_of_a_thousand(spark, monkeypatch):
    path = new_folder(spark, "layers")
    layers.create(spark.range(10).withColumn("v", F.lit(0)), path, F.col("id").cast("string"))
    m = layers.read_manifest(spark, path)
    for version in range(1000):
        layers._commit(spark, path, m._replace(version=version))
    read, real = [], layers.read_text
    monkeypatch.setattr(layers, "read_text", lambda s, p: read.append(p) or real(s, p))
    assert layers.read(spark, path).count() == 10 and len(read) == 1
    layers.vacuum(spark, path)
    assert len(store.versions(spark, path)) == 3


def test_lookups_pass_over_deltas(spark):
    path = new_folder(spark, "layers")
    layers.create(spark.range(1000).withColumn("v", F.lit(0)), path, F.col("id").cast("string"))
    for version in range(3):
        put(spark, path, version, spark.createDataFrame([(version, 1)], "id long, v int"))
    m = layers.read_manifest(spark, path)
    some = layers.wanted(spark.createDataFrame([("1",)], f"{layers.IDENTITY} string"), m.buckets)
    assert [d.version for d in m.deltas if some.may_be_in(d)] == [1]
    files = layers.lookup(spark, path, some).inputFiles()
    assert len({f.split(f"{layers.BUCKET}=")[1].split("/")[0] for f in files if layers.BUCKET in f}) == 1


def test_identities_tell_keys_apart(spark):
    from ledgerloom.functions import tokens

    df = spark.createDataFrame([("a", "b|c"), ("a|b", "c"), (None, "c"), ("-", "c"), ("", None)], "x string, y string")
    assert df.select(tokens.identity_text([F.col("x"), F.col("y")])).distinct().count() == 5


def test_retries_of_the_operator(spark):
    held = spark.createDataFrame([("1", 4), ("2", 0), ("3", 1)], "pk_value string, retry_count int")
    new, waits, arrived = spark.createDataFrame([("1",), ("9",)], "pk_value string"), spark.createDataFrame([("2", "p", "5"), ("3", "p", "6")], "pk_value string, parent string, token string"), spark.createDataFrame([("p", "5"), ("q", "6")], "parent string, token string")
    items, asleep = streaming.retry_state(held, new, waits, arrived)
    assert rows(items) == [("1", 4), ("2", 0), ("9", 0)] and rows(asleep) == [("3", 1)]
    assert rows(streaming.tried(asleep, 2)) == [("3", 2, changelog.PARKED)]


# The back-fill as a job.


def backfill_target(spark, df, key, buckets=8):
    path = new_folder(spark, "backfill")
    t = streaming.Table("t", lambda s: df, key, source_id="L")
    layers.create(df, path, t.identity(df.schema), buckets=buckets)
    return path, t


def test_a_killed_backfill_ends_like_one_run(spark):
    df = spark.range(1, 101).selectExpr("id", "concat('v', id) AS v", "IF(id % 4 = 0, 'B', NULL) AS sync_source_id", "IF(id % 4 = 0, concat('b', id), NULL) AS source_record_id")
    whole, t = backfill_target(spark, df, "id")
    backfill.run_backfill(spark, whole, "id", "L", t.identity, 20)
    killed, _ = backfill_target(spark, df, "id")
    assert backfill.progress(spark, {"t": (killed, "id")}, "L").first().status == "PENDING"
    backfill.run_backfill(spark, killed, "id", "L", t.identity, 20, most_ranges=2)
    half = backfill.progress(spark, {"t": (killed, "id")}, "L").first()
    assert (half.last_key, half.rows_labelled, half.status) == ("53", 40, "RUNNING")
    assert layers.read(spark, killed).where("sync_source_id = 'L'").count() == 40
    backfill.run_backfill(spark, killed, "id", "L", t.identity, 20)
    assert rows(layers.read(spark, killed)) == rows(layers.read(spark, whole)) and layers.read(spark, whole).where("sync_source_id IS NULL").count() == 0
    done = backfill.progress(spark, {"t": (killed, "id"), "u": (whole, "id")}, "L").collect()
    assert [(r.rows_labelled, r.status) for r in done] == [(75, "DONE"), (75, "DONE")]


def test_a_version_without_its_manifest_is_done_again(spark, monkeypatch):
    """The job dies after it has written a range and before that counts."""
    df = spark.range(1, 31).selectExpr("id", "CAST(NULL AS STRING) AS sync_source_id", "CAST(NULL AS STRING) AS source_record_id")
    path, t = backfill_target(spark, df, "id")
    real, calls = layers._commit, []

    def dies(*a):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        real(*a)

    monkeypatch.setattr(layers, "_commit", dies)
    with pytest.raises(RuntimeError):
        backfill.run_backfill(spark, path, "id", "L", t.identity, 10)
    monkeypatch.setattr(layers, "_commit", real)
    assert layers.read(spark, path).where("sync_source_id = 'L'").count() == 10
    backfill.run_backfill(spark, path, "id", "L", t.identity, 10)
    assert rows(layers.read(spark, path)) == sorted([(i, "L", str(i)) for i in range(1, 31)], key=str)


def test_text_keys_are_swept(spark):
    df = spark.createDataFrame([("a", None, None), (" b ", None, None), ("  ", None, None), (None, None, None), ("c", "B", "c")], "k string, sync_source_id string, source_record_id string")
    path, t = backfill_target(spark, df, "k")
    for _ in range(2):
        backfill.run_backfill(spark, path, "k", "L", t.identity, 2, most_ranges=1)
    backfill.run_backfill(spark, path, "k", "L", t.identity, 2)
    assert rows(layers.read(spark, path)) == sorted([("a", "L", "a"), (" b ", "L", "b"), ("  ", None, None), (None, None, None), ("c", "B", "c")], key=str)


# Parents, sources, changes.


def test_few_children_move_only_the_parents_they_name(spark):
    path = new_folder(spark, "parents")
    spark.range(2000).selectExpr("id + 10000 AS id", "'A' AS sync_source_id", "CAST(id AS STRING) AS source_record_id").write.parquet(path)
    parents, child = spark.read.parquet(path), spark.createDataFrame([(1, 7), (2, 7), (3, None), (4, 9999)], "k long, p long")
    for split in (lambda n: fk.remap_fks(child, {"p": parents}, [fk.Link("p", "p", "id")], "A", child_count=n), lambda n: fk.split_by_parent(child, {"p": parents.selectExpr("id - 10000 AS id")}, [fk.Link("p", "p", "id")], child_count=n)):
        few, many = split(4), split(None)
        assert rows(few[0]) == rows(many[0]) and rows(few[1]) == rows(many[1]) and len(rows(few[1])) == 1
        plan = few[0]._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"Aggregate \[_token_0(?s:.)*Join LeftSemi(?s:.)*Aggregate", plan)  # the parents go before their aggregate
        assert "LeftSemi" not in many[0]._jdf.queryExecution().optimizedPlan().toString()


def test_skewed_keys_are_read_evenly(spark, tmp_path):
    url = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    # Most keys lie close together, a few far off, and some rows have none.
    df = spark.range(4000).selectExpr("IF(id % 500 = 0, NULL, IF(id % 20 = 0, id * 1000000, id)) AS k", "id AS v").coalesce(1)
    df.write.format("jdbc").options(**url, dbtable="t").mode("overwrite").save()
    predicates = store.range_predicates(store.read_table(spark, url, "t").select("k"), "k", 8)
    read = store.read_table(spark, url, "t", predicates=predicates)
    sizes = sorted(r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == 4000 and read.distinct().count() == 4000 and len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    equal = store.read_table(spark, url, "t", split=("k", 0, 4_000_000_000, 8))
    assert max(r["count"] for r in equal.groupBy(F.spark_partition_id()).count().collect()) > 3000
    assert store.range_predicates(spark.range(0), "id", 8) == ["1 = 1"] and len(store.range_predicates(spark.range(9).selectExpr("5 AS id"), "id", 4)) == 2


def test_changes_are_fetched_once_and_wide_ones_are_not_broadcast(spark, monkeypatch):
    source, target, log = (new_folder(spark, x) for x in ("source", "target", "log"))
    spark.range(500).withColumn("v", F.lit("new")).write.parquet(source)
    spark.range(0, 1000, 2).withColumn("v", F.lit("old")).write.parquet(target)
    log_of(spark, [("t", str(i), "U") for i in range(0, 50)]).write.parquet(log)
    run = lambda: plans.apply_changes(spark.read.parquet(log), spark.read.parquet(source), spark.read.parquet(target), "t", "id", ["id"])
    merged = run()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert source not in plan and merged.where("_action = 'I'").count() == 25 and merged.where("_action = 'U'").count() == 25 and merged.count() == 525
    monkeypatch.setattr(merge, "BROADCAST_BYTES", 100)
    assert merge.size_of(spark.createDataFrame([("abc", 1)], "s string, n int")) == 3 + 2 * merge.VALUE_BYTES
    assert not merge.are_few(spark.createDataFrame([("x" * 200,)], "s string"), 1) and rows(run()) == rows(merged)
