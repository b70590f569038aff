"""Every query of the table-sync operators against its SQL twin."""

from pathlib import Path

import pytest

from conftest import SMALL, compare
from ledgerloom.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, name):
    assert name in registry.ORACLES
    compare(spark, registry.QUERIES[name], registry.ORACLES[name], SMALL)


def test_marks_of_keys_whose_deletes_and_updates_lie_in_different_files(spark, tmp_path):
    """As where a larger log is cut: a waiting order for every pair of files, its deletes in one, its updates in the other."""
    import duckdb

    con, small, made = duckdb.connect(), Path(SMALL), {"orders", "events"}
    for table in small.glob("*.parquet"):
        if table.stem not in made:
            (tmp_path / table.name).symlink_to(table)
    con.execute(f"COPY (SELECT * REPLACE (CAST(10 AS BIGINT) AS o_custkey) FROM '{SMALL}/orders.parquet' WHERE o_orderkey < 9) TO '{tmp_path}/orders.parquet'")
    # Log rows are cut into thirds; key 3 * i + j has its deletes in the middle of third i, its updates in that of j.
    cases = " ".join(f"WHEN t = {t} AND s = {s} THEN {k}" for t in range(3) for s, k in enumerate((3 * t + (t + 1) % 3, 3 * t + (t + 2) % 3, 3 * ((t + 1) % 3) + t, 3 * ((t + 2) % 3) + t)))
    numbered = "SELECT i, i // 300 AS t, CASE WHEN i % 300 BETWEEN 100 AND 199 THEN i // 4 % 4 END AS s FROM range(900) r(i)"
    con.execute(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i) AS ts, CAST(CASE {cases} ELSE 1000000 + i END AS BIGINT) AS user_id,
        CASE WHEN s < 2 THEN 'error' ELSE 'view' END AS event_type, 0.0::DOUBLE AS value, '' AS props FROM ({numbered})) TO '{tmp_path}/events.parquet'""")
    compare(spark, registry.QUERIES["st3_marked_log"], registry.ORACLES["st3_marked_log"], str(tmp_path))


def test_comparison_notices_differences(spark):
    with pytest.raises(AssertionError):
        compare(spark, registry.QUERIES["p3_clip_strings"], registry.ORACLES["p3_clip_strings"].replace("1, 6", "1, 5"), SMALL)


def test_entry_module():
    import __spark_entry__

    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
