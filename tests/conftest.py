import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL, MEDIUM, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def cell(x):
    """One text for a value, however Spark and DuckDB hand it over."""
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return "NULL" if x != x else str(int(x)) if x.is_integer() else repr(x)
    return str(x)


def compare(spark, query, sql: str, sf_dir: str) -> None:
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = query(spark, sf_dir)
    found = con.sql(sql)
    names = sorted(df.columns)
    assert names == sorted(found.columns)
    at = {n: i for i, n in enumerate(found.columns)}
    ours = sorted(tuple(cell(r[n]) for n in names) for r in df.collect())
    theirs = sorted(tuple(cell(r[at[n]]) for n in names) for r in found.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
