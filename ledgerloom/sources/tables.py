"""Reading source tables and writing versioned snapshots of targets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.folders import children, read_text, remove, write_text


def read_table(spark: SparkSession, src: str | dict, table: str, drop: tuple[str, ...] = (), split: tuple[str, int, int, int] | None = None, predicates: list[str] | None = None) -> DataFrame:
    """S1. A source table without its row-version columns.

    `src` is a folder of Parquet tables, or JDBC options. `split` (column, low, high, partitions) makes
    JDBC read in parallel by equal ranges of a numeric column, `predicates` (`range_predicates`) by ranges of equal size.
    """
    if isinstance(src, str):
        df = spark.read.parquet(f"{src}/{table}.parquet")
    elif predicates:
        rest = {k: v for k, v in src.items() if k != "url"}
        df = spark.read.jdbc(src["url"], table, predicates=predicates, properties=rest)
    else:
        reader = spark.read.format("jdbc").options(**src).option("dbtable", table)
        if split:
            for name, value in zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), split):
                reader = reader.option(name, value)
        df = reader.load()
    unwanted = {d.lower() for d in drop}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in unwanted))


def range_predicates(keys: DataFrame, column: str, partitions: int, accuracy: int = 10_000, quote: str = '"') -> list[str]:
    """S1. Conditions that cut a table into about `partitions` ranges of equally many rows, however skewed the values of its whole-number column.

    `keys` is the table or only its column: bounds are quantiles of it, by one aggregate whose size does not
    grow with the table. A value that fills several ranges makes one. Rows without a value are in the first.
    `quote` is what the database puts around names.
    """
    name = f"{quote}{column}{quote}"
    shares = [i / partitions for i in range(1, partitions)]
    found = keys.agg(F.percentile_approx(column, shares, accuracy).alias("b")).first().b if shares else []
    bounds = sorted({int(b) for b in found or []})
    if not bounds:
        return ["1 = 1"]
    inner = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{name} <= {bounds[0]} OR {name} IS NULL", *inner, f"{name} > {bounds[-1]}"]


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions of a table: those whose pointer is written. Pointers are told by name; none is read."""
    return sorted(int(name.split("=")[1]) for name in children(spark, f"{path}/pointer") if name.startswith("version=") and ".draft" not in name)


def current_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The latest complete version (below `before`)."""
    return max((v for v in versions(spark, path) if before is None or v < before), default=None)


def write_snapshot(df: DataFrame, path: str, version: int) -> str:
    """S5. A new version of a whole table. Readers see it only once its pointer is written, which comes last."""
    where = f"{path}/version={version}"
    df.write.mode("overwrite").parquet(where)
    commit_snapshot(df, path, version)
    return where


def commit_snapshot(df: DataFrame, path: str, version: int) -> None:
    """Writes the pointer of a version whose rows, with the schema of `df`, are in place."""
    write_text(df.sparkSession, f"{path}/pointer/version={version}", df.schema.json())


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    version = current_version(spark, path) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no version of {path} is complete")
    kind = T.StructType.fromJson(json.loads(read_text(spark, f"{path}/pointer/version={version}")))
    return spark.read.schema(kind).parquet(f"{path}/version={version}")


def drop_snapshots(spark: SparkSession, path: str, keep: int) -> None:
    """Removes all but the last `keep` versions of a table of snapshots."""
    for v in versions(spark, path)[:-keep]:
        remove(spark, f"{path}/pointer/version={v}")
        remove(spark, f"{path}/version={v}")
