"""Folders that driver and executors share, and the small files in them that the driver reads and writes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`.

    A local session without one (as in tests) gets a temporary folder of its own. On a cluster there is
    no folder that all executors see unless the setting names one, so its absence is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """`df` written in the shared folder (or in `folder`, which its owner removes) and read back; its lineage ends there."""
    path = f"{folder}/{label}-{uuid.uuid4().hex}" if folder else new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    fs, where = _at(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.mkdirs(where)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or folder with all that is in it, if it is there."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, seen whole or not at all: written beside its place and moved there."""
    fs, where = _at(spark, path)
    _, draft = _at(spark, f"{path}.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    fs.delete(where, False)
    if not fs.rename(draft, where):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
