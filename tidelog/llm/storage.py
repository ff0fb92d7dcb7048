"""Intermediate tables in the folder that all executors share, and small files beside them."""

from __future__ import annotations

from contextlib import contextmanager
from typing import NamedTuple

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from tidelog.session import work_dir

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stored(NamedTuple):
    """A table that was written: `rows` reads it, `drop` deletes its files."""

    rows: DataFrame
    path: str

    def drop(self) -> None:
        spark = self.rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffle_files_removed(spark: SparkSession):
    """Inside, the shuffle files of an action go when the action has ended."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)


def store(df: DataFrame, name: str) -> Stored:
    """Write `df` to the shared folder once; every later use reads the same rows."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    with shuffle_files_removed(spark):
        df.write.parquet(path)
    return Stored(spark.read.schema(df.schema).parquet(path), path)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's name in it; usable inside tasks."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path.replace("file:/", "file:///") if path.startswith("file:/") and not path.startswith("file://") else path)
    return pafs.LocalFileSystem(), path
