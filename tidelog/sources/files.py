"""Text, CSV and JSON files with declared schemas.

A stream reads all that is there as one micro-batch, or up to a number of files or bytes at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: micro-batches that a folder is read in by `batch_bytes`, as long as none gets larger than this
BATCHES, MOST_BATCH_BYTES = 32, 1 << 26


def _reader(spark: SparkSession, stream: bool, files_per_batch: int | None, bytes_per_batch: int | None = None):
    if not stream:
        return spark.read
    reader = spark.readStream
    if bytes_per_batch:
        # as many files as fit; one that is larger comes alone
        return reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def batch_bytes(spark: SparkSession, path: str, least: int, batches: int = BATCHES, most: int = MOST_BATCH_BYTES) -> int:
    """The bytes of a micro-batch for what lies in a folder, between `least` and `most`.

    A micro-batch costs about a second whatever it holds, so a large folder is read in about `batches` of them
    and not in ever more of the same small size; beyond `batches` times `most` their number grows with the folder.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return max(least, min(held // batches, most))


def rows_per_file(df: DataFrame, least: int, batches: int = BATCHES, most: int = 1 << 20) -> int:
    """Rows of a file with which several files fit into each of `batches` micro-batches."""
    return max(least, min(df.count() // (4 * batches), most))


def text_lines(
    spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """One row per line, column `value`."""
    return _reader(spark, stream, files_per_batch, bytes_per_batch).option("lineSep", "\n").text(path)


def csv_rows(
    spark: SparkSession,
    path: str,
    schema: str,
    stream: bool = False,
    header: bool = False,
    files_per_batch: int | None = None, bytes_per_batch: int | None = None,
) -> DataFrame:
    return _reader(spark, stream, files_per_batch, bytes_per_batch).schema(schema).option("header", header).csv(path)


def json_rows(
    spark: SparkSession, path: str, schema: str, stream: bool = False, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """One row per JSON line; keys that the schema does not name are ignored."""
    return _reader(spark, stream, files_per_batch, bytes_per_batch).schema(schema).json(path)


def parquet_rows(
    spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    if not stream:
        return spark.read.parquet(path)
    reader = _reader(spark, True, files_per_batch, bytes_per_batch).schema(spark.read.parquet(path).schema)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(hadoop_path).isDirectory():
        return reader.parquet(path)
    # a stream reads folders: name the one file of its folder
    return reader.option("pathGlobFilter", hadoop_path.getName()).parquet(hadoop_path.getParent().toString())
