"""File sinks and the documents written to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.relational import latest_per_key


def write_text(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Rows as text lines: the one string column of `df`, in files of bounded length."""
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.text(path)


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)


def write_report(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header line; in one file, for a result known to be small, or in as many as Spark makes."""
    write_csv(df.repartition(1) if one_file else df, path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_by_index(df: DataFrame, path: str, index: str) -> None:
    """One folder per value of `index`.

    The rebalance hint gathers small indexes into few files and splits large ones.
    """
    df.hint("rebalance", index).write.mode("overwrite").partitionBy(index).parquet(path)


def static_index(df: DataFrame, name: str) -> DataFrame:
    """Send all rows to one index."""
    return df.withColumn("_index", F.lit(name))


def dynamic_index(df: DataFrame, field: str) -> DataFrame:
    """Send each row to the index named in one of its fields."""
    return df.withColumn("_index", F.col(field).cast("string"))


def insert_into(df: DataFrame, table: str) -> None:
    """Append to a declared table, by column name."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def newest_documents(df: DataFrame, id_column: str, sequence: Sequence[str]) -> DataFrame:
    """What a flush sends: the newest version of each document."""
    return latest_per_key(df, [id_column], sequence)


def documents(df: DataFrame, *columns: str | Column) -> DataFrame:
    """One JSON document per row in `value`; times as ISO text."""
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def iso_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


def upsert_actions(df: DataFrame, index: str | Column, doc_id: str, columns: Sequence[str]) -> DataFrame:
    """Bulk upsert lines in `value`: per row the action line, then the document line."""
    index = F.lit(index) if isinstance(index, str) else index
    action = F.struct(F.struct(index.alias("_index"), F.col(doc_id).alias("_id")).alias("update"))
    body = F.struct(F.struct(*columns).alias("doc"), F.lit(True).alias("doc_as_upsert"))
    # one value with both lines, so that no task boundary can part them
    lines = F.concat_ws("\n", F.to_json(action), F.to_json(body))
    return df.select(lines.alias("value"))


def encode_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def encode_csv(df: DataFrame) -> DataFrame:
    return df.select(F.to_csv(F.struct(*df.columns)).alias("value"))


def encode_avro(df: DataFrame, schema_json: str | None = None) -> DataFrame:
    """Avro payloads; needs Spark's Avro package."""
    from pyspark.sql.avro.functions import to_avro

    return df.select(to_avro(F.struct(*df.columns), schema_json or "").alias("value"))


def encode_string(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("string").alias("value"))


def write_branches(branches: dict[str, DataFrame]) -> None:
    """Write several results, each to its own folder.

    Every branch reads its input anew with its own filters and columns pushed into the
    scan, which is cheaper than keeping a large shared input somewhere.
    """
    for path, branch in branches.items():
        branch.write.mode("overwrite").parquet(path)
