"""In-line, pandas and generated rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def in_line(spark: SparkSession, rows: list, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema: str | None = None) -> DataFrame:
    return spark.createDataFrame(frame, schema)


def to_pandas(df: DataFrame, most: int) -> pd.DataFrame:
    """A small result as a pandas frame; a result of more than `most` rows is an error."""
    frame = df.limit(most + 1).toPandas()
    if len(frame) > most:
        raise ValueError(f"more than {most} rows: write the result to files instead")
    return frame


def random_ints(
    spark: SparkSession,
    name: str,
    low: int,
    high: int,
    rows: int | None = None,
    rows_per_second: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Whole numbers in [low, high]: `rows` of them, or an endless stream at a given pace."""
    value = F.floor(F.rand(seed) * (high - low + 1)) + low
    if rows is not None:
        return spark.range(rows).select(value.cast("bigint").alias(name))
    pace = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second or 1).load()
    return pace.select(value.cast("bigint").alias(name))
