"""User-defined functions: scalar, with per-worker setup, table functions and row maps.

Native expressions come first everywhere in this library; these are for code that
cannot be written as one. All of them exchange Arrow batches with Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scalar(function: Callable, result_type: str):
    """A Python function of one row's values as a column function."""
    return F.udf(function, result_type, useArrow=True)


def with_setup(setup: Callable[[], Callable[[pd.Series], pd.Series]], result_type: str, rows: int | None = None):
    """A column function whose `setup` runs once per Python worker task, e.g. to load a model.

    With `rows` it gets and hands on at most so many rows at a time, so that wide results of a whole batch are never
    held at once.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        function = setup()
        for batch in batches:
            step = rows or max(1, len(batch))
            for low in range(0, len(batch), step):
                yield function(batch.iloc[low : low + step])

    return F.pandas_udf(run, result_type)


@F.udtf(returnType="part string")
class SplitOn:
    """The pieces of a text between separators."""

    def eval(self, text: str, separator: str):
        if text is not None:
            for part in text.split(separator):
                yield (part,)


@F.udtf(returnType="org string, url string, status int")
class EdgeFields:
    """Organisation, URL and status of one JSON access log; nothing for bad JSON."""

    def eval(self, line: str):
        import json

        try:
            record = json.loads(line)
            yield (
                record["ResponseHeaders"]["x-org-uid"],
                record["ClientRequestURI"],
                record["EdgeResponseStatus"],
            )
        except (TypeError, ValueError, KeyError):
            return


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL."""
    spark.udf.register("text_length", scalar(lambda text: None if text is None else len(text), "int"))
    spark.udf.register(
        "contains_text",
        scalar(lambda text, part: None if text is None else part in text, "boolean"),
    )
    spark.udtf.register("split_on", SplitOn)
    spark.udtf.register("edge_fields", EdgeFields)


def map_rows(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a pandas function to batches of rows; also for zero or many rows out per row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)
