"""Registration of queries, and the input frames they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.columns import parse_json
from tidelog.session import configure
from tidelog.sources.messages import EDGE_LOG, with_edge_columns

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, folder of the tables) -> DataFrame under `name`."""

    def add(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def edge_message(events: DataFrame) -> DataFrame:
    """(event_id, value): each event as the JSON line of an edge access log."""
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("EdgeEndTimestamp"),
        F.concat(F.lit("/v3/"), "event_type").alias("ClientRequestURI"),
        F.get_json_object("props", "$.k").cast("int").alias("EdgeResponseStatus"),
        F.struct((F.col("user_id") % 10).cast("string").alias("x-org-uid")).alias("ResponseHeaders"),
    )
    return events.select("event_id", F.to_json(record).alias("value"))


def edge_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events decoded from their JSON lines, with the computed columns."""
    return with_edge_columns(parse_json(edge_message(table(spark, sf_dir, "events")), "value", EDGE_LOG))


def without_zone(*names: str) -> list:
    """Points in time as UTC wall time, the form the SQL checks use."""
    return [F.col(n).cast("timestamp_ntz").alias(n) for n in names]


# the same rows in SQL
EDGE_SQL = """
edge AS (
  SELECT event_id, ts, CAST(user_id % 10 AS VARCHAR) AS org, '/v3/' || event_type AS url,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS status,
         strftime(ts, '%Y-%m-%d') AS day,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS stamp
  FROM events)
"""
EPOCH = "TIMESTAMP '1970-01-01'"
