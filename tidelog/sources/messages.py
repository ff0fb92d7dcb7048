"""Messages of a log: reading them and decoding their payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.scalars import iso_date, iso_timestamp
from tidelog.operators.columns import fields_of, nested_field

# The fields of an edge access log that the jobs read.
EDGE_LOG = """
    EdgeEndTimestamp string, ClientRequestURI string, EdgeResponseStatus int,
    ResponseHeaders struct<`x-org-uid`: string>
"""

# A log whose record is JSON text inside a JSON message.
WRAPPED_LOG = "log_format string, log_line string"


def message_log(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: str = "earliest",
    stream: bool = True,
    per_batch: int | None = None,
) -> DataFrame:
    """Raw messages of a Kafka topic as `value` text; needs Spark's Kafka package.

    `start` (earliest or latest) holds for the first run; later ones go on from the
    query's checkpoint. `per_batch` bounds the messages of one micro-batch.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    reader = spark.readStream if stream else spark.read
    return raw_text(reader.format("kafka").options(**options).load())


def raw_text(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("value").cast("string").alias("value"))


_UNREAD = "_unread"


def decode_json(messages: DataFrame, schema: str, column: str = "value", bad: str = "drop") -> DataFrame:
    """The fields of JSON payloads; unknown keys are ignored, missing ones NULL.

    `bad` says what becomes of a NULL message and of one that is no JSON object of this schema:
    "drop", "fail" or "keep", which leaves the fields that could not be read NULL.
    """
    if bad not in ("drop", "keep", "fail"):
        raise ValueError(f"bad must be drop, keep or fail, not {bad}")
    if bad == "keep":
        return messages.select(fields_of(F.from_json(F.col(column), schema)))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREAD}
    parsed = F.from_json(F.col(column), f"{schema}, {_UNREAD} string", options)
    read = messages.select(fields_of(parsed), F.col(column).alias("_message"))
    empty = F.trim("_message") == ""  # no record, and not marked as unread
    wrong = F.col("_message").isNull() | empty | F.col(_UNREAD).isNotNull()
    if bad == "fail":
        read = read.filter(F.when(wrong, F.raise_error(F.concat(F.lit("unreadable message: "), "_message"))).isNull())
    else:
        read = read.filter(~wrong)
    return read.drop(_UNREAD, "_message")


def decode_csv(messages: DataFrame, schema: str, column: str = "value") -> DataFrame:
    return messages.select(fields_of(F.from_csv(F.col(column), schema)))


def decode_avro(messages: DataFrame, schema_json: str, column: str = "value") -> DataFrame:
    """Avro payloads; needs Spark's Avro package."""
    from pyspark.sql.avro.functions import from_avro

    return messages.select(fields_of(from_avro(F.col(column), schema_json)))


def edge_log(messages: DataFrame, column: str = "value", bad: str = "drop") -> DataFrame:
    """Decoded access logs with the computed columns OrgUID, DateStr and EventTime."""
    return with_edge_columns(decode_json(messages, EDGE_LOG, column, bad))


def with_edge_columns(logs: DataFrame) -> DataFrame:
    return logs.withColumns(
        {
            "OrgUID": nested_field("ResponseHeaders", "x-org-uid"),
            "DateStr": iso_date("EdgeEndTimestamp"),
            "EventTime": iso_timestamp("EdgeEndTimestamp", millis=False),
        }
    )
