"""Reading files and messages: each query stores rows of the tables in a format and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.scalars import message
from tidelog.plans.registry import EDGE_SQL, edge_message, query, table, without_zone
from tidelog.session import work_dir
from tidelog.sinks import files as sink
from tidelog.sources import files, messages
from tidelog.streaming import jobs


@query(
    "s3_text_lines",
    "SELECT line AS value, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) "
    "GROUP BY line",
)
def text_lines(spark, sf):
    path = work_dir(spark, "text")
    sink.write_text(table(spark, sf, "documents").select("text"), path)
    return files.text_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("s4_csv_files", "SELECT * FROM customer")
def csv_files(spark, sf):
    path = work_dir(spark, "csv")
    sink.write_csv(table(spark, sf, "customer"), path)
    return files.csv_rows(spark, path, _CUSTOMER)


@query("s5_json_files", "SELECT event_id, user_id, event_type, value FROM events")
def json_files(spark, sf):
    """Declares fewer fields than the files have."""
    path = work_dir(spark, "json")
    sink.write_json(table(spark, sf, "events"), path)
    return files.json_rows(spark, path, "event_id bigint, user_id bigint, event_type string, value double")


def _stored_messages(spark, sf):
    path = work_dir(spark, "messages")
    sink.write_text(edge_message(table(spark, sf, "events")).select("value"), path)
    return files.text_lines(spark, path, stream=True)


@query(
    "s6_message_stream",
    f"WITH {EDGE_SQL} SELECT stamp AS \"EdgeEndTimestamp\", url AS \"ClientRequestURI\", "
    "status AS \"EdgeResponseStatus\", org AS \"OrgUID\", day AS \"DateStr\", ts AS \"EventTime\" FROM edge",
)
def message_stream(spark, sf):
    logs = messages.edge_log(messages.raw_text(_stored_messages(spark, sf)))
    path = work_dir(spark, "logs")
    flat = logs.drop("ResponseHeaders")
    jobs.to_files(flat, path, f"{path}-checkpoint").awaitTermination()
    stored = spark.read.schema(flat.schema).parquet(path)
    return stored.select(
        "EdgeEndTimestamp", "ClientRequestURI", "EdgeResponseStatus", "OrgUID", "DateStr", *without_zone("EventTime")
    )


@query("s7_raw_messages", "SELECT 'Message: ' || event_type AS message, count(*) AS n FROM events GROUP BY 1")
def raw_messages(spark, sf):
    path = work_dir(spark, "raw")
    sink.write_text(sink.encode_string(table(spark, sf, "events"), "event_type"), path)
    shown = files.text_lines(spark, path, stream=True).select(message("value").alias("message"))
    out = work_dir(spark, "shown")
    jobs.to_files(shown, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.schema(shown.schema).parquet(out).groupBy("message").agg(F.count("*").alias("n"))


@query("s8_json_payloads", "SELECT * FROM customer")
def json_payloads(spark, sf):
    return messages.decode_json(sink.encode_json(table(spark, sf, "customer")), _CUSTOMER)


@query("s8_csv_payloads", "SELECT * FROM customer")
def csv_payloads(spark, sf):
    return messages.decode_csv(sink.encode_csv(table(spark, sf, "customer")), _CUSTOMER)


@query("e12_bounded_stream", "SELECT event_type, user_id, value FROM events")
def bounded_stream(spark, sf):
    """A stream that ends when the files there are have been read."""
    events = files.parquet_rows(spark, f"{sf}/events.parquet", stream=True).select("event_type", "user_id", "value")
    path = work_dir(spark, "bounded")
    jobs.to_files(events, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(events.schema).parquet(path)
