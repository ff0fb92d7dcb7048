"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import scalars as s
from tidelog.plans.registry import query, table, without_zone


def _events(spark, sf, *columns):
    return table(spark, sf, "events").select("event_id", *columns)


@query(
    "f1_json_value",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS missing, "
    "CAST(user_id AS VARCHAR) AS nested, NULL::VARCHAR AS whole_object FROM events",
)
def json_value(spark, sf):
    wrapped = F.concat(
        F.lit('{"a": {"b": "'), F.col("user_id").cast("string"), F.lit('"}, "p": '), "props", F.lit("}")
    )
    return _events(spark, sf, "props", wrapped.alias("wrapped")).select(
        "event_id",
        s.json_value("props", "$.k").alias("k"),
        s.json_value("props", "$.nothing").alias("missing"),
        s.json_value("wrapped", "$.a.b").alias("nested"),
        s.json_value("wrapped", "$.p").alias("whole_object"),
    )


@query(
    "f2_change_json_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS k FROM events",
)
def change_json_field(spark, sf):
    changed = s.with_json_field("props", "k bigint", "k", lambda k: k + 1)
    return _events(spark, sf, changed.alias("props")).select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")
    )


@query(
    "f3_cast",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS text, TRY_CAST(event_type AS BIGINT) AS dirty, "
    "CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS back FROM events",
)
def cast(spark, sf):
    return _events(spark, sf, "user_id", "event_type").select(
        "event_id",
        F.col("user_id").cast("string").alias("text"),
        F.col("event_type").try_cast("bigint").alias("dirty"),
        F.col("user_id").cast("string").cast("bigint").alias("back"),
    )


@query("f4_concat", "SELECT event_id, CAST(event_id AS VARCHAR) || '_' || event_type AS joined FROM events")
def concat(spark, sf):
    return _events(
        spark, sf, F.concat(F.col("event_id").cast("string"), F.lit("_"), "event_type").alias("joined")
    )


@query("f5_abs_mod", "SELECT event_id, abs((user_id - 75) % 10) AS rest FROM events")
def abs_mod(spark, sf):
    return _events(spark, sf, s.abs_mod(F.col("user_id") - 75, 10).alias("rest"))


@query("f6_add_length", "SELECT event_id, event_id + user_id AS added, CAST(length(event_type) AS INTEGER) AS size FROM events")
def add_length(spark, sf):
    added = (F.col("event_id") + F.col("user_id")).alias("added")
    return _events(spark, sf, added, F.length("event_type").alias("size"))


@query(
    "f7_split",
    f"SELECT doc_id, CAST(len([w FOR w IN regexp_split_to_array(text, '{s.WHITESPACE}') IF w <> '']) AS INTEGER) AS words, "
    "CAST(len(string_split(text, 'e')) AS INTEGER) AS pieces FROM documents",
)
def split(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.size(s.words("text")).alias("words"), F.size(F.split("text", "e", -1)).alias("pieces")
    )


@query("f8_message", "SELECT event_id, 'Message: ' || event_type AS message FROM events")
def message(spark, sf):
    return _events(spark, sf, s.message("event_type").alias("message"))


def _stamps():
    """Each kind of event writes its time in another form."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return (
        F.when(F.col("event_type") == "view", F.concat(stamp, F.lit("Z")))
        .when(F.col("event_type") == "click", stamp)
        .when(F.col("event_type") == "error", F.concat(stamp, F.lit("-05:00")))
        .when(F.col("event_type") == "signup", F.lit("no time"))
    )


@query(
    "f9_iso_timestamp",
    """
    SELECT event_id, date_trunc('millisecond', t) AS cut, t AS full_time FROM (SELECT event_id,
      CASE WHEN event_type IN ('view', 'click') THEN ts WHEN event_type = 'error' THEN ts + INTERVAL 5 HOUR END AS t
      FROM events)
    """,
)
def iso_timestamp(spark, sf):
    stamped = _events(spark, sf, _stamps().alias("stamp")).withColumns(
        {"cut": s.iso_timestamp("stamp"), "full_time": s.iso_timestamp("stamp", millis=False)}
    )
    return stamped.select("event_id", *without_zone("cut", "full_time"))


@query(
    "f10_iso_date",
    "SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'error') THEN strftime(ts, '%Y-%m-%d') END AS day "
    "FROM events",
)
def iso_date(spark, sf):
    return _events(spark, sf, s.iso_date(_stamps()).alias("day"))


@query("f11_utc_millis", "SELECT event_id, epoch_ms(date_trunc('second', ts)) AS ms FROM events")
def utc_millis(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _events(spark, sf, s.utc_millis(stamp).alias("ms"))


@query(
    "f12_document_id",
    """
    SELECT page_id, 'org1_2025-05-20_' || translate(url, '/?&', '___') AS doc_id,
      'org1_2025-05-20_10-00-00_' || translate(url, '/?&', '___') AS window_doc_id FROM pages
    """,
)
def document_id(spark, sf):
    start = F.lit("2025-05-20 10:00:00").cast("timestamp_ntz")
    return table(spark, sf, "pages").select(
        "page_id",
        s.document_id(F.lit("org1"), F.lit("2025-05-20"), "url").alias("doc_id"),
        s.window_document_id(F.lit("org1"), start, "url").alias("window_doc_id"),
    )


@query("f13_sha256", "SELECT page_id, sha256(url) AS item FROM pages")
def sha256(spark, sf):
    return table(spark, sf, "pages").select("page_id", s.sha256("url").alias("item"))


@query("f14_row_ids", "SELECT count(*) AS n, count(*) AS ids, count(*) AS timed FROM events")
def row_ids(spark, sf):
    marked = _events(spark, sf, s.row_id().alias("id"), F.current_timestamp().alias("at"))
    return marked.agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.count("at").alias("timed")
    )


_WORDS = ("zero", "one", "two", "three", "four")


@query(
    "f16_lookup",
    "SELECT event_id, (['zero', 'one', 'two', 'three', 'four'])[user_id % 7 + 1] AS word FROM events",
)
def lookup(spark, sf):
    return _events(spark, sf, s.lookup(F.col("user_id") % 7, _WORDS).alias("word"))


@query(
    "f17_collapse_blank_lines",
    r"SELECT doc_id, md5(regexp_replace(replace(text, '. ', chr(10) || chr(10)), '\n{2,}', chr(10), 'g')) AS digest "
    "FROM documents",
)
def collapse_blank_lines(spark, sf):
    spaced = F.replace("text", F.lit(". "), F.lit("\n\n"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(s.collapse_blank_lines(spaced)).alias("digest")
    )


@query("e1_event_time", "SELECT event_id, date_trunc('millisecond', ts) AS event_time FROM events")
def event_time(spark, sf):
    millis = _events(spark, sf, F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return millis.withColumn("event_time", s.event_time_from_millis("ms")).select(
        "event_id", *without_zone("event_time")
    )
