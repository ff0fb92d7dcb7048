"""Projections, filters, column operators and record validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.scalars import json_value
from tidelog.operators import columns as c
from tidelog.operators import relational as r
from tidelog.operators.validate import check_records, reject_counts, split_records
from tidelog.plans.registry import EDGE_SQL, edge_logs, edge_message, query, table, without_zone
from tidelog.session import work_dir
from tidelog.sources.files import batch_bytes, parquet_rows, rows_per_file
from tidelog.streaming import jobs


@query("p1_select_rename", "SELECT o_orderkey AS order_id, o_totalprice * 2 AS doubled FROM orders")
def select_rename(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(F.col("o_orderkey").alias("order_id"), (F.col("o_totalprice") * 2).alias("doubled"))


@query("p1_rename_all", "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation")
def rename_all(spark, sf):
    return c.rename_all(table(spark, sf, "nation"), "id", "name", "region")


@query(
    "p2_add_columns",
    "SELECT event_id, props, json_extract_string(props, '$.k') AS k, event_id + 1 AS following FROM events",
)
def add_columns(spark, sf):
    events = table(spark, sf, "events").select("event_id", "props")
    return c.add_columns(
        events, {"k": json_value("props", "$.k"), "following": F.col("event_id") + 1}
    )


@query("p3_drop_columns", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_columns(spark, sf):
    return c.drop_columns(table(spark, sf, "customer"), "c_acctbal", "c_mktsegment")


@query(
    "p4_rename_columns",
    "SELECT s_suppkey AS id, s_name AS supplier, s_nationkey, s_acctbal FROM supplier",
)
def rename_columns(spark, sf):
    return c.rename_columns(table(spark, sf, "supplier"), {"s_suppkey": "id", "s_name": "supplier"})


@query(
    "p5_add_or_replace",
    "SELECT CAST(p_partkey AS VARCHAR) || '_' || p_name AS p_partkey, p_name, p_brand, p_type, p_size, "
    "p_retailprice FROM part",
)
def add_or_replace(spark, sf):
    joined = F.concat(F.col("p_partkey").cast("string"), F.lit("_"), "p_name")
    return c.add_or_replace_columns(table(spark, sf, "part"), {"p_partkey": joined})


@query("p6_filter", "SELECT * FROM customer WHERE c_nationkey <> 3")
def filter_rows(spark, sf):
    return table(spark, sf, "customer").filter(F.col("c_nationkey") != 3)


@query("p7_filter_contains", "SELECT doc_id, lang FROM documents WHERE contains(text, 'the')")
def filter_contains(spark, sf):
    return table(spark, sf, "documents").filter(F.col("text").contains("the")).select("doc_id", "lang")


@query("p8_select_all", "SELECT * FROM supplier")
def select_all(spark, sf):
    return c.select_all_sql(table(spark, sf, "supplier"))


@query("p9_literal", "SELECT event_id, 'seen' AS mark, 1 AS one FROM events")
def literal(spark, sf):
    return table(spark, sf, "events").select("event_id", F.lit("seen").alias("mark"), F.lit(1).alias("one"))


def _gappy_logs(spark, sf):
    """Logs in which error events have no organisation in their headers."""
    org = F.when(F.col("event_type") != "error", F.col("user_id").cast("string"))
    headers = F.struct(org.alias("x-org-uid"))
    return table(spark, sf, "events").select("event_id", headers.alias("ResponseHeaders"))


@query(
    "p10_nested_default",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) ELSE '' END AS org FROM events",
)
def nested_default(spark, sf):
    return _gappy_logs(spark, sf).select(
        "event_id", c.nested_field("ResponseHeaders", "x-org-uid", "").alias("org")
    )


@query(
    "p11_computed_columns",
    f"WITH {EDGE_SQL} SELECT event_id, org AS OrgUID, day AS DateStr, ts AS EventTime FROM edge",
)
def computed_columns(spark, sf):
    return edge_logs(spark, sf).select("event_id", "OrgUID", "DateStr", *without_zone("EventTime"))


@query("p12_temp_view", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def temp_view(spark, sf):
    c.temporary_view(table(spark, sf, "events"), "tidelog_logs")
    counted = spark.sql("SELECT event_type, count(*) AS n FROM tidelog_logs GROUP BY event_type")
    c.drop_view(spark, "tidelog_logs")
    return counted


def _mixed_messages(spark, sf):
    """Log lines of which some kinds of events break a rule."""
    return table(spark, sf, "events").withColumn(
        "value",
        F.when(F.col("event_type") == "view", F.concat(F.lit('{"EdgeEndTimestamp": "t", "EdgeResponseStatus": 1}')))
        .when(
            F.col("event_type") == "click",
            F.concat(
                F.lit('{"EdgeEndTimestamp": "t", "ClientRequestURI": "/u", "EdgeResponseStatus": "'),
                F.col("user_id").cast("string"),
                F.lit('", "ResponseHeaders": {"x-org-uid": "o"}}'),
            ),
        )
        .when(
            F.col("event_type") == "error",
            F.concat(
                F.lit('{"EdgeEndTimestamp": "t", "ClientRequestURI": "/u", "EdgeResponseStatus": true, '),
                F.lit('"ResponseHeaders": {"x-org-uid": "'),
                F.col("user_id").cast("string"),
                F.lit('"}}'),
            ),
        )
        .when(F.col("event_type") == "signup", F.lit("not json"))
        .otherwise(
            F.concat(
                F.lit('{"EdgeEndTimestamp": "t", "ClientRequestURI": "/u", "EdgeResponseStatus": 200, '),
                F.lit('"ResponseHeaders": {"x-org-uid": '),
                F.when(F.col("user_id") % 2 == 0, F.lit('"even"')).otherwise(F.lit("7")),
                F.lit("}}"),
            )
        ),
    )


_REASON_SQL = """
CASE event_type WHEN 'view' THEN 'ClientRequestURI' WHEN 'click' THEN 'EdgeResponseStatus'
  WHEN 'error' THEN NULL WHEN 'signup' THEN 'record'
  ELSE CASE WHEN user_id % 2 = 0 THEN NULL ELSE 'x-org-uid' END END
"""


@query("p13_validate", f"SELECT event_id, {_REASON_SQL} AS reject_reason FROM events")
def validate(spark, sf):
    return check_records(_mixed_messages(spark, sf)).select("event_id", "reject_reason")


@query("p13_valid_rows", f"SELECT event_id FROM events WHERE ({_REASON_SQL}) IS NULL")
def valid_rows(spark, sf):
    return split_records(_mixed_messages(spark, sf))[0].select("event_id")


@query(
    "p13_reject_counts",
    f"SELECT coalesce({_REASON_SQL}, 'ok') AS reason, count(*) AS records FROM events GROUP BY 1",
)
def rejects(spark, sf):
    return reject_counts(_mixed_messages(spark, sf))


@query(
    "p13_stream_reject_counts",
    f"""
    WITH found AS (SELECT coalesce({_REASON_SQL}, 'ok') AS reason FROM events)
    SELECT reason, count(*) AS records, count_if(reason = 'ok') AS written FROM found GROUP BY 1
    """,
)
def stream_rejects(spark, sf):
    """A stream that keeps the good records and the number of those that each reason stopped."""
    arrivals, good, counts = (work_dir(spark, name) for name in ("arrivals", "good", "counts"))
    messages = _mixed_messages(spark, sf)
    messages.write.option("maxRecordsPerFile", rows_per_file(messages, 1_000)).parquet(arrivals)
    records = parquet_rows(spark, arrivals, stream=True, bytes_per_batch=batch_bytes(spark, arrivals, 64_000))
    jobs.validated(records, good, counts, f"{good}-checkpoint").awaitTermination()
    totals = spark.read.schema("reason string, records bigint").parquet(counts)
    totals = totals.groupBy("reason").agg(F.sum("records").alias("records"))
    written = spark.read.schema("event_id bigint").parquet(good).agg(F.count("*").alias("n")).first()["n"]
    return totals.withColumn("written", F.when(F.col("reason") == "ok", written).otherwise(0).cast("bigint"))


@query(
    "p14_flatten_field",
    f"WITH {EDGE_SQL} SELECT event_id, url AS ClientRequestURI, org AS x_org_uid FROM edge",
)
def flatten(spark, sf):
    flat = c.flatten_field(edge_logs(spark, sf), "ResponseHeaders", "x-org-uid", "x_org_uid")
    return flat.select("event_id", "ClientRequestURI", "x_org_uid")


@query(
    "p16_parse_json",
    f"WITH {EDGE_SQL} SELECT event_id, stamp AS \"EdgeEndTimestamp\", status AS \"EdgeResponseStatus\", "
    "org FROM edge",
)
def parse(spark, sf):
    lines = edge_message(table(spark, sf, "events"))
    schema = "EdgeEndTimestamp string, EdgeResponseStatus int, ResponseHeaders struct<`x-org-uid`: string>"
    return c.parse_json(lines, "value", schema).select(
        "event_id",
        "EdgeEndTimestamp",
        "EdgeResponseStatus",
        c.nested_field("ResponseHeaders", "x-org-uid").alias("org"),
    )


@query("p17_key_from_nested", f"WITH {EDGE_SQL} SELECT org, count(*) AS n FROM edge GROUP BY org")
def nested_key(spark, sf):
    key = c.nested_field("ResponseHeaders", "x-org-uid").alias("org")
    return r.group(edge_logs(spark, sf), [key], {"n": F.count("*")})

