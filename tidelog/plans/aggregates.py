"""Grouped aggregates, running aggregates, top-n."""

from __future__ import annotations

import operator

from pyspark.sql import functions as F

from tidelog.functions.scalars import WHITESPACE
from tidelog.operators import folds, ordered
from tidelog.operators import relational as r
from tidelog.plans.registry import EDGE_SQL, edge_logs, query, table, without_zone

# Part of the rows one task may hold of a key in the queries on hot keys. Each event type has a
# larger part, so that its work is cut into slices at every size of the tables.
TASK_PART = 20


def few_rows(spark, sf) -> int:
    return max(1, table(spark, sf, "events").count() // TASK_PART)


@query(
    "a1_count_max",
    "SELECT c_mktsegment, count(c_custkey) AS n, max(CAST(c_acctbal AS BIGINT)) AS top "
    "FROM (SELECT c_mktsegment, c_custkey, trunc(c_acctbal) AS c_acctbal FROM customer) GROUP BY 1",
)
def count_max(spark, sf):
    aggregates = {"n": F.count("c_custkey"), "top": F.max(F.col("c_acctbal").cast("bigint"))}
    return r.group(table(spark, sf, "customer"), ["c_mktsegment"], aggregates)


@query("a2_url_count", f"WITH {EDGE_SQL} SELECT org AS OrgUID, url AS \"ClientRequestURI\", count(*) AS url_count FROM edge GROUP BY 1, 2")
def url_count(spark, sf):
    return r.count_rows(edge_logs(spark, sf), ["OrgUID", "ClientRequestURI"], "url_count")


@query(
    "a3_status_count",
    f"WITH {EDGE_SQL} SELECT org AS OrgUID, nullif(status, 0) AS status, count(nullif(status, 0)) AS status_count "
    "FROM edge GROUP BY 1, 2",
)
def status_count(spark, sf):
    logs = edge_logs(spark, sf).withColumn(
        "status", F.when(F.col("EdgeResponseStatus") != 0, F.col("EdgeResponseStatus"))
    )
    return r.count_values(logs, ["OrgUID", "status"], "status", "status_count")


@query(
    "a4_org_day_url",
    f"WITH {EDGE_SQL} SELECT org AS \"OrgUID\", day AS \"DateStr\", url AS \"ClientRequestURI\", count(url) AS n "
    "FROM edge GROUP BY 1, 2, 3",
)
def org_day_url(spark, sf):
    keys = ["OrgUID", "DateStr", "ClientRequestURI"]
    return r.count_values(edge_logs(spark, sf), keys, "ClientRequestURI", "n")


@query(
    "a5_org_day_status",
    f"WITH {EDGE_SQL} SELECT org AS \"OrgUID\", day AS \"DateStr\", status AS \"EdgeResponseStatus\", "
    "count(status) AS n FROM edge GROUP BY 1, 2, 3",
)
def org_day_status(spark, sf):
    keys = ["OrgUID", "DateStr", "EdgeResponseStatus"]
    return r.count_values(edge_logs(spark, sf), keys, "EdgeResponseStatus", "n")


@query(
    "a6_org_day_total",
    f"WITH {EDGE_SQL} SELECT org AS \"OrgUID\", day AS \"DateStr\", count(url) AS n FROM edge GROUP BY 1, 2",
)
def org_day_total(spark, sf):
    return r.count_values(edge_logs(spark, sf), ["OrgUID", "DateStr"], "ClientRequestURI", "n")


@query(
    "a7_url_first_seen",
    f"WITH {EDGE_SQL} SELECT org AS \"OrgUID\", url AS \"ClientRequestURI\", count(url) AS n, min(ts) AS first_seen "
    "FROM edge GROUP BY 1, 2",
)
def url_first_seen(spark, sf):
    aggregates = {"n": F.count("ClientRequestURI"), "first_seen": F.min("EventTime")}
    counted = r.group(edge_logs(spark, sf), ["OrgUID", "ClientRequestURI"], aggregates)
    return counted.select("OrgUID", "ClientRequestURI", "n", *without_zone("first_seen"))


@query("a8_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct(spark, sf):
    return r.distinct(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


_RUNNING_SQL = """
SELECT event_id, KEY, round(sum(value) OVER w, 4) AS total, max(value) OVER w AS top
FROM events WINDOW w AS (PARTITION BY KEY ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""


def _running(spark, sf, key, most):
    events = table(spark, sf, "events").select("event_id", "ts", key, "value")
    aggregates = {"total": ("sum", "value"), "top": ("max", "value")}
    out = ordered.running(events, [key], ["ts", "event_id"], aggregates, max_rows_per_task=most)
    return out.select("event_id", key, F.round("total", 4).alias("total"), "top")


@query("a9_running_sum", _RUNNING_SQL.replace("KEY", "user_id"))
def running_sum(spark, sf):
    return _running(spark, sf, "user_id", ordered.HOT_KEY_ROWS)


@query("a9_running_sum_hot_keys", _RUNNING_SQL.replace("KEY", "event_type"))
def running_sum_hot(spark, sf):
    return _running(spark, sf, "event_type", few_rows(spark, sf))


@query(
    "a10_running_reduce",
    "SELECT event_id, event_type, min(value) OVER w AS low, max(value) OVER w AS high, count(*) OVER w AS n "
    "FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)",
)
def running_reduce(spark, sf):
    """A user's reduction of (low, high, n) pairs, element by element."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    aggregates = {"low": ("min", "value"), "high": ("max", "value"), "n": ("count", F.lit(1))}
    out = ordered.running(events, ["event_type"], ["ts", "event_id"], aggregates)
    return out.select("event_id", "event_type", "low", "high", "n")


def _xor_sql(key: str) -> str:
    """DuckDB has the user's function as an aggregate."""
    return (
        f"SELECT event_id, {key}, bit_xor(event_id * 40503 % 65536) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS total "
        "FROM events"
    )


def _xor(spark, sf, key, most):
    events = table(spark, sf, "events").select("event_id", "ts", key, (F.col("event_id") * 40503 % 65536).alias("mark"))
    out = folds.rolling_reduce(events, [key], ["ts", "event_id"], "mark", operator.xor, max_rows_per_task=most)
    return out.select("event_id", key, "total")


@query("a10_rolling_user_function", _xor_sql("user_id"))
def rolling_user_function(spark, sf):
    """Each row with a user's reduction of its key's rows so far."""
    return _xor(spark, sf, "user_id", ordered.HOT_KEY_ROWS)


@query("a10_rolling_user_function_hot_keys", _xor_sql("event_type"))
def rolling_user_function_hot(spark, sf):
    return _xor(spark, sf, "event_type", few_rows(spark, sf))


@query(
    "a10_rolling_fold",
    """
    WITH numbered AS (
      SELECT *, CASE row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) % 2 WHEN 0 THEN 1 ELSE -1 END AS sign FROM events)
    SELECT event_id, user_id,
      CAST(sign * sum(sign * (event_id % 1000)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS total
    FROM numbered
    """,
)
def rolling_fold(spark, sf):
    """A function that is not associative: the new value less what was before."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", (F.col("event_id") % 1000).alias("mark"))
    out = folds.rolling_reduce(
        events, ["user_id"], ["ts", "event_id"], "mark", lambda a, b: b - a, associative=False
    )
    return out.select("event_id", "user_id", "total")


@query(
    "a11_word_count",
    f"SELECT word, count(*) AS count FROM (SELECT unnest(regexp_split_to_array(text, '{WHITESPACE}')) AS word "
    "FROM documents) WHERE word <> '' GROUP BY word",
)
def word_count(spark, sf):
    return r.word_count(table(spark, sf, "documents"), "text")


@query(
    "a12_count_sum",
    "SELECT event_type, count(value) AS cnt, round(sum(value), 4) AS total FROM events GROUP BY event_type",
)
def count_sum(spark, sf):
    aggregates = {"cnt": F.count("value"), "total": F.round(F.sum("value"), 4)}
    return r.group(table(spark, sf, "events"), ["event_type"], aggregates)


_TOP2_SQL = """
SELECT user_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 2
"""


@query("a13_top2", _TOP2_SQL)
def top2(spark, sf):
    events = table(spark, sf, "events").select("user_id", "value", "event_id")
    best = [F.col("value").desc(), F.col("event_id")]
    return r.top_n(events, ["user_id"], best, 2).select("user_id", "value")


@query(
    "a13_top3_orders",
    "SELECT o_custkey, o_orderkey FROM orders "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3",
)
def top3_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    best = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return r.top_n(orders, ["o_custkey"], best, 3).select("o_custkey", "o_orderkey")


@query("l1_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 3")
def limit(spark, sf):
    return r.limit(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 3, ["o_orderkey"])
