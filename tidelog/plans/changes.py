"""Changelogs, change feeds and per-key state on batch frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import changelog as c
from tidelog.operators import ordered
from tidelog.operators import relational as r
from tidelog.plans.aggregates import few_rows
from tidelog.plans.registry import query, table
from tidelog.sources.changes import change_feed, initial_rows


def _changelog_sql(key: str) -> str:
    return f"""
    WITH seen AS (
      SELECT {key}, event_id, ts, count(*) OVER w AS n, max(value) OVER w AS top FROM events
      WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id)),
    pairs AS (
      SELECT *, lag(n) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS old_n,
        lag(top) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS old_top FROM seen)
    SELECT {key}, event_id, CASE WHEN old_n IS NULL THEN '+I' ELSE '+U' END AS op, n, top FROM pairs
    UNION ALL
    SELECT {key}, event_id, '-U', old_n, old_top FROM pairs WHERE old_n IS NOT NULL
    """


def _changes(spark, sf, key, most):
    events = table(spark, sf, "events").select("event_id", "ts", key, "value")
    aggregates = {"n": ("count", F.lit(1)), "top": ("max", "value")}
    return c.aggregate_changelog(events, [key], ["ts", "event_id"], aggregates, most).drop("ts")


@query("c1_aggregate_changelog", _changelog_sql("user_id"))
def changelog(spark, sf):
    return _changes(spark, sf, "user_id", ordered.HOT_KEY_ROWS)


@query("c1_aggregate_changelog_hot_keys", _changelog_sql("event_type"))
def changelog_hot(spark, sf):
    return _changes(spark, sf, "event_type", few_rows(spark, sf))


@query(
    "c1_changelog_of_maximum",
    """
    WITH seen AS (SELECT user_id, event_id, ts, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS top
                  FROM events),
    pairs AS (SELECT *, lag(top) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old FROM seen)
    SELECT user_id, event_id, CASE WHEN old IS NULL THEN '+I' ELSE '+U' END AS op, top FROM pairs
    WHERE old IS NULL OR old <> top
    UNION ALL SELECT user_id, event_id, '-U', old FROM pairs WHERE old <> top
    """,
)
def changelog_of_maximum(spark, sf):
    """Rows that leave the maximum as it is change nothing."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    return c.aggregate_changelog(events, ["user_id"], ["ts", "event_id"], {"top": ("max", "value")}).drop("ts")


_APPLIED_SQL = """
SELECT user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
"""


def _feed(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "value", "event_id")
    op = F.when(F.col("event_type") == "error", "D").otherwise("U")
    return change_feed(events, op, F.col("event_id")).drop("event_id")


@query("c2_apply_changes", f"SELECT * FROM ({_APPLIED_SQL}) WHERE event_type <> 'error'")
def apply_changes(spark, sf):
    return c.apply_changes(_feed(spark, sf), ["user_id"], ["seq"]).drop("seq")


@query(
    "s10_table_then_changes",
    f"""
    WITH latest AS ({_APPLIED_SQL})
    SELECT c_custkey AS user_id, coalesce(event_type, 'none') AS event_type, coalesce(value, c_acctbal) AS value
    FROM customer LEFT JOIN latest ON c_custkey = user_id WHERE event_type IS DISTINCT FROM 'error'
    UNION ALL SELECT user_id, event_type, value FROM latest
    WHERE event_type <> 'error' AND user_id NOT IN (SELECT c_custkey FROM customer)
    """,
)
def table_then_changes(spark, sf):
    """A table's rows first, then the changes made to it."""
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.lit("none").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )
    feed = initial_rows(customers).unionByName(_feed(spark, sf))
    return c.apply_changes(feed, ["user_id"], ["seq"]).drop("seq")


@query(
    "c3_keep_upserts",
    f"SELECT user_id, event_id, op, n, top FROM ({_changelog_sql('user_id')}) WHERE op <> '-U'",
)
def keep_upserts(spark, sf):
    return c.keep_upserts(_changes(spark, sf, "user_id", ordered.HOT_KEY_ROWS))


_ROLLING_SQL = """
SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS total FROM events
"""


@query("d1_sum_per_row", _ROLLING_SQL)
def sum_per_row(spark, sf):
    """Per-key state added to by every row, in order of arrival."""
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    out = ordered.running(events, ["user_id"], ["event_id"], {"total": ("sum", "value")})
    return out.select("event_id", "user_id", F.round("total", 4).alias("total"))


@query(
    "d2_timers_at_end",
    """
    SELECT DISTINCT user_id, date_trunc('millisecond', ts) + INTERVAL 5 SECOND AS fired,
      round(sum(value) OVER (PARTITION BY user_id), 4) AS total FROM events
    """,
)
def timers_at_end(spark, sf):
    """Every row's timer at five seconds past it, with the sum its key ends with."""
    events = table(spark, sf, "events").select("user_id", "ts", "value")
    return r.timers_with_total(events, "user_id", "ts", "value").select(
        "user_id", "fired", F.round("total", 4).alias("total")
    )


@query(
    "d2_timers_at_end_hot_keys",
    """
    SELECT DISTINCT event_type, date_trunc('millisecond', ts) + INTERVAL 5 SECOND AS fired,
      round(sum(value) OVER (PARTITION BY event_type), 4) AS total FROM events
    """,
)
def timers_at_end_hot(spark, sf):
    events = table(spark, sf, "events").select("event_type", "ts", "value")
    out = r.timers_with_total(events, "event_type", "ts", "value", moments_per_task=few_rows(spark, sf))
    return out.select("event_type", "fired", F.round("total", 4).alias("total"))


@query(
    "k4_latest_per_org",
    "SELECT CAST(user_id % 10 AS VARCHAR) AS org, arg_max(ts, event_id) AS latest, "
    "arg_max(CAST(json_extract_string(props, '$.k') AS INTEGER), event_id) AS last_status FROM events GROUP BY 1",
)
def latest_per_org(spark, sf):
    logs = table(spark, sf, "events").select(
        (F.col("user_id") % 10).cast("string").alias("org"),
        F.col("ts").alias("latest"),
        F.get_json_object("props", "$.k").cast("int").alias("last_status"),
        "event_id",
    )
    return r.latest_per_key(logs, ["org"], ["event_id"]).drop("event_id")
