"""Event-time windows, count windows, row frames and per-row state, on batch frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import ordered
from tidelog.operators import windows as w
from tidelog.plans.aggregates import few_rows
from tidelog.plans.registry import EDGE_SQL, EPOCH, edge_logs, query, table, without_zone


def _events(spark, sf, *extra):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "value", *extra)


def _tumbling_sql(size: str, key: str, aggregates: str) -> str:
    bucket = f"time_bucket(INTERVAL {size}, ts, {EPOCH})"
    return (
        f"SELECT {key}, {bucket} AS window_start, {bucket} + INTERVAL {size} AS window_end, {aggregates} "
        "FROM events GROUP BY ALL"
    )


def _sliding_sql(size: int, slide: int, key: str, aggregates: str) -> str:
    """Sizes in minutes."""
    copies = -(-size // slide)
    return f"""
    SELECT {key}, start AS window_start, start + INTERVAL {size} MINUTE AS window_end, {aggregates}
    FROM (SELECT *, time_bucket(INTERVAL {slide} MINUTE, ts, {EPOCH}) - INTERVAL {slide} MINUTE * i AS start
          FROM events, range({copies}) r(i))
    WHERE ts < start + INTERVAL {size} MINUTE GROUP BY ALL
    """


def _session_sql(key: str, gap: str, aggregates: str) -> str:
    return f"""
    WITH reached AS (
      SELECT *, ts + {gap} AS reach,
        max(ts + {gap}) OVER (PARTITION BY {key} ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM events),
    numbered AS (
      SELECT *, sum(CASE WHEN ts <= before THEN 0 ELSE 1 END)
        OVER (PARTITION BY {key} ORDER BY ts, event_id) AS no FROM reached)
    SELECT {key}, min(ts) AS window_start, max(reach) AS window_end, {aggregates}
    FROM numbered GROUP BY {key}, no
    """


def _count_sum():
    return {"n": F.count("*"), "total": F.round(F.sum("value"), 4)}


_COUNT_SUM_SQL = "count(*) AS n, round(sum(value), 4) AS total"


@query("e5_tumbling_10_seconds", _tumbling_sql("10 SECOND", "user_id", _COUNT_SUM_SQL))
def tumbling_seconds(spark, sf):
    return w.time_windows(_events(spark, sf), ["user_id"], "ts", "10 seconds", _count_sum())


@query("e5_tumbling_5_minutes", _tumbling_sql("5 MINUTE", "event_type", _COUNT_SUM_SQL))
def tumbling_minutes(spark, sf):
    return w.time_windows(_events(spark, sf, "event_type"), ["event_type"], "ts", "5 minutes", _count_sum())


@query("e6_sliding_60_10_minutes", _sliding_sql(60, 10, "event_type", _COUNT_SUM_SQL))
def sliding(spark, sf):
    events = _events(spark, sf, "event_type")
    return w.time_windows(events, ["event_type"], "ts", "60 minutes", _count_sum(), "10 minutes")


@query("e6_sliding_uneven", _sliding_sql(50, 20, "user_id", _COUNT_SUM_SQL))
def sliding_uneven(spark, sf):
    return w.time_windows(_events(spark, sf), ["user_id"], "ts", "50 minutes", _count_sum(), "20 minutes")


def _sessions(rows, key, gap, most):
    aggregates = {"n": ("count", F.lit(1)), "total": ("sum", "value")}
    found = ordered.sessions(rows, [key], "ts", gap, aggregates, most)
    return found.withColumn("total", F.round("total", 4))


_FIXED_GAP = "INTERVAL 30 MINUTE"


@query("e7_session", _session_sql("user_id", _FIXED_GAP, _COUNT_SUM_SQL))
def session(spark, sf):
    return _sessions(_events(spark, sf), "user_id", "30 minutes", ordered.HOT_KEY_ROWS)


@query("e7_session_hot_keys", _session_sql("event_type", _FIXED_GAP, _COUNT_SUM_SQL))
def session_hot(spark, sf):
    return _sessions(_events(spark, sf, "event_type"), "event_type", "30 minutes", few_rows(spark, sf))


_ROW_GAP = "to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER) + 1)"


def _row_gap():
    return F.concat((F.get_json_object("props", "$.k").cast("int") + 1).cast("string"), F.lit(" minutes"))


@query("e8_session_gap_per_row", _session_sql("user_id", _ROW_GAP, _COUNT_SUM_SQL))
def session_dynamic(spark, sf):
    return _sessions(_events(spark, sf, "props"), "user_id", _row_gap(), ordered.HOT_KEY_ROWS)


@query("e8_session_gap_per_row_hot_keys", _session_sql("event_type", _ROW_GAP, _COUNT_SUM_SQL))
def session_dynamic_hot(spark, sf):
    return _sessions(_events(spark, sf, "props", "event_type"), "event_type", _row_gap(), few_rows(spark, sf))


def _count_window_sql(key: str, size: int) -> str:
    return f"""
    SELECT {key}, (n - 1) // {size} AS window_no, round(sum(value), 4) AS total
    FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS n FROM events)
    GROUP BY ALL HAVING count(*) = {size}
    """


def _count_windows(rows, key, size, most):
    total = {"total": F.round(F.sum("value"), 4)}
    return ordered.count_windows(rows, [key], ["ts", "event_id"], size, total, most)


@query("e9_count_window", _count_window_sql("user_id", 2))
def count_window(spark, sf):
    return _count_windows(_events(spark, sf), "user_id", 2, ordered.HOT_KEY_ROWS)


@query("e9_count_window_hot_keys", _count_window_sql("event_type", 7))
def count_window_hot(spark, sf):
    return _count_windows(_events(spark, sf, "event_type"), "event_type", 7, few_rows(spark, sf))


@query("e10_global_window", "SELECT count(*) AS n, round(sum(value), 2) AS total, min(ts) AS first FROM events")
def global_window(spark, sf):
    aggregates = {"n": F.count("*"), "total": F.round(F.sum("value"), 2), "first": F.min("ts")}
    return w.global_total(_events(spark, sf), aggregates)


def _preceding_sql(key: str) -> str:
    return f"""
    SELECT event_id, {key}, max(value) OVER w AS top FROM events
    WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """


def _preceding(rows, key, most):
    top = {"top": F.max("value")}
    return ordered.over_preceding(rows, [key], ["ts", "event_id"], 2, top, most).select("event_id", key, "top")


@query("w1_max_over_preceding", _preceding_sql("user_id"))
def preceding(spark, sf):
    return _preceding(_events(spark, sf), "user_id", ordered.HOT_KEY_ROWS)


@query("w1_max_over_preceding_hot_keys", _preceding_sql("event_type"))
def preceding_hot(spark, sf):
    return _preceding(_events(spark, sf, "event_type"), "event_type", few_rows(spark, sf))


def _counts_with_last_sql(sub_key: str, size: str) -> str:
    bucket = f"time_bucket(INTERVAL {size}, ts, {EPOCH})"
    return f"""
    WITH {EDGE_SQL} SELECT org AS "OrgUID", {sub_key}, {bucket} AS window_start,
      {bucket} + INTERVAL {size} AS window_end, count(*) AS count, arg_max(stamp, (ts, event_id)) AS last_stamp
    FROM edge GROUP BY ALL
    """


def _counts_with_last(spark, sf, sub_key, size):
    counted = w.counts_with_last(
        edge_logs(spark, sf), ["OrgUID"], sub_key, "EventTime", size, "EdgeEndTimestamp", "event_id"
    )
    return counted.select(
        "OrgUID",
        sub_key,
        *without_zone("window_start", "window_end"),
        "count",
        F.col("last_EdgeEndTimestamp").alias("last_stamp"),
    )


@query("a15_urls_per_org", _counts_with_last_sql('url AS "ClientRequestURI"', "10 SECOND"))
def urls_per_org(spark, sf):
    return _counts_with_last(spark, sf, "ClientRequestURI", "10 seconds")


@query("a15_urls_per_org_5_minutes", _counts_with_last_sql('url AS "ClientRequestURI"', "5 MINUTE"))
def urls_per_org_minutes(spark, sf):
    return _counts_with_last(spark, sf, "ClientRequestURI", "5 minutes")


@query("a15_statuses_per_org", _counts_with_last_sql('status AS "EdgeResponseStatus"', "10 SECOND"))
def statuses_per_org(spark, sf):
    return _counts_with_last(spark, sf, "EdgeResponseStatus", "10 seconds")


def _status(events):
    return events.withColumn("status", F.get_json_object("props", "$.k").cast("int"))


_STATUS = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _status_total_sql(source: str) -> str:
    return f"""
    SELECT event_type, window_start, window_end, status, count(*) AS status_count,
      sum(count(*)) OVER (PARTITION BY event_type, window_start) :: BIGINT AS window_count
    FROM ({source}) GROUP BY event_type, window_start, window_end, status
    """


_DAY = f"time_bucket(INTERVAL 1 DAY, ts, {EPOCH})"
_DAYS_SQL = f"SELECT *, {_STATUS} AS status, {_DAY} AS window_start, {_DAY} + INTERVAL 1 DAY AS window_end FROM events"
_SLIDES_SQL = f"""
SELECT *, {_STATUS} AS status, start AS window_start, start + INTERVAL 50 MINUTE AS window_end FROM (
  SELECT *, time_bucket(INTERVAL 20 MINUTE, ts, {EPOCH}) - INTERVAL 20 MINUTE * i AS start
  FROM events, range(3) r(i)) WHERE ts < start + INTERVAL 50 MINUTE
"""
_SESSIONS_SQL = f"""
WITH reached AS (
  SELECT *, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) + INTERVAL 30 MINUTE AS before FROM events),
numbered AS (
  SELECT *, sum(CASE WHEN ts <= before THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS no
  FROM reached)
SELECT *, {_STATUS} AS status, min(ts) OVER s AS window_start, max(ts) OVER s + INTERVAL 30 MINUTE AS window_end
FROM numbered WINDOW s AS (PARTITION BY event_type, no)
"""


@query("a16_status_counts_tumbling", _status_total_sql(_DAYS_SQL))
def status_tumbling(spark, sf):
    return w.status_counts_with_total(_status(table(spark, sf, "events")), "event_type", "status", "ts", "1 day")


@query("a16_status_counts_sliding", _status_total_sql(_SLIDES_SQL))
def status_sliding(spark, sf):
    events = _status(table(spark, sf, "events"))
    return w.status_counts_with_total(events, "event_type", "status", "ts", "50 minutes", "20 minutes")


@query("a16_status_counts_session", _status_total_sql(_SESSIONS_SQL))
def status_session(spark, sf):
    events = _status(table(spark, sf, "events"))
    return w.session_status_counts(events, "event_type", "status", "ts", "30 minutes")


@query("a16_status_counts_session_hot_keys", _status_total_sql(_SESSIONS_SQL))
def status_session_hot(spark, sf):
    events = _status(table(spark, sf, "events"))
    return w.session_status_counts(events, "event_type", "status", "ts", "30 minutes", few_rows(spark, sf))


@query("a17_total_over_windows", "SELECT event_type, count(*) AS total FROM events GROUP BY event_type")
def total_over_windows(spark, sf):
    events = _events(spark, sf, "event_type")
    counted = w.time_windows(events, ["event_type"], "ts", "5 seconds", {"n": F.count("*")})
    return w.totals_over_windows(counted, "event_type", "n")


@query("a18_window_count", _tumbling_sql("1 HOUR", "user_id", "count(*) AS n"))
def window_count(spark, sf):
    return w.time_windows(_events(spark, sf), ["user_id"], "ts", "1 hour", {"n": F.count("*")})


@query(
    "f15_window_bounds",
    f"SELECT event_id, time_bucket(INTERVAL 10 MINUTE, ts, {EPOCH}) AS window_start, "
    f"time_bucket(INTERVAL 10 MINUTE, ts, {EPOCH}) + INTERVAL 10 MINUTE AS window_end FROM events",
)
def window_bounds(spark, sf):
    window = F.window("ts", "10 minutes")
    return _events(spark, sf).select(
        "event_id", window["start"].alias("window_start"), window["end"].alias("window_end")
    )
