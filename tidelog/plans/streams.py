"""Windows, state and timers on streams. Each query runs its stream over all files and returns what it wrote."""

from __future__ import annotations

import operator
import time

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tidelog.operators import changelog as c
from tidelog.operators import windows as w
from tidelog.plans.aggregates import few_rows
from tidelog.plans.changes import _changelog_sql
from tidelog.plans.registry import EDGE_SQL, EPOCH, edge_message, query, table, without_zone
from tidelog.plans.sinks import staged_events
from tidelog.session import work_dir
from tidelog.sinks.keyed import KeyedTable
from tidelog.sources import files
from tidelog.sources.messages import edge_log
from tidelog.streaming import jobs, state


def _stream(spark, sf):
    return files.parquet_rows(spark, f"{sf}/events.parquet", stream=True)


def _written(df, name, *, flat=(), ended=None):
    """Run a stream to its end and read what it wrote; `flat` names its points in time."""
    spark = df.sparkSession
    path = work_dir(spark, name)

    def start():
        return jobs.to_files(df, path, f"{path}-checkpoint")

    if ended is None:
        start().awaitTermination()
    else:
        jobs.run_bounded(start, ended, spark)
    stored = spark.read.schema(df.schema).parquet(path)
    return stored.withColumns({n: F.col(n).cast("timestamp_ntz") for n in flat})


_BOUNDS = ("window_start", "window_end")


def _windows_sql(size: str, key: str) -> str:
    bucket = f"time_bucket(INTERVAL {size}, ts, {EPOCH})"
    return f"""
    SELECT {key}, {bucket} AS window_start, {bucket} + INTERVAL {size} AS window_end, count(*) AS n FROM events
    GROUP BY ALL
    """


# when all rows are in, the watermark has passed a window that ends here or before
_PASSED_SQL = "(SELECT date_trunc('millisecond', max(ts)) FROM events)"


def _bounded(spark, sf, lateness="0 seconds"):
    """(events with a watermark, the folder that ends them)."""
    ended = work_dir(spark, "ended")
    return w.watermarked(_stream(spark, sf), "ts", lateness, ended), ended


@query("e2_stream_tumbling_ascending", _windows_sql("5 MINUTE", "event_type"))
def tumbling_ascending(spark, sf):
    events, ended = _bounded(spark, sf)
    counted = w.time_windows(events, ["event_type"], "ts", "5 minutes", {"n": F.count("*")})
    return _written(counted, "tumbling", flat=_BOUNDS, ended=ended)


@query("e3_stream_tumbling_late", _windows_sql("10 SECOND", "user_id"))
def tumbling_late(spark, sf):
    events, ended = _bounded(spark, sf, "3 seconds")
    counted = w.time_windows(events, ["user_id"], "ts", "10 seconds", {"n": F.count("*")})
    return _written(counted, "tumbling", flat=_BOUNDS, ended=ended)


@query(
    "e4_stream_late_rows",
    f"SELECT * FROM ({_windows_sql('5 MINUTE', 'event_type')}) WHERE window_end <= {_PASSED_SQL}",
)
def late_rows(spark, sf):
    """All events arrive a second time, too late for the windows that are closed by then."""
    arrivals, out = work_dir(spark, "arrivals"), work_dir(spark, "windows")
    for _ in range(2):
        table(spark, sf, "events").select("ts", "event_type").write.mode("append").parquet(arrivals)
        events = w.watermarked(files.parquet_rows(spark, arrivals, stream=True), "ts")
        counted = w.time_windows(events, ["event_type"], "ts", "5 minutes", {"n": F.count("*")})
        jobs.to_files(counted, out, f"{out}-checkpoint").awaitTermination()
    stored = spark.read.schema(counted.schema).parquet(out)
    return stored.select("event_type", *without_zone("window_start", "window_end"), "n")


@query(
    "c4_stream_closed_windows",
    f"""
    WITH {EDGE_SQL}
    SELECT org AS "OrgUID", time_bucket(INTERVAL 5 MINUTE, ts, {EPOCH}) AS window_start,
      time_bucket(INTERVAL 5 MINUTE, ts, {EPOCH}) + INTERVAL 5 MINUTE AS window_end, count(url) AS url_count
    FROM edge GROUP BY ALL
    """,
)
def closed_windows(spark, sf):
    """JSON messages decoded, counted per organisation in 5-minute windows, appended as windows close."""
    lines = edge_message(_stream(spark, sf)).select("value")
    ended = work_dir(spark, "ended")
    logs = w.watermarked(edge_log(lines), "EventTime", "5 seconds", ended)
    counted = w.time_windows(
        logs, ["OrgUID"], "EventTime", "5 minutes", {"url_count": F.count("ClientRequestURI")}
    )
    return _written(counted, "closed", flat=_BOUNDS, ended=ended)


@query(
    "e8_stream_session_gap_per_row",
    """
    WITH reached AS (
      SELECT *, ts + to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER) + 1) AS reach FROM events),
    marked AS (
      SELECT *, max(reach) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        AS before FROM reached),
    numbered AS (
      SELECT *, sum(CASE WHEN ts <= before THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS no
      FROM marked)
    SELECT user_id, min(ts) AS window_start, max(reach) AS window_end, count(*) AS n
    FROM numbered GROUP BY user_id, no
    """,
)
def session_gap_per_row(spark, sf):
    events, ended = _bounded(spark, sf)
    gap = F.concat((F.get_json_object("props", "$.k").cast("int") + 1).cast("string"), F.lit(" minutes"))
    counted = w.session_windows(events, ["user_id"], "ts", gap, {"n": F.count("*")})
    return _written(counted, "session", flat=_BOUNDS, ended=ended)


@query(
    "e6_stream_sliding",
    f"""
    SELECT event_type, start AS window_start, start + INTERVAL 60 MINUTE AS window_end, count(*) AS n
    FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, ts, {EPOCH}) - INTERVAL 10 MINUTE * i AS start
          FROM events, range(6) r(i))
    GROUP BY ALL
    """,
)
def sliding(spark, sf):
    events, ended = _bounded(spark, sf, "3 seconds")
    counted = w.time_windows(events, ["event_type"], "ts", "60 minutes", {"n": F.count("*")}, "10 minutes")
    return _written(counted, "sliding", flat=_BOUNDS, ended=ended)


@query(
    "e7_stream_session",
    """
    WITH marked AS (
      SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE
                     THEN 0 ELSE 1 END AS fresh FROM events),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM marked)
    SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS n
    FROM numbered GROUP BY user_id, no
    """,
)
def session(spark, sf):
    events, ended = _bounded(spark, sf)
    counted = w.session_windows(events, ["user_id"], "ts", "30 minutes", {"n": F.count("*")})
    return _written(counted, "session", flat=_BOUNDS, ended=ended)


@query(
    "a16_stream_status_counts",
    f"""
    SELECT event_type, window_start, window_start + INTERVAL 1 DAY AS window_end, status, count(*) AS status_count,
      sum(count(*)) OVER (PARTITION BY event_type, window_start) :: BIGINT AS window_count
    FROM (SELECT event_type, time_bucket(INTERVAL 1 DAY, ts, {EPOCH}) AS window_start,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS status FROM events)
    GROUP BY event_type, window_start, status
    """,
)
def status_counts(spark, sf):
    events, ended = _bounded(spark, sf)
    events = events.withColumn("status", F.get_json_object("props", "$.k").cast("int"))
    counted = w.status_counts_with_total(events, "event_type", "status", "ts", "1 day")
    return _written(counted, "statuses", flat=_BOUNDS, ended=ended)


# how often the streams below are stopped, given new files and started again
TURNS = 3


def _in_turns(spark, sf, columns, start):
    """Store the events in TURNS portions; after each, run the stream from its checkpoint to the end."""
    events = table(spark, sf, "events").select("event_id", *columns)
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    path = work_dir(spark, "arrivals")
    portion = F.floor((F.col("event_id") - low) * TURNS / (high - low + 1))
    for turn in range(TURNS):
        events.filter(portion == turn).write.mode("append").parquet(path)
        start(files.parquet_rows(spark, path, stream=True)).awaitTermination()


@query(
    "a9_stream_running_sum",
    "SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS total FROM events",
)
def running_sum(spark, sf):
    """A running sum that goes on over micro-batches and restarts."""
    path = work_dir(spark, "running")
    total = {"total": ("sum", "value")}
    _in_turns(
        spark,
        sf,
        ["user_id", "value"],
        lambda rows: jobs.running_batches(rows, ["user_id"], ["event_id"], total, path, f"{path}-checkpoint"),
    )
    stored = spark.read.schema("event_id bigint, user_id bigint, total double").parquet(path)
    return stored.select("event_id", "user_id", F.round("total", 4).alias("total"))


@query("c1_stream_changelog", _changelog_sql("event_type").replace("ORDER BY ts, event_id", "ORDER BY event_id"))
def changelog(spark, sf):
    """The changelog of a running aggregate, across micro-batches and restarts."""
    aggregates = {"n": ("count", F.lit(1)), "top": ("max", "value"), "_rows": ("count", F.lit(1))}
    path = work_dir(spark, "changelog")

    def start(rows):
        return jobs.running_batches(
            rows,
            ["event_type"],
            ["event_id"],
            aggregates,
            path,
            f"{path}-checkpoint",
            finish=lambda seen: seen.select("event_type", "event_id", F.inline(c.change_rows(["n", "top"]))),
            previous=True,
            max_rows_per_task=few_rows(spark, sf),
        )

    _in_turns(spark, sf, ["event_type", "value"], start)
    schema = "event_type string, event_id bigint, op string, n bigint, top double"
    return spark.read.schema(schema).parquet(path).drop("batch")


def _sums_in_turns(spark, sf, name, function, ordered="event_id"):
    """(key, event_id, total) of a running reduce over several micro-batches and restarts."""
    path = work_dir(spark, name)
    schema = []

    def start(rows):
        reduced = state.running_reduce(rows, "user_id", "value", "event_id", function, order=ordered)
        schema.append(reduced.schema)
        return jobs.to_files(reduced, path, f"{path}-checkpoint")

    _in_turns(spark, sf, ["user_id", "value"], start)
    return spark.read.schema(schema[0]).parquet(path).withColumnRenamed("user_id", "key")


@query(
    "a10_stream_reduce",
    "SELECT user_id AS key, event_id, max(value) OVER (PARTITION BY user_id ORDER BY event_id) AS total FROM events",
)
def running_reduce(spark, sf):
    """A user's reducing function, here the larger of two, given out after every row."""
    return _sums_in_turns(spark, sf, "reduce", lambda a, b: a if a > b else b)


@query(
    "a13_stream_top2",
    """
    SELECT user_id AS key, CAST(row_number() OVER w AS INTEGER) AS rank, value FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY value DESC, event_id) QUALIFY row_number() OVER w <= 2
    """,
)
def top2(spark, sf):
    """The two largest values per key, kept up to date over micro-batches."""
    rows = staged_events(spark, sf, "user_id", "value").select("user_id", "value")
    path, keys = work_dir(spark, "top"), ["key", "rank"]
    best = state.top_values(rows.withColumnRenamed("user_id", "key"), "key", "value", 2)
    jobs.upsert(best, path, keys, f"{path}-checkpoint").awaitTermination()
    return KeyedTable(spark, path, keys).read()


@query(
    "d1_stream_state",
    "SELECT user_id AS key, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS total FROM events",
)
def value_state(spark, sf):
    """A sum kept in state, given out after every row, over several micro-batches and restarts."""
    return _sums_in_turns(spark, sf, "state", operator.add).withColumn("total", F.round("total", 4))


@query(
    "d2_stream_timers",
    """
    SELECT DISTINCT user_id AS key, epoch_us(ts) // 1000 + 5000 AS fired_ms,
      round(sum(value) OVER (PARTITION BY user_id), 4) AS total FROM events
    """,
)
def timers(spark, sf):
    events, ended = _bounded(spark, sf, "2 seconds")
    timed = events.select(F.col("user_id").alias("key"), "value", "ts", F.unix_millis("ts").alias("ms"))
    fired = _written(state.sum_on_timer(timed, "key", "value", "ms"), "timers", ended=ended)
    return fired.withColumn("total", F.round("total", 4))


@query(
    "w1_stream_max_over_preceding",
    """
    SELECT user_id AS key, event_id AS id, epoch_us(ts) // 1000 AS ms, max(value) OVER (PARTITION BY user_id
      ORDER BY epoch_us(ts) // 1000, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS top FROM events
    """,
)
def max_over_preceding(spark, sf):
    events, ended = _bounded(spark, sf, "3 seconds")
    names = [F.col("user_id").alias("key"), F.col("event_id").alias("id")]
    timed = events.select(*names, "value", "ts", F.unix_millis("ts").alias("ms"))
    return _written(state.max_over_preceding(timed, "key", "value", "ms", "id"), "preceding", ended=ended)


@query(
    "e9_stream_count_window",
    """
    WITH numbered AS (
      SELECT user_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 3 AS window_no FROM events)
    SELECT user_id AS key, window_no, round(sum(value), 4) AS total FROM numbered GROUP BY ALL HAVING count(*) = 3
    """,
)
def count_window(spark, sf):
    """Every three rows of a key, also where they come in different micro-batches."""
    path = work_dir(spark, "count")

    def start(rows):
        sums = state.count_window_sums(rows, "user_id", "value", 3, order="event_id")
        return jobs.to_files(sums, path, f"{path}-checkpoint")

    _in_turns(spark, sf, ["user_id", "value"], start)
    stored = spark.read.schema("user_id bigint, window_no bigint, total double").parquet(path)
    return stored.select(F.col("user_id").alias("key"), "window_no", F.round("total", 4).alias("total"))


@query(
    "e4_stream_late_split",
    f"""
    WITH again AS (
      SELECT event_id, {f"time_bucket(INTERVAL 5 MINUTE, ts, {EPOCH})"} + INTERVAL 5 MINUTE <= {_PASSED_SQL} AS passed FROM events)
    SELECT event_id, 1 AS turn, FALSE AS late FROM events
    UNION ALL SELECT event_id, 2, passed FROM again
    """,
)
def late_split(spark, sf):
    """All events arrive a second time. Each row is kept, and marked late if its window had closed by then."""
    arrivals, out = work_dir(spark, "arrivals"), work_dir(spark, "marked")
    for turn in (1, 2):
        events = table(spark, sf, "events").select("event_id", "ts", F.lit(turn).alias("turn"))
        events.write.mode("append").parquet(arrivals)
        rows = w.watermarked(files.parquet_rows(spark, arrivals, stream=True), "ts")
        marked = state.marked_late(rows, F.window("ts", "5 minutes")["end"])
        jobs.to_files(marked, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.schema(marked.schema).parquet(out).select("event_id", "turn", "late")


EXPIRY_MS = 4_000


def _with_expiry(spark, sf, columns, name, mode, make):
    """Half of the events, then nothing until all state has expired, then the other half.

    State that expires by the clock keeps a stream from ending by itself.
    """
    path, arrivals = work_dir(spark, name), work_dir(spark, "arrivals")
    events = table(spark, sf, "events").select("event_id", *columns)
    half = events.agg(F.floor((F.min("event_id") + F.max("event_id")) / 2)).first()[0]
    for turn, rows in enumerate((events.filter(F.col("event_id") <= half), events.filter(F.col("event_id") > half))):
        rows.write.mode("append").parquet(arrivals)
        made = make(files.parquet_rows(spark, arrivals, stream=True))

        def store(batch, number, turn=turn):
            batch.write.mode("overwrite").parquet(f"{path}/turn={turn}/batch={number}")

        jobs.run_until_idle(jobs.to_batches(made, store, f"{path}-checkpoint", mode, every="1 second"))
        if turn == 0:
            time.sleep(EXPIRY_MS / 1000 + 1)
    return spark.read.schema(made.schema.add("turn", IntegerType())).parquet(path)


_HALVES_SQL = "event_id > (SELECT (min(event_id) + max(event_id)) // 2 FROM events)"


@query(
    "d3_stream_state_expiry",
    f"""
    SELECT user_id AS key, event_id, round(sum(value) OVER (PARTITION BY user_id, {_HALVES_SQL} ORDER BY event_id), 4)
      AS total FROM events
    """,
)
def state_expiry(spark, sf):
    """Sums that begin anew once a key was idle for longer than its state lives."""

    def make(rows):
        return state.running_reduce(rows, "user_id", "value", "event_id", ttl_ms=EXPIRY_MS, order="event_id")

    sums = _with_expiry(spark, sf, ["user_id", "value"], "expiry", "append", make)
    return sums.select(F.col("user_id").alias("key"), "event_id", F.round("total", 4).alias("total"))


@query(
    "d4_stream_idle_counts",
    f"""
    WITH {EDGE_SQL}
    SELECT org, day, url, CAST({_HALVES_SQL} AS INTEGER) AS turn, count(*) AS count FROM edge GROUP BY ALL
    """,
)
def idle_counts(spark, sf):
    """Counts by organisation, day and URL, of which none outlives a pause."""
    keys = [
        (F.col("user_id") % 10).cast("string").alias("org"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.concat(F.lit("/v3/"), "event_type").alias("url"),
    ]

    def make(rows):
        return state.count_with_expiry(rows.select(*keys), ["org", "day", "url"], EXPIRY_MS)

    counts = _with_expiry(spark, sf, ["user_id", "ts", "event_type"], "idle", "update", make)
    # a key's count grows over the micro-batches of a turn
    return counts.groupBy("org", "day", "url", "turn").agg(F.max("count").alias("count"))


# the least bytes of a micro-batch, and rows of a file, of which several fit
BATCH_BYTES, FILE_ROWS = 32_768, 1_000


@query(
    "e11_micro_batches",
    "SELECT count(*) AS n, count(DISTINCT event_id) AS ids, TRUE AS bounded FROM events",
)
def micro_batches(spark, sf):
    """Micro-batches bounded in bytes, however large the input is; each written as its own folder.

    The bound follows the input up to `files.MOST_BATCH_BYTES`.
    """
    arrivals, path = work_dir(spark, "arrivals"), work_dir(spark, "micro")
    events = table(spark, sf, "events").select("event_id")
    file_rows = files.rows_per_file(events, FILE_ROWS)
    events.write.option("maxRecordsPerFile", file_rows).option("compression", "none").parquet(arrivals)
    bound = files.batch_bytes(spark, arrivals, BATCH_BYTES)
    rows = files.parquet_rows(spark, arrivals, stream=True, bytes_per_batch=bound)
    jobs.fan_out(rows, {path: lambda batch: batch}, f"{path}-checkpoint").awaitTermination()
    stored = spark.read.schema("event_id bigint, batch bigint").parquet(path)
    # a file holds eight bytes a row, and more beside them
    most = F.max("rows") * 8 <= bound
    totals = stored.groupBy("batch").agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("ids"))
    return totals.agg(F.sum("rows").alias("n"), F.sum("ids").alias("ids"), most.alias("bounded"))
