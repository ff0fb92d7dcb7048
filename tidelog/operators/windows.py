"""Event-time windows and the aggregates taken in them. All work on batch and stream frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.ordered import HOT_KEY_ROWS, running, sessions
from tidelog.session import materialize


#: event time of the row that ends a bounded stream; rows of the input must lie before it
END_OF_INPUT = "9999-01-01 00:00:00"


def watermarked(df: DataFrame, ts: str, lateness: str = "0 seconds", ended: str | None = None) -> DataFrame:
    """Declare the event-time column and how late rows may come; 0 means ascending times.

    Watermarks need a point in time, so a time without zone is read as session time (UTC).

    `ended` names a folder that is read along with the stream. `jobs.run_bounded` puts one row into it when the
    input has been read, whose time moves the watermark past everything, so that all windows,
    sessions and timers that are still open are given out. No operator sees that row.
    """
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if ended is None or not df.isStreaming:
        return df.withWatermark(ts, lateness)
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(ended)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    last = spark.readStream.schema("at timestamp").parquet(ended)
    columns = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != ts else F.col("at").alias(ts) for f in df.schema]
    inside = F.col(ts).isNull() | (F.col(ts) < F.lit(END_OF_INPUT).cast("timestamp"))
    # state is kept under one schema: a column that is never NULL must not become one that may be, or back, as
    # one of the two inputs is empty
    firm = {f.name: F.when(inside, F.col(f.name)) for f in df.schema if not f.nullable and f.name != ts}
    both = df.withColumns(firm).unionByName(last.select(*columns)).withWatermark(ts, lateness)
    # a filter on the event time itself stays above the watermark, which so takes the last row in
    return both.filter(inside)


def time_windows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    aggregates: dict[str, Column],
    slide: str | None = None,
) -> DataFrame:
    """Tumbling windows, or sliding ones with `slide`: (keys, window_start, window_end, aggregates).

    Windows start at multiples of the slide counted from the epoch. The aggregates are
    combined before the shuffle, also across the copies a sliding window makes of a row.
    """
    return (
        df.groupBy(*keys, F.window(ts, size, slide).alias("_window"))
        .agg(*[agg.alias(name) for name, agg in aggregates.items()])
        .select(
            *keys,
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *aggregates,
        )
    )


def session_windows(
    df: DataFrame, keys: Sequence[str], ts: str, gap: Column | str, aggregates: dict[str, Column]
) -> DataFrame:
    """Session windows as Spark groups them: the streaming form of `ordered.sessions`."""
    return (
        df.groupBy(*keys, F.session_window(ts, gap).alias("_window"))
        .agg(*[agg.alias(name) for name, agg in aggregates.items()])
        .select(
            *keys,
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *aggregates,
        )
    )


def counts_with_last(
    df: DataFrame,
    keys: Sequence[str],
    sub_key: str,
    ts: str,
    size: str,
    last: str,
    sequence: str | None = None,
) -> DataFrame:
    """Per key and window: how often each `sub_key` came, and the latest value of `last`.

    Latest means greatest event time, then greatest `sequence`; not order of arrival.
    """
    order = F.struct(ts, sequence) if sequence else F.col(ts)
    return time_windows(
        df,
        [*keys, sub_key],
        ts,
        size,
        {"count": F.count("*"), f"last_{last}": F.max_by(last, order)},
    )


def status_counts_with_total(
    df: DataFrame, key: str, status: str, ts: str, size: str, slide: str | None = None
) -> DataFrame:
    """Per key and window one row per status: its count and the count of the whole window.

    Statuses are counted before the shuffle, so the second step only sees one entry per
    distinct status of a (key, window).
    """
    counted = df.groupBy(key, F.window(ts, size, slide).alias("_window"), status).agg(
        F.count("*").alias("status_count")
    )
    bounds = [F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")]
    if not df.isStreaming:
        total = F.sum("status_count").over(Window.partitionBy(key, "_window"))
        return counted.withColumn("window_count", total).select(
            key, *bounds, "window_count", status, "status_count"
        )
    # OVER is not allowed on a stream; a second aggregation on the same windows is
    return (
        counted.groupBy(key, "_window")
        .agg(
            F.collect_list(F.struct(status, "status_count")).alias("_statuses"),
            F.sum("status_count").alias("window_count"),
        )
        .select(key, *bounds, "window_count", F.inline("_statuses"))
    )


def session_status_counts(
    df: DataFrame, key: str, status: str, ts: str, gap: str, max_rows_per_task: int = HOT_KEY_ROWS
) -> DataFrame:
    """`status_counts_with_total` for session windows of a batch frame.

    Every row takes the latest session start of its key that is not after it, as a
    running maximum over starts and rows together; no row meets another row.
    """
    # kept, as its starts and its ends are both needed
    found = materialize(sessions(df, [key], ts, gap, {"window_count": ("count", F.lit(1))}, max_rows_per_task), "sessions")
    starts = found.select(
        key,
        F.col("window_start").alias("_ts"),
        F.lit(0).alias("_kind"),
        F.col("window_start").alias("_start"),
        F.lit(None).cast(df.schema[status].dataType).alias(status),
        F.lit(None).cast("bigint").alias("_count"),
    )
    moments = (
        df.groupBy(key, F.col(ts).alias("_ts"), status)
        .agg(F.count("*").alias("_count"))
        .withColumns({"_kind": F.lit(1), "_start": F.lit(None).cast(df.schema[ts].dataType)})
    )
    tagged = running(
        starts.unionByName(moments),
        [key],
        ["_ts", "_kind", status],
        {"window_start": ("max", "_start")},
        max_rows_per_task=max_rows_per_task,
    )
    counted = (
        tagged.filter("_kind = 1")
        .groupBy(key, "window_start", status)
        .agg(F.sum("_count").alias("status_count"))
    )
    ends = found.select(
        F.col(key).alias("_key"), F.col("window_start").alias("_start"), "window_end", "window_count"
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("window_start") == F.col("_start"))
    return counted.join(ends, same).select(
        key, "window_start", "window_end", "window_count", status, "status_count"
    )


def totals_over_windows(windows: DataFrame, key: str, count: str) -> DataFrame:
    """Total over all windows of each key; each window's count is taken once."""
    return windows.groupBy(key).agg(F.sum(count).alias("total"))


def global_total(df: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    """One window over all rows."""
    return df.groupBy().agg(*[agg.alias(name) for name, agg in aggregates.items()])
