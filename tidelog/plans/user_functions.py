"""User-defined functions, row maps and user aggregates."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tidelog.functions import udfs
from tidelog.operators import folds
from tidelog.operators import relational as r
from tidelog.plans.aggregates import _TOP2_SQL
from tidelog.plans.registry import EPOCH, query, table

def _add(state: tuple, rows: pd.DataFrame) -> tuple:
    return state[0] + int(rows["value"].count()), state[1] + float(rows["value"].sum())


# (count, sum) of a column, in parts; as in SQL, NULL is not counted and no value has no sum
COUNT_SUM = r.UserAggregate(
    create=lambda: (0, 0.0),
    accumulate=_add,
    merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
    finish=lambda state: [(state[0], state[1] if state[0] else None)],
    state="cnt bigint, total double",
    output="cnt bigint, total double",
)

# mean of a column, in parts
MEAN = r.UserAggregate(
    create=lambda: (0, 0.0),
    accumulate=_add,
    merge=COUNT_SUM.merge,
    finish=lambda state: [(state[1] / state[0] if state[0] else None,)],
    state="cnt bigint, total double",
    output="mean double",
)

# the two largest values, as up to two rows
TOP2 = r.UserAggregate(
    create=lambda: ([],),
    accumulate=lambda state, rows: (sorted([*state[0], *rows["value"].dropna().tolist()], reverse=True)[:2],),
    merge=lambda a, b: (sorted([*a[0], *b[0]], reverse=True)[:2],),
    finish=lambda state: [(value,) for value in state[0]],
    state="best array<double>",
    output="value double",
)


@query(
    "a12_user_count_sum",
    "SELECT event_type, count(value) AS cnt, round(sum(value), 4) AS total FROM events GROUP BY event_type",
)
def user_count_sum(spark, sf):
    out = r.user_aggregate(table(spark, sf, "events"), ["event_type"], ["value"], COUNT_SUM)
    return out.withColumn("total", F.round("total", 4))


@query("a13_user_top2", _TOP2_SQL)
def user_top2(spark, sf):
    return r.user_aggregate(table(spark, sf, "events"), ["user_id"], ["value"], TOP2)


def _week_mean_sql(key: str) -> str:
    return (
        f"SELECT {key}, time_bucket(INTERVAL 7 DAY, ts, {EPOCH}) AS window_start, round(avg(value), 6) AS mean "
        "FROM events GROUP BY ALL"
    )


@query("a14_pandas_window_mean", _week_mean_sql("event_type"))
def pandas_window_mean(spark, sf):
    events = table(spark, sf, "events").select(
        "event_type", F.window("ts", "7 days")["start"].alias("window_start"), "value"
    )
    out = r.user_aggregate(events, ["event_type", "window_start"], ["value"], MEAN)
    return out.withColumn("mean", F.round("mean", 6))


@query("a14_window_mean", _week_mean_sql("user_id"))
def window_mean(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", F.window("ts", "7 days")["start"].alias("window_start"), "value"
    )
    return r.group(events, ["user_id", "window_start"], {"mean": F.round(F.avg("value"), 6)})


@query("u1_scalar_udf", "SELECT page_id, CAST(length(url) AS INTEGER) AS size, contains(url, 'example') AS known FROM pages")
def scalar_udf(spark, sf):
    size = udfs.scalar(len, "int")
    known = udfs.scalar(lambda url: "example" in url, "boolean")
    return table(spark, sf, "pages").select("page_id", size("url").alias("size"), known("url").alias("known"))


@query("u1_udf_with_setup", "SELECT event_id, round(value * 1.5, 4) AS scaled FROM events")
def udf_with_setup(spark, sf):
    def setup():
        factor = 1.5
        return lambda values: values * factor

    scaled = udfs.with_setup(setup, "double")
    return table(spark, sf, "events").select("event_id", F.round(scaled("value"), 4).alias("scaled"))


@query("u2_sql_functions", "SELECT page_id, CAST(length(url) AS INTEGER) AS size FROM pages WHERE contains(url, 'net')")
def sql_functions(spark, sf):
    udfs.register(spark)
    return spark.sql(
        "SELECT page_id, text_length(url) AS size FROM {pages} WHERE contains_text(url, 'net')",
        pages=table(spark, sf, "pages"),
    )


@query("u3_table_function", "SELECT page_id, unnest(string_split(url, '/')) AS part FROM pages")
def table_function(spark, sf):
    udfs.register(spark)
    return spark.sql(
        "SELECT page_id, t.part FROM {pages}, LATERAL split_on(url, '/') t",
        pages=table(spark, sf, "pages").select("page_id", "url"),
    )


@query("u5_map_rows", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def map_rows(spark, sf):
    def parse(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"event_id": rows["event_id"], "k": [json.loads(p)["k"] for p in rows["props"]]})

    return udfs.map_rows(table(spark, sf, "events").select("event_id", "props"), parse, "event_id bigint, k bigint")


@query("u6_flat_map_rows", "SELECT page_id, unnest(string_split(url, '/')) AS part FROM pages")
def flat_map_rows(spark, sf):
    def parts(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(part=rows["url"].str.split("/")).explode("part")[["page_id", "part"]]

    pages = table(spark, sf, "pages").select("page_id", "url")
    return udfs.map_rows(pages, parts, "page_id bigint, part string")


def _stretch(state: tuple, rows: pd.DataFrame) -> tuple:
    values = rows["value"].dropna()
    if values.empty:
        return state[0] + len(rows), state[1], state[2]
    return state[0] + len(rows), min(state[1], float(values.min())), max(state[2], float(values.max()))


# count and spread of the elements of a window, in parts
SPREAD = r.UserAggregate(
    create=lambda: (0, float("inf"), float("-inf")),
    accumulate=_stretch,
    merge=lambda a, b: (a[0] + b[0], min(a[1], b[1]), max(a[2], b[2])),
    finish=lambda s: [(s[0], round(s[2] - s[1], 4) if s[1] <= s[2] else None)],
    state="n bigint, low double, high double",
    output="n bigint, spread double",
)


@query(
    "u7_window_function",
    f"SELECT event_type, time_bucket(INTERVAL 1 DAY, ts, {EPOCH}) AS window_start, count(*) AS n, "
    "round(max(value) - min(value), 4) AS spread FROM events GROUP BY ALL",
)
def window_function(spark, sf):
    """User code over the elements of each (key, window)."""
    events = table(spark, sf, "events").select(
        "event_type", F.window("ts", "1 day")["start"].alias("window_start"), "value"
    )
    return r.user_aggregate(events, ["event_type", "window_start"], ["value"], SPREAD)


def longest_rise(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of a window and the most of them that rise one after the other."""
    last, n, run, longest = None, 0, 0, 0
    for batch in batches:
        for value in batch.column("value").to_pylist():
            run = run + 1 if last is not None and value > last else 1
            longest, last, n = max(longest, run), value, n + 1
    columns = [pa.array([key[0]], pa.string()), pa.array([n]), pa.array([longest])]
    yield pa.RecordBatch.from_arrays(columns, names=["event_type", "n", "longest"])


@query(
    "u7_window_elements_in_order",
    f"""
    WITH marked AS (
      SELECT event_type, time_bucket(INTERVAL 60 DAY, ts, {EPOCH}) AS start, ts, event_id,
        CASE WHEN value > lag(value) OVER w THEN 0 ELSE 1 END AS fresh FROM events
      WINDOW w AS (PARTITION BY event_type, time_bucket(INTERVAL 60 DAY, ts, {EPOCH}) ORDER BY ts, event_id)),
    runs AS (SELECT *, sum(fresh) OVER (PARTITION BY event_type, start ORDER BY ts, event_id) AS run FROM marked),
    sizes AS (SELECT event_type, start, run, count(*) AS size FROM runs GROUP BY ALL)
    SELECT event_type, CAST(sum(size) AS BIGINT) AS n, max(size) AS longest FROM sizes GROUP BY event_type, start
    """,
)
def window_elements(spark, sf):
    """A function of the order of a window's elements, where a window holds a fifth of all rows."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return folds.apply_to_windows(
        events, ["event_type"], "ts", "60 days", ["ts", "event_id"], longest_rise, "event_type string, n bigint, longest bigint"
    )
