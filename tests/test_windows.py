from datetime import datetime
from statistics import fmean

from conftest import by_pump, rows, windowed
from pyspark.sql import functions as F

from tidelog.operators import ordered, windows
from tidelog.operators import relational as r
from tidelog.plans.registry import edge_message
from tidelog.plans.user_functions import MEAN
from tidelog.sources.messages import edge_log, with_edge_columns


def seconds(df, *columns):
    """Window bounds in whole seconds since the epoch."""
    return df.withColumns({c: F.unix_seconds(c) for c in ("window_start", "window_end")}).select(*columns)


def millis(df, *columns):
    return df.withColumns({c: F.unix_millis(c) for c in ("window_start", "window_end")}).select(*columns)


def moments(spark, pairs):
    df = spark.createDataFrame(pairs, "key string, ms bigint")
    return df.withColumn("ts", F.timestamp_millis("ms"))


def test_tumbling_sum(litres):
    out = windows.time_windows(litres, ["pump"], "ts", "5 seconds", {"total": F.sum("litres")})
    want = [(pump, start, start + 5, total) for (pump, start), total in windowed(5).items()]
    assert rows(seconds(out, "pump", "window_start", "window_end", "total")) == sorted(want, key=repr)


def test_mean_in_windows(litres):
    keyed = litres.withColumn("start", F.window("ts", "5 seconds")["start"]).withColumnRenamed("litres", "value")
    out = r.user_aggregate(keyed, ["pump", "start"], ["value"], MEAN)
    want = [(*key, mean) for key, mean in windowed(5, fold=fmean).items()]
    assert rows(out.select("pump", F.unix_seconds("start"), "mean")) == sorted(want, key=repr)


def test_sliding_sum(litres):
    out = windows.time_windows(litres, ["pump"], "ts", "6 seconds", {"total": F.sum("litres")}, "3 seconds")
    got = {(n, s): t for n, s, t in rows(seconds(out, "pump", "window_start", "total"))}
    assert got == windowed(6, 3)


def test_session_sum(litres):
    want = []
    for pump, data in by_pump(key=lambda n, row: row[0]).items():
        open_rows = []
        for ms, _, value in [*data, (10**9, pump, 0.0)]:
            if open_rows and ms - open_rows[-1][0] > 3500:
                want.append((pump, open_rows[0][0], open_rows[-1][0] + 3500, round(sum(v for _, v in open_rows), 4)))
                open_rows = []
            open_rows.append((ms, value))
    for most in (1, 1_000):
        out = ordered.sessions(litres, ["pump"], "ts", "3500 milliseconds", {"total": ("sum", "litres")}, most)
        assert rows(millis(out, "pump", "window_start", "window_end", "total")) == sorted(want, key=repr)


def test_millisecond_windows(spark):
    count = {"n": F.count("*")}
    tumble = moments(
        spark,
        [("b", 3), ("b", 17)] + [("a", ms) for ms in (0, 4, 5, 6, 11, 12, 13, 22)],
    )
    out = windows.time_windows(tumble, ["key"], "ts", "5 milliseconds", count)
    assert rows(millis(out, "key", "window_start", "n")) == [
        ("a", 0, 2),
        ("a", 10, 3),
        ("a", 20, 1),
        ("a", 5, 2),
        ("b", 0, 1),
        ("b", 15, 1),
    ]
    steps = (0, 4, 5, 6, 11, 12, 13, 22)
    slide = moments(spark, [("a", ms) for ms in steps])
    out = windows.time_windows(slide, ["key"], "ts", "6 milliseconds", count, "4 milliseconds")
    held = {start: sum(start <= ms < start + 6 for ms in steps) for start in range(-8, 28, 4)}
    assert dict(rows(millis(out, "window_start", "n"))) == {start: n for start, n in held.items() if n}


def test_millisecond_sessions(spark):
    count = {"n": ("count", F.lit(1))}
    df = moments(spark, [("a", ms) for ms in (2, 3, 6, 10, 11, 17, 30)])
    gap = F.concat(F.col("ms").cast("string"), F.lit(" milliseconds"))
    touching = moments(spark, [("a", 20), ("a", 25)])
    for most in (1, 1_000):
        out = ordered.sessions(df, ["key"], "ts", "5 milliseconds", count, most)
        assert rows(millis(out, "window_start", "window_end", "n")) == [(17, 22, 1), (2, 16, 5), (30, 35, 1)]
        out = ordered.sessions(df, ["key"], "ts", gap, count, most)
        assert rows(millis(out, "window_start", "window_end", "n")) == [(2, 60, 7)]
        out = ordered.sessions(touching, ["key"], "ts", "5 milliseconds", count, most)
        assert rows(millis(out, "window_start", "window_end", "n")) == [(20, 30, 2)]


def test_count_window(litres):
    out = ordered.count_windows(litres, ["pump"], ["seq"], 3, {"s": F.sum("litres")})
    want = [
        (pump, round(sum(v for _, _, v in data[n : n + 3]), 4))
        for pump, data in by_pump().items()
        for n in range(0, len(data) - 2, 3)
    ]
    assert rows(out.select("pump", "s")) == sorted(want, key=repr)


def test_max_over_two_preceding(litres):
    want = []
    for pump, data in by_pump(key=lambda n, row: row[0]).items():
        want += [(pump, ms, max(v for _, _, v in data[max(0, n - 2) : n + 1])) for n, (ms, _, _) in enumerate(data)]
    for most in (1, 1_000):
        out = ordered.over_preceding(litres, ["pump"], ["ts", "seq"], 2, {"top": F.max("litres")}, most)
        assert rows(out.select("pump", "ms", "top")) == sorted(want, key=repr)


def test_sum_per_row(litres):
    want = [
        (pump, round(sum(v for _, _, v in data[: n + 1]), 4))
        for pump, data in by_pump().items()
        for n in range(len(data))
    ]
    for most in (1, 1_000):
        out = ordered.running(litres, ["pump"], ["seq"], {"total": ("sum", "litres")}, max_rows_per_task=most)
        got = out.orderBy("pump", "seq").select("pump", "total").collect()
        assert [(x[0], round(x[1], 4)) for x in got] == sorted(want, key=lambda x: x[0])


def test_timers_at_end(litres):
    nameless = litres.filter("pump = 'south'").withColumn("pump", F.lit(None).cast("string"))
    want = [
        (name, ms, round(sum(v for _, _, v in data), 4))
        for pump, data in by_pump().items()
        for name in ([pump, None] if pump == "south" else [pump])
        for ms in {ms + 5000 for ms, _, _ in data}
    ]
    for most in (1, 3, 1_000):
        out = r.timers_with_total(litres.unionByName(nameless), "pump", "ts", "litres", moments_per_task=most)
        assert rows(out.select("pump", F.unix_millis("fired"), "total")) == sorted(want, key=repr)


LOGS = [
    ("o471", "/v3/test/", 200),
    ("o471", "/v2/test/", 201),
    ("o471", "/v3/test/", 200),
    ("o472", "/v2/test/", 201),
]


def edge_lines(spark):
    import json

    stamp = "2023-02-10T03:54:34Z"
    lines = [
        json.dumps(
            {
                "EdgeEndTimestamp": stamp,
                "ClientRequestURI": url,
                "EdgeResponseStatus": status,
                "ResponseHeaders": {"x-org-uid": org},
                "Unknown": 1,
            }
        )
        for org, url, status in LOGS
    ]
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_counts_per_org_with_last_date(spark):
    logs = edge_log(edge_lines(spark))
    out = windows.counts_with_last(logs, ["OrgUID"], "ClientRequestURI", "EventTime", "10 seconds", "EdgeEndTimestamp")
    stamp = "2023-02-10T03:54:34Z"
    assert rows(out.select("OrgUID", "ClientRequestURI", "count", "last_EdgeEndTimestamp")) == [
        ("o471", "/v2/test/", 1, stamp),
        ("o471", "/v3/test/", 2, stamp),
        ("o472", "/v2/test/", 1, stamp),
    ]
    out = windows.counts_with_last(logs, ["OrgUID"], "EdgeResponseStatus", "EventTime", "10 seconds", "EdgeEndTimestamp")
    assert rows(out.select("OrgUID", "EdgeResponseStatus", "count")) == [
        ("o471", 200, 2),
        ("o471", 201, 1),
        ("o472", 201, 1),
    ]


def test_status_counts(spark):
    data = [
        (1000, "/a", 200),
        (2000, "/b", 200),
        (3000, "/a", 404),
        (4000, "/e", 200),
        (8000, "/a", 500),
        (9000, "/b", 502),
        (15000, "/e", 200),
    ]
    df = spark.createDataFrame(data, "ms bigint, url string, status int")
    df = df.withColumn("ts", F.timestamp_millis("ms"))
    out = windows.status_counts_with_total(df, "url", "status", "ts", "5 seconds")
    want = sorted(
        [
            ("/a", 0, 200, 1, 2),
            ("/a", 0, 404, 1, 2),
            ("/a", 5, 500, 1, 1),
            ("/b", 0, 200, 1, 1),
            ("/b", 5, 502, 1, 1),
            ("/e", 0, 200, 1, 1),
            ("/e", 15, 200, 1, 1),
        ],
        key=repr,
    )
    got = out.select("url", F.unix_seconds("window_start"), "status", "status_count", "window_count")
    assert rows(got) == want
    per_window = out.select("url", "window_start", "window_count").distinct()
    assert rows(windows.totals_over_windows(per_window, "url", "window_count")) == [("/a", 3), ("/b", 2), ("/e", 2)]


def test_computed_columns(spark):
    events = spark.createDataFrame(
        [(5, datetime(2024, 1, 2, 3, 4, 5, 678901), 12, "view", '{"k": 7}')],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    )
    logs = edge_log(edge_message(events))
    got = logs.select("OrgUID", "DateStr", F.unix_micros("EventTime"), "EdgeResponseStatus").first()
    assert tuple(got) == ("2", "2024-01-02", 1704164645678901, 7)
    assert with_edge_columns(logs.drop("OrgUID", "DateStr", "EventTime")).columns == logs.columns
