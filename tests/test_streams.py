import pytest
from conftest import LITRES, by_pump, rows, windowed
from pyspark.sql import functions as F

from tidelog.operators import windows
from tidelog.sinks import files as sink
from tidelog.sinks.derived import DerivedTable
from tidelog.sinks.keyed import KeyedTable
from tidelog.sources import files, generate, messages
from tidelog.streaming import jobs, state


class Feed:
    """A folder that a stream reads; each `add` arrives as one file, so as one micro-batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.path, self.schema = spark, str(folder), schema

    def add(self, *rows):
        df = self.spark.createDataFrame(list(rows), self.schema)
        df.coalesce(1).write.mode("append").json(self.path)

    def read(self):
        return files.json_rows(self.spark, self.path, self.schema, stream=True, files_per_batch=1)


@pytest.fixture
def feed(spark, tmp_path):
    return lambda schema: Feed(spark, tmp_path / "in", schema)


def run(df, tmp_path, name="out"):
    path = str(tmp_path / name)
    jobs.to_files(df, path, f"{path}-checkpoint").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


# epoch milliseconds far after everything else: closes all windows and timers
FAR = 10_000_000


def test_windows_late_rows_and_closing(feed, tmp_path):
    late, kept, closing = (4_000, "north", 99.0), (18_500, "north", 5.5), (20_000, "south", 1.0)
    source = feed("ms bigint, name string, litres double")
    source.add(*LITRES)
    source.add(closing)
    source.add(late, kept)  # behind the watermark; not yet behind it
    source.add((FAR, "north", 0.0))
    timed = source.read().withColumn("ts", F.timestamp_millis("ms"))
    summed = windows.time_windows(
        windows.watermarked(timed, "ts", "3 seconds"), ["name"], "ts", "5 seconds", {"total": F.sum("litres")}
    )
    got = run(summed, tmp_path).select("name", F.unix_seconds("window_start").alias("s"), "total")
    want = [(*key, total) for key, total in windowed(5, data=[*LITRES, closing, kept]).items()]
    assert rows(got) == sorted(want, key=repr)


def test_session_stream(feed, tmp_path):
    source = feed("key string, ms bigint")
    source.add(*[("a", ms) for ms in (2, 3, 6, 10, 11, 17, 30)])
    source.add(("other", FAR))
    timed = windows.watermarked(source.read().withColumn("ts", F.timestamp_millis("ms")), "ts")
    counted = windows.session_windows(timed, ["key"], "ts", "5 milliseconds", {"n": F.count("*")})
    got = run(counted, tmp_path).select("key", F.unix_millis("window_start"), F.unix_millis("window_end"), "n")
    assert rows(got) == [("a", 17, 22, 1), ("a", 2, 16, 5), ("a", 30, 35, 1)]


def test_status_counts_stream_equals_batch(spark, feed, tmp_path):
    source = feed("url string, ms bigint, status int")
    source.add(("/a", 1000, 200), ("/b", 2000, 200), ("/a", 3000, 404), ("/a", 3500, 200))
    source.add(("/a", 8000, 500), ("/b", 9000, 502), ("/z", FAR, 0))
    timed = windows.watermarked(source.read().withColumn("ts", F.timestamp_millis("ms")), "ts")
    out = windows.status_counts_with_total(timed, "url", "status", "ts", "5 seconds")
    batch = spark.read.schema(source.schema).json(source.path).withColumn("ts", F.timestamp_millis("ms"))
    want = windows.status_counts_with_total(batch, "url", "status", "ts", "5 seconds").filter("url <> '/z'")
    assert rows(run(out, tmp_path).filter("url <> '/z'")) == rows(want)


def test_running_sum_state(feed, tmp_path):
    """Rows in order of arrival, over two micro-batches, one of them without a number."""
    source = feed("id bigint, name string, litres double")
    numbered = [(n, pump, litres) for n, (_, pump, litres) in enumerate(LITRES)]
    source.add(*numbered[:4], (100, "yard", None))
    source.add(*numbered[4:], (101, "south", None))
    out = run(state.running_reduce(source.read(), "name", "litres", "id"), tmp_path)
    got = sorted((k, i, t if t is None else round(t, 4)) for k, i, t in out.collect() if i < 100)
    want, totals = [], {}
    for n, pump, litres in numbered:
        totals[pump] = totals.get(pump, 0) + litres
        want.append((pump, n, round(totals[pump], 4)))
    assert got == sorted(want)
    assert {i: t for _, i, t in out.collect() if i >= 100} == {100: None, 101: totals["south"]}


def test_state_expires(spark, feed, tmp_path):
    import time

    source = feed("id bigint, name string, amount double")
    source.add((1, "lock", 1.0))
    sums = state.running_reduce(source.read(), "name", "amount", "id", ttl_ms=2_000)
    path = str(tmp_path / "out")

    def store(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    for _ in range(2):
        jobs.run_until_idle(jobs.to_batches(sums, store, f"{path}-checkpoint", every="200 milliseconds"))
        time.sleep(3)
        source.add((2, "lock", 5.0))
    got = rows(spark.read.schema(sums.schema).parquet(path).select("id", "total"))
    assert got == [(1, 1.0), (2, 5.0)]


def test_timers(feed, tmp_path):
    source = feed("ms bigint, name string, litres double")
    source.add(*LITRES, (700, "yard", None))
    source.add((FAR, "far", 0.0))
    timed = windows.watermarked(source.read().withColumn("ts", F.timestamp_millis("ms")), "ts", "2 seconds")
    out = run(state.sum_on_timer(timed, "name", "litres", "ms"), tmp_path)
    want = [
        (pump, ms, round(sum(v for _, _, v in data), 4))
        for pump, data in by_pump().items()
        for ms in {ms + 5000 for ms, _, _ in data} | ({5700} if pump == "yard" else set())
    ]
    assert rows(out.filter("name <> 'far'")) == sorted(want, key=repr)


def test_count_window_and_missing_numbers(feed, tmp_path):
    pairs = feed("v double, key string")
    numbers = {"a": [4.0, None, 1.5, 2.0, 8.0], "b": [None, None, 3.0], "c": [7.0]}
    rows_in = [(v, k) for k, values in numbers.items() for v in values]
    pairs.add(*rows_in[:4])
    pairs.add(*rows_in[4:])
    out = run(state.count_window_sums(pairs.read(), "key", "v", 2), tmp_path)
    assert rows(out) == sorted([("a", 0, 4.0), ("a", 1, 3.5), ("b", 0, None)], key=repr)


def test_top_values_and_missing_numbers(feed, tmp_path):
    source = feed("v double, key string")
    source.add((4.0, "a"), (None, "a"), (9.5, "a"), (None, "b"))
    out = state.top_values(source.read(), "key", "v", 2)
    path = str(tmp_path / "top")
    jobs.upsert(out, path, ["key", "rank"], f"{path}-c").awaitTermination()
    assert rows(KeyedTable(source.spark, path, ["key", "rank"]).read()) == [("a", 1, 9.5), ("a", 2, 4.0)]


def test_max_over_preceding_out_of_order(feed, tmp_path):
    source = feed("ms bigint, name string, litres double, id bigint")
    source.add(*[(*p, i) for i, p in enumerate(LITRES)], (14_000, "yard", None, 50))
    source.add((FAR, "far", 0.0, 100))
    timed = windows.watermarked(source.read().withColumn("ts", F.timestamp_millis("ms")), "ts", "3 seconds")
    out = run(state.max_over_preceding(timed, "name", "litres", "ms", "id"), tmp_path)
    got = sorted((x[0], x[2], x[3]) for x in out.collect() if x[0] != "far")
    want = [("yard", 14_000, 2.0)]
    for pump, data in by_pump(key=lambda n, row: row[0]).items():
        want += [(pump, ms, max(v for _, _, v in data[max(0, n - 2) : n + 1])) for n, (ms, _, _) in enumerate(data)]
    assert got == sorted(want)


def test_upserts_survive_a_restart(spark, feed, tmp_path):
    source = feed("org string, status int, id bigint")
    replace, add, last = (str(tmp_path / n) for n in ("replace", "add", "last"))

    def run_all():
        counts = source.read().groupBy("org").agg(F.count("*").alias("n"))
        jobs.upsert(counts, replace, ["org"], f"{replace}-c", name="replace").awaitTermination()
        ones = source.read().select("org", F.lit(1).alias("n"))
        jobs.upsert(ones, add, ["org"], f"{add}-c", {"n": "sum"}, mode="append").awaitTermination()
        jobs.upsert(
            source.read(), last, ["org"], f"{last}-c", sequence=["id"], mode="append"
        ).awaitTermination()

    source.add(("a", 200, 1), ("a", 201, 2), ("b", 500, 3))
    run_all()
    source.add(("a", 404, 5), ("c", 200, 6))
    source.add(("a", 302, 4))
    run_all()
    run_all()  # nothing new
    want = [("a", 4), ("b", 1), ("c", 1)]
    table = KeyedTable(spark, add, ["org"], {"n": "sum"})
    assert rows(KeyedTable(spark, replace, ["org"]).read()) == want
    assert rows(table.read()) == want
    newest = KeyedTable(spark, last, ["org"], sequence=["id"]).read()
    assert rows(newest) == [("a", 404, 5), ("b", 500, 3), ("c", 200, 6)]
    table.compact()
    assert rows(table.read()) == want


def test_keyed_table_replays_and_failures(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], {"n": "sum", "top": "max"})
    assert table.read() is None
    first = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("b", 1, 1)], "k string, n bigint, top int")
    table.upsert(first, 0)
    table.upsert(first, 0)  # the batch ran again
    assert rows(table.read()) == [("a", 3, 5), ("b", 1, 1)]
    table.upsert(spark.createDataFrame([("a", 10, 9)], "k string, n bigint, top int"), 1)
    # a batch that did not finish
    (tmp_path / "t" / "batches" / "batch=2").mkdir()
    assert rows(table.read()) == [("a", 13, 9), ("b", 1, 1)]
    assert rows(table.read(before=1)) == [("a", 3, 5), ("b", 1, 1)]
    table.compact()
    table.upsert(first, 1)  # already in the base
    table.upsert(spark.createDataFrame([("c", 7, 7)], "k string, n bigint, top int"), 3)
    assert rows(table.read()) == [("a", 13, 9), ("b", 1, 1), ("c", 7, 7)]


def test_snapshots(spark, feed, tmp_path):
    source = feed("org string, url string")
    path = str(tmp_path / "snapshots")
    for _ in range(3):
        source.add(*[(f"o{n % 3}", f"/u{n % 4}") for n in range(100)])
    counts = source.read().groupBy("org", "url").agg(F.count("*").alias("n"))
    jobs.snapshots(counts, path, f"{path}-c").awaitTermination()
    stored = spark.read.parquet(path)
    totals = stored.groupBy("snapshot_id").agg(F.count("*").alias("groups"), F.sum("n").alias("total"))
    assert [t[1:] for t in rows(totals)] == [(12, 100), (12, 200), (12, 300)]


def test_fan_out_and_report(spark, feed, tmp_path):
    source = feed("id bigint, data string")
    source.add((5, "buoy"), (6, "anchor"), (7, "buoy chain"), (8, None), (9, "red buoy"))
    low, named = str(tmp_path / "low"), str(tmp_path / "named")
    branches = {
        low: lambda b: b.filter("id < 7"),
        named: lambda b: b.filter(F.col("data").contains("buoy")),
    }
    jobs.fan_out(source.read(), branches, str(tmp_path / "c")).awaitTermination()
    assert [r[0] for r in rows(spark.read.parquet(low).select("id"))] == [5, 6]
    assert [r[0] for r in rows(spark.read.parquet(named).select("id"))] == [5, 7, 9]

    counts = spark.createDataFrame([("o472", "/v2/test/", 1)], "x_org_uid string, ClientRequestURI string, url_count int")
    report = tmp_path / "report"
    sink.write_report(counts, str(report), one_file=True)
    (part,) = report.glob("part-*.csv")
    assert part.read_text() == "x_org_uid,ClientRequestURI,url_count\no472,/v2/test/,1\n"


def test_running_batches_across_restarts(spark, feed, tmp_path):
    source = feed("id bigint, k string, v bigint")
    path = str(tmp_path / "running")

    def go(most):
        return jobs.running_batches(
            source.read(), ["k"], ["id"], {"s": ("sum", "v"), "n": ("count", "v")}, path, f"{path}-c",
            previous=True, max_rows_per_task=most,
        )

    source.add((1, "a", 1), (2, "a", 2), (3, "b", 5))
    go(100).awaitTermination()
    source.add((4, "a", 4), (5, "c", 1), (6, "a", None), (7, None, 3))
    go(1).awaitTermination()
    source.add((8, None, 4), (9, "b", 5))
    go(1).awaitTermination()
    schema = "id bigint, k string, v bigint, s bigint, n bigint, previous_s bigint, previous_n bigint"
    got = spark.read.schema(schema).parquet(path).select("id", "k", "s", "n", "previous_s")
    assert rows(got) == [
        (1, "a", 1, 1, None),
        (2, "a", 3, 2, 1),
        (3, "b", 5, 1, None),
        (4, "a", 7, 3, 3),
        (5, "c", 1, 1, None),
        (6, "a", 7, 3, 7),
        (7, None, 3, 1, None),
        (8, None, 7, 2, 3),
        (9, "b", 10, 2, 5),
    ]


def test_generated_rows(spark):
    ints = generate.random_ints(spark, "word_id", 0, 17, rows=500)
    low, high = ints.agg(F.min("word_id"), F.max("word_id")).first()
    assert (low, high) == (0, 17) and ints.count() == 500
    assert generate.random_ints(spark, "num", 0, 9, rows_per_second=5).isStreaming


def test_pandas_round_trip(spark):
    import numpy as np
    import pandas as pd

    frame = pd.DataFrame(np.random.default_rng(0).random((1000, 2)), columns=["a", "b"])
    df = generate.from_pandas(spark, frame, "a double, b double")
    assert generate.to_pandas(df, most=1_000).sort_values("a", ignore_index=True).equals(
        frame.sort_values("a", ignore_index=True)
    )
    with pytest.raises(ValueError, match="more than 10"):
        generate.to_pandas(df, most=10)


def test_message_log_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.message_log(spark, "localhost:1", "logs", start="latest", per_batch=10)


def test_console_sink(feed, tmp_path):
    source = feed("id bigint")
    source.add((1,), (2,))
    query = jobs.to_console(source.read(), str(tmp_path / "c"))
    query.awaitTermination()
    assert query.exception() is None and query.lastProgress["numInputRows"] == 2


def _sums(table):
    return {k: n for k, n in rows(table.read())}


def test_a_new_checkpoint_adds_to_what_is_there(spark, feed, tmp_path):
    """Another checkpoint counts its micro-batches from 0 again, also after a compaction."""
    path = str(tmp_path / "sums")
    source = feed("k string, n bigint")
    table = KeyedTable(spark, path, ["k"], {"n": "sum"})
    source.add(("a", 1), ("b", 2))
    for run_number, compacted in enumerate((False, True, False)):
        jobs.upsert(
            source.read(), path, ["k"], f"{path}-c{run_number}", {"n": "sum"}, mode="append"
        ).awaitTermination()
        assert _sums(table) == {"a": run_number + 1, "b": 2 * (run_number + 1)}
        if compacted:
            table.compact()
            assert _sums(table) == {"a": run_number + 1, "b": 2 * (run_number + 1)}


def test_snapshots_and_branches_of_a_new_checkpoint_stay_beside_the_old(spark, feed, tmp_path):
    source = feed("k string")
    source.add(("a",), ("b",))
    counts, copies = str(tmp_path / "counts"), str(tmp_path / "copies")
    for n in range(2):
        jobs.snapshots(source.read().groupBy("k").count(), counts, f"{counts}-c{n}").awaitTermination()
        jobs.fan_out(source.read(), {copies: lambda b: b}, f"{copies}-c{n}").awaitTermination()
    assert spark.read.parquet(counts).select("snapshot_id").distinct().count() == 2
    assert spark.read.parquet(copies).count() == 4


def test_a_replayed_batch_counts_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], {"n": "sum"})
    batch = spark.createDataFrame([("a", 1)], "k string, n bigint")
    for number in range(4):
        table.upsert(batch, number, "writer")
    table.compact()
    table.upsert(batch, 3, "writer")
    assert _sums(table) == {"a": 4}


def test_many_batches_leave_few_to_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable(spark, path, ["k"], {"n": "sum"})
    batch = spark.createDataFrame([("a", 1)], "k string, n bigint").coalesce(1)
    for number in range(30):
        table.upsert(batch, number, "writer")
        if table.open_batches() >= 10:
            table.compact()
        assert table.open_batches() < 10
    assert _sums(table) == {"a": 30}
    assert len(list((tmp_path / "t" / "batches").glob("batch=*"))) <= 20
    assert len(list((tmp_path / "t" / "bases").glob("upto=*"))) <= 2


def test_deletes(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], sequence=["seq"], deleted="op = 'D'")
    schema = "k string, v int, seq int, op string"
    table.upsert(spark.createDataFrame([("a", 1, 1, "I"), ("b", 1, 2, "I")], schema), 0)
    table.upsert(spark.createDataFrame([("a", None, 5, "D"), ("b", 7, 6, None)], schema), 1)
    table.upsert(spark.createDataFrame([("a", 9, 4, "U")], schema), 2)  # older than the delete
    for _ in range(2):
        assert rows(table.rows().select("k", "v")) == [("b", 7)]
        table.compact()
    table.upsert(spark.createDataFrame([("a", 3, 8, "I")], schema), 3)
    assert rows(table.rows().select("k", "v")) == [("a", 3), ("b", 7)]


def bounded(df, tmp_path, ended, name="out"):
    path = str(tmp_path / name)
    jobs.run_bounded(lambda: jobs.to_files(df, path, f"{path}-checkpoint"), ended, df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def test_a_bounded_stream_leaves_nothing_open(feed, tmp_path):
    """Windows, sessions, timers and rows that wait come out as in batch, also when the run is repeated."""
    source = feed("ms bigint, name string, litres double, id bigint")
    source.add(*[(*row, n) for n, row in enumerate(LITRES)], (None, "north", 5.0, 99))
    ended = str(tmp_path / "ended")
    timed = source.read().withColumn("ts", F.timestamp_millis("ms"))
    timed = windows.watermarked(timed, "ts", "3 seconds", ended)
    summed = windows.time_windows(timed, ["name"], "ts", "5 seconds", {"total": F.sum("litres")})
    for _ in range(2):
        got = bounded(summed, tmp_path, ended).select("name", F.unix_seconds("window_start").alias("s"), "total")
        assert rows(got) == sorted([(*key, total) for key, total in windowed(5).items()], key=repr)
    sessions = windows.session_windows(timed, ["name"], "ts", "4 seconds", {"n": F.count("*")})
    got = bounded(sessions, tmp_path, ended, "sessions").agg(F.sum("n"), F.count("*"))
    assert rows(got) == [(len(LITRES), 4)]  # north pauses once
    out = bounded(state.sum_on_timer(timed, "name", "litres", "ms"), tmp_path, ended, "timers")
    assert {(r["name"], r["fired_ms"]) for r in out.collect()} == {(name, ms + 5_000) for ms, name, _ in LITRES}
    out = bounded(state.max_over_preceding(timed, "name", "litres", "ms", "id"), tmp_path, ended, "last")
    assert sorted(r["id"] for r in out.collect()) == list(range(len(LITRES)))


@pytest.fixture
def small_frames(spark, monkeypatch):
    """Rows of a key come in frames of three, and are sorted in slices of seven."""
    monkeypatch.setattr(state, "ROWS_PER_SLICE", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_composite_keys_of_any_type_in_the_order_of_a_column(small_frames, feed, tmp_path):
    import datetime
    import random

    day = datetime.date(2024, 2, 29)
    pick = random.Random(3)
    rows_in = [(n, pick.choice(["a", None]), pick.choice([day, None]), pick.choice([n % 9, None])) for n in range(90)]
    source = feed("id bigint, org string, day date, n bigint")
    first, second = rows_in[:60], rows_in[60:]
    for part in (first, second):
        source.add(*pick.sample(part, len(part)))
    keys = ["org", "day"]
    reduced = state.running_reduce(source.read(), keys, "n", "id", lambda a, b: a * 3 - b, order="id")
    want, totals = [], {}
    for i, org, d, n in rows_in:
        if n is not None:
            held = totals.get((org, d))
            totals[org, d] = n if held is None else held * 3 - n
        want.append((org, d, i, totals.get((org, d))))
    assert rows(run(reduced, tmp_path)) == sorted(want, key=repr)
    sums = state.count_window_sums(source.read(), keys, "n", 4, order="id")
    want = []
    for key in {(org, d) for _, org, d, _ in rows_in}:
        mine = [n for _, org, d, n in rows_in if (org, d) == key]
        for no in range(len(mine) // 4):
            known = [n for n in mine[4 * no : 4 * no + 4] if n is not None]
            want.append((*key, no, sum(known) if known else None))
    assert rows(run(sums, tmp_path, "sums")) == sorted(want, key=repr)


def test_rows_of_a_large_key_wait_in_slices(small_frames, feed, tmp_path):
    import random

    pick = random.Random(8)
    rows_in = [(n, pick.randrange(1, 41) * 250, pick.choice([pick.randrange(100), None])) for n in range(120)]
    source = feed("id bigint, ms bigint, v int")
    for k in range(3):
        source.add(*rows_in[40 * k : 40 * k + 40])
    timed = source.read().withColumns({"ts": F.timestamp_millis("ms"), "key": F.lit("hot")})

    def ending(name):
        return windows.watermarked(timed, "ts", "1 hour", str(tmp_path / name))

    out = bounded(state.max_over_preceding(ending("a"), "key", "v", "ms", "id", 3), tmp_path, str(tmp_path / "a"))
    ordered = sorted(rows_in, key=lambda r: (r[1], r[0]))
    want = []
    for n, (i, ms, _) in enumerate(ordered):
        known = [v for _, _, v in ordered[max(0, n - 3) : n + 1] if v is not None]
        want.append(("hot", i, ms, max(known) if known else None))
    assert rows(out) == sorted(want, key=repr)
    out = bounded(state.sum_on_timer(ending("b"), "key", "v", "ms", 100), tmp_path, str(tmp_path / "b"), "timers")
    total = sum(v for _, _, v in rows_in if v is not None)
    assert rows(out) == sorted([("hot", ms, total) for ms in {ms + 100 for _, ms, _ in rows_in}], key=repr)


def test_state_of_several_keys_expires(spark, feed, tmp_path):
    import time

    source = feed("org string, day string, url string")
    path = str(tmp_path / "out")

    def store(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    for turn in range(2):
        source.add(("o", "d1", "/a"), ("o", "d1", "/a"), ("o", "d2", "/a"))
        counts = state.count_with_expiry(source.read(), ["org", "day", "url"], 2_000)
        jobs.run_until_idle(jobs.to_batches(counts, store, f"{path}-checkpoint", "update", every="200 milliseconds"))
        time.sleep(3 * (1 - turn))
    got = [r[:4] for r in rows(spark.read.schema(counts.schema).parquet(path))]
    assert sorted(got) == [("o", "d1", "/a", 2)] * 2 + [("o", "d2", "/a", 1)] * 2


def test_late_rows_are_told_apart(feed, tmp_path):
    source = feed("ms bigint, name string, litres double")
    source.add((10_000, "on time", 0.1), (20_000, "moves the watermark", 0.25), (None, "without time", None))
    source.add((14_999, "late", 0.1), (17_000, "at the border", 0.2), (17_001, "still in time", 0.3))
    timed = windows.watermarked(source.read().withColumn("ts", F.timestamp_micros(F.col("ms") * 1000 + 7)), "ts", "3 seconds")
    out = run(state.marked_late(timed, F.col("ts")), tmp_path).select("name", "litres", F.unix_micros("ts").alias("us"), "late")
    assert rows(out) == sorted(
        [
            ("on time", 0.1, 10_000_007, False),
            ("moves the watermark", 0.25, 20_000_007, False),
            ("without time", None, None, False),
            ("late", 0.1, 14_999_007, True),
            ("at the border", 0.2, 17_000_007, True),
            ("still in time", 0.3, 17_001_007, False),
        ],
        key=repr,
    )


def test_only_touched_buckets_are_read_and_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable(spark, path, ["k"], {"n": "sum"}, buckets=8)
    everything = spark.range(100).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("n"))
    table.upsert(everything, 0)
    table.compact()
    few = everything.filter("k < 2")
    touched = table.buckets_of(few)
    assert 1 <= len(touched) <= 2
    files_read = table.read(buckets=touched).inputFiles()
    assert files_read and all(any(f"_bucket={b}/" in f for b in touched) for f in files_read)
    table.upsert(few, 1)
    table.compact()
    rewritten = {p.name for p in (tmp_path / "t" / "bases" / "upto=1").glob("_bucket=*")}
    assert rewritten == {f"_bucket={b}" for b in touched}
    for number in range(2, 6):
        table.upsert(everything.filter(F.col("k") == number), number)
        table.compact()
        assert KeyedTable(spark, path, ["k"], {"n": "sum"}).buckets == 8
    assert _sums(table) == {k: 2 if k < 6 else 1 for k in range(100)}
    # every bucket has one base that counts and at most one older
    held = [p.name for p in (tmp_path / "t" / "bases").glob("upto=*/_bucket=*")]
    assert max(held.count(name) for name in held) <= 2
    table.upsert(everything.limit(0), 6)
    assert _sums(table)[99] == 1


BOOKS = "id bigint, text string, seq bigint, op string"


def _chapters(parents):
    return parents.select("id", F.posexplode(F.split("text", "/")).alias("no", "chapter"))


def test_children_follow_their_parents(spark, feed, tmp_path):
    """Books get shorter, longer, vanish and come back; changes come late and twice; the job restarts and is made anew."""
    source = feed(BOOKS)
    path = str(tmp_path / "chapters")

    def go(checkpoint="c", every=10):
        return jobs.derive(
            source.read(), path, ["id"], ["seq"], _chapters, f"{path}-{checkpoint}", buckets=4, compact_every=every
        ).awaitTermination()

    def now():
        return rows(DerivedTable(spark, path, ["id"], ["seq"], "op = 'D'").read())

    source.add((1, "a/b/c", 1, "I"), (2, "d", 1, "I"), (3, "e/f", 1, "I"), (None, "n/m", 1, "I"))
    go()
    assert now() == sorted([(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "d"), (3, 0, "e"), (3, 1, "f"), (None, 0, "n"), (None, 1, "m")], key=repr)
    source.add((1, "A", 5, "U"), (1, "x/y", 4, "U"), (2, None, 2, "D"), (None, "N", 2, "U"))
    source.add((3, "old/old/old", 0, "U"), (2, "late", 1, "U"))
    go(every=1)
    want = sorted([(1, 0, "A"), (3, 0, "e"), (3, 1, "f"), (None, 0, "N")], key=repr)
    assert now() == want
    source.add((2, "again/d", 9, "I"), (4, None, 1, "D"))
    go()
    want = sorted([*want, (2, 0, "again"), (2, 1, "d")], key=repr)
    assert now() == want
    go("another")
    assert now() == want
    DerivedTable(spark, path, ["id"], ["seq"], "op = 'D'").compact()
    assert now() == want


def test_a_replayed_batch_of_changes_adds_nothing(spark, tmp_path):
    table = DerivedTable(spark, str(tmp_path / "t"), ["id"], ["seq"], "op = 'D'")
    assert table.read() is None
    first = spark.createDataFrame([(1, "a/b", 1, "I")], BOOKS)
    second = spark.createDataFrame([(1, "c", 2, "U")], BOOKS)
    for number, batch in enumerate((first, first, second, second)):
        table.apply(batch, _chapters, number // 2)
    assert rows(table.read()) == [(1, 0, "c")]
    table.apply(spark.createDataFrame([(1, None, 3, "D")], BOOKS), _chapters, 2)
    assert rows(table.read()) == []
    table.compact()
    assert rows(table.read()) == []


def test_micro_batches_follow_the_size_of_a_folder(spark, tmp_path):
    """A folder a hundred times as large takes as many micro-batches, none above the bound."""
    from tidelog.sources import files
    from tidelog.streaming import jobs

    numbers = {}
    for n in (10_000, 1_000_000):
        rows, path = spark.range(0, n, 1, 2), f"{tmp_path}/{n}"
        rows.write.option("maxRecordsPerFile", files.rows_per_file(rows, 100, batches=4)).option("compression", "none").parquet(path)
        bound = files.batch_bytes(spark, path, 1_000, batches=4)
        stream = files.parquet_rows(spark, path, stream=True, bytes_per_batch=bound)
        jobs.fan_out(stream, {f"{path}-out": lambda batch: batch}, f"{path}-checkpoint").awaitTermination()
        sizes = [r["count"] for r in spark.read.parquet(f"{path}-out").groupBy("batch").count().collect()]
        assert sum(sizes) == n and max(sizes) * 8 <= bound
        numbers[n] = len(sizes)
    assert max(numbers.values()) <= 8 and numbers[10_000] >= 4
    assert files.batch_bytes(spark, path, 1_000, most=5_000) == 5_000


@pytest.mark.parametrize("name", ["reduce", "count", "last"])
def test_state_of_many_keys_lies_in_groups(spark, tmp_path, name):
    """What is called and stored grows with the groups and not with the keys."""
    from tidelog.operators import windows
    from tidelog.sources import files
    from tidelog.streaming import jobs, state

    n = 3_000
    rows = spark.range(0, 2 * n, 1, 1).select(
        (F.col("id") % n).alias("key"), F.col("id"), F.lit(1.5).alias("v"), F.timestamp_millis(F.col("id") + 1).alias("ts")
    )
    rows.write.parquet(f"{tmp_path}/in")
    stream = files.parquet_rows(spark, f"{tmp_path}/in", stream=True)
    if name == "reduce":
        out = state.running_reduce(stream, "key", "v", "id", order="id")
    elif name == "count":
        out = state.count_window_sums(stream, "key", "v", 2, order="id")
    else:
        timed = windows.watermarked(stream, "ts").withColumn("ms", F.unix_millis("ts"))
        out = state.max_over_preceding(timed, "key", "v", "ms", "id")
    query = jobs.to_files(out, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert out.schema == spark.read.schema(out.schema).parquet(f"{tmp_path}/out").schema
    assert spark.read.parquet(f"{tmp_path}/out").select("key").distinct().count() >= n - 1
    (held,) = query.lastProgress["stateOperators"]
    assert held["numRowsTotal"] <= 4 * state.KEY_GROUPS
