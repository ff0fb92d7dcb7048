"""Ordered work with and without a cut into slices, against brute force."""

import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog.operators import ordered, windows
from tidelog.session import cleanup, materialize

START = datetime(2024, 1, 1)


def make(seed, n=400, copies=0):
    """Rows of few keys: one key holds most of them, NULL is a key, some times coincide."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = rng.choices(["hot", "b", "c", None, f"k{i}"], [60, 15, 10, 5, 10])[0]
        moment = START + timedelta(seconds=rng.choice([5, 5, 5, rng.randrange(4000)]))
        out.append((i, key, moment, float(rng.randrange(100)), rng.randrange(1, 60)))
    out += [(n + j, "hot", START + timedelta(seconds=7), 1.0, 3) for j in range(copies)]
    return out


def frame(spark, data):
    return spark.createDataFrame(
        data, "id bigint, k string, ts timestamp_ntz, v double, gap int"
    ).repartition(5)


def by_key(data):
    keys = {}
    for row in sorted(data, key=lambda x: (x[2], x[0])):
        keys.setdefault(row[1], []).append(row)
    return keys


CUTS = [10**6, 40, 7]


@pytest.mark.parametrize("most", CUTS)
def test_running(spark, most):
    data = make(1)
    out = ordered.running(
        frame(spark, data),
        ["k"],
        ["ts", "id"],
        {"s": ("sum", "v"), "n": ("count", F.lit(1)), "lo": ("min", "v"), "hi": ("max", "v")},
        previous=True,
        max_rows_per_task=most,
    )
    want = []
    for key, items in by_key(data).items():
        for i, row in enumerate(items):
            now, before = [x[3] for x in items[: i + 1]], [x[3] for x in items[:i]]
            old = (sum(before), len(before), min(before), max(before)) if before else (None, None, None, None)
            want.append((row[0], key, sum(now), len(now), min(now), max(now), old[0], old[2]))
    got = out.select("id", "k", "s", "n", "lo", "hi", "previous_s", "previous_lo")
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("most", CUTS)
@pytest.mark.parametrize("preceding", [2, 9])
def test_over_preceding(spark, most, preceding):
    data = make(2)
    out = ordered.over_preceding(
        frame(spark, data),
        ["k"],
        ["ts", "id"],
        preceding,
        {"top": F.max("v"), "n": F.count("*")},
        most,
    )
    want = []
    for items in by_key(data).values():
        for i, row in enumerate(items):
            near = [x[3] for x in items[max(0, i - preceding) : i + 1]]
            want.append((row[0], max(near), len(near)))
    assert rows(out.select("id", "top", "n")) == sorted(want, key=repr)


@pytest.mark.parametrize("most", CUTS)
def test_count_windows(spark, most):
    data = make(3)
    out = ordered.count_windows(frame(spark, data), ["k"], ["ts", "id"], 3, {"s": F.sum("v")}, most)
    want = []
    for key, items in by_key(data).items():
        for no in range(len(items) // 3):
            want.append((key, no, sum(x[3] for x in items[3 * no : 3 * no + 3])))
    assert rows(out) == sorted(want, key=repr)


def brute_sessions(data, gap_of):
    want = []
    for key, items in by_key(data).items():
        held = None
        for row in items:
            end = row[2] + timedelta(seconds=gap_of(row))
            if held and row[2] <= held[1]:
                held = [held[0], max(held[1], end), held[2] + 1, held[3] + row[3]]
            else:
                if held:
                    want.append((key, *held))
                held = [row[2], end, 1, row[3]]
        want.append((key, *held))
    return sorted(want, key=repr)


@pytest.mark.parametrize("most", CUTS)
@pytest.mark.parametrize("copies", [0, 300])
@pytest.mark.parametrize("fixed", [8, None])
def test_sessions(spark, most, copies, fixed):
    """A gap of `fixed` seconds, or of one per row."""
    data = make(4, copies=copies)
    gap = f"{fixed} seconds" if fixed else F.concat(F.col("gap").cast("string"), F.lit(" seconds"))
    out = ordered.sessions(
        frame(spark, data), ["k"], "ts", gap, {"n": ("count", F.lit(1)), "s": ("sum", "v")}, most
    )
    assert rows(out) == brute_sessions(data, lambda row: fixed or row[4])


@pytest.mark.parametrize("most", CUTS)
def test_session_over_many_slices(spark, most):
    """One row's long gap spans everything after it."""
    data = make(5)
    data.append((9_999, "hot", START, 0.0, 10_000))
    gap = F.concat(F.col("gap").cast("string"), F.lit(" seconds"))
    out = ordered.sessions(frame(spark, data), ["k"], "ts", gap, {"n": ("count", F.lit(1)), "s": ("sum", "v")}, most)
    assert rows(out) == brute_sessions(data, lambda row: row[4])


@pytest.mark.parametrize("most", CUTS)
def test_session_status_counts(spark, most):
    data = [(i, k, t, v % 3, g) for i, k, t, v, g in make(6, copies=50)]
    out = windows.session_status_counts(
        frame(spark, data).withColumnRenamed("v", "status"), "k", "status", "ts", "20 seconds", most
    )
    want = []
    for key, start, end, count, _ in brute_sessions(data, lambda row: 20):
        inside = [row for row in data if row[1] == key and start <= row[2] <= end]
        assert len(inside) == count
        for status in {row[3] for row in inside}:
            want.append((key, start, end, count, status, sum(row[3] == status for row in inside)))
    assert rows(out) == sorted(want, key=repr)


def test_empty_input(spark):
    empty = frame(spark, make(7)).filter("id < 0")
    assert ordered.running(empty, ["k"], ["ts", "id"], {"s": ("sum", "v")}).count() == 0
    assert ordered.sessions(empty, ["k"], "ts", "5 seconds", {"s": ("sum", "v")}).count() == 0


def test_only_large_keys_are_stored(spark, monkeypatch):
    """Rows of other keys stay in plain windows, and types without an order pass through."""
    data = make(8)
    stored = []

    def watched(df, name):
        stored.append(materialize(df, name))
        return stored[-1]

    monkeypatch.setattr(ordered, "materialize", watched)
    with_map = frame(spark, data).withColumn("m", F.create_map(F.lit("x"), "v"))
    large = sum(row[1] == "hot" for row in data)
    out = ordered.over_preceding(with_map, ["k"], ["ts", "id"], 2, {"top": F.max("v")}, large - 1)
    assert out.count() == len(data) and "m" in out.columns
    assert [s.count() for s in stored] == [large]
    ordered.running(with_map, ["k"], ["ts", "id"], {"s": ("sum", "v")}, max_rows_per_task=large).count()
    assert len(stored) == 1


def test_cleanup_deletes_what_was_stored(spark):
    path = materialize(spark.range(3), "test").inputFiles()[0]
    cleanup(spark)
    assert not os.path.exists(path.removeprefix("file://"))
