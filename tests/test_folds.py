"""User functions over rows in order, against plain loops."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from conftest import rows

from tidelog.operators import folds

START = datetime(2024, 1, 1)


def words(seed, n=300):
    """Rows of few keys, of which one holds most; NULL is a key, some values are missing."""
    pick = random.Random(seed)
    keys = pick.choices(["hot", "b", None, "d"], [80, 10, 5, 5], k=n)
    return [(i, k, pick.choice("abcdef") if pick.random() < 0.9 else None) for i, k in enumerate(keys)]


def joined(data, function):
    want, held = [], {}
    for i, k, v in data:
        if v is not None:
            held[k] = v if held.get(k) is None else function(held[k], v)
        want.append((i, k, v, held.get(k)))
    return sorted(want, key=repr)


@pytest.mark.parametrize("most", [7, 60, 1_000])
def test_rolling_reduce_with_and_without_a_cut(spark, most):
    """Joining texts is associative and depends on the order."""
    data = words(1)
    df = spark.createDataFrame(random.Random(2).sample(data, len(data)), "id bigint, k string, v string").repartition(5)
    got = folds.rolling_reduce(df, ["k"], ["id"], "v", lambda a, b: a + b, max_rows_per_task=most)
    assert rows(got) == joined(data, lambda a, b: a + b)


def test_rolling_reduce_that_is_not_associative(spark):
    data = [(i, k, None if v is None else ord(v)) for i, k, v in words(3)]
    df = spark.createDataFrame(data, "id bigint, k string, v bigint").repartition(5)

    def function(a, b):
        return (3 * a - b) % 1009

    got = folds.rolling_reduce(df, ["k"], ["id"], "v", function, associative=False, max_rows_per_task=7)
    assert rows(got) == joined(data, function)
    assert folds.rolling_reduce(df.limit(0), ["k"], ["id"], "v", function).collect() == []


def test_elements_come_in_order_and_in_batches(spark):
    """A function sees a window's elements in order, a few at a time, whatever the group's size."""
    pick = random.Random(4)
    data = [(i, pick.choice(["x", None]), START + timedelta(minutes=pick.randrange(180)), i % 7) for i in range(400)]
    df = spark.createDataFrame(data, "id bigint, k string, ts timestamp, v int").repartition(6)

    def changes(key, batches):
        last, n, most = None, 0, 0
        for batch in batches:
            most = max(most, batch.num_rows)
            for v in batch.column("v").to_pylist():
                n, last = n + (last is not None and v != last), v
        yield pa.RecordBatch.from_pydict(
            {"k": pa.array([key[0]], pa.string()), "hour": pa.array([key[1].hour], pa.int32()), "n": pa.array([n]), "most": pa.array([most])}
        )

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        out = folds.apply_to_windows(df, ["k"], "ts", "1 hour", ["ts", "id"], changes, "k string, hour int, n bigint, most bigint")
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert plan.count("hashpartitioning") == 1 and plan.count("Sort [") == 1
    assert max(r["most"] for r in got) <= 10
    want = []
    for k, hour in {(k, ts.hour) for _, k, ts, _ in data}:
        mine = [v for _, v in sorted(((ts, i), v) for i, kk, ts, v in data if kk == k and ts.hour == hour)]
        want.append((k, hour, sum(a != b for a, b in zip(mine, mine[1:], strict=False))))
    assert sorted((tuple(r)[:3] for r in got), key=repr) == sorted(want, key=repr)
