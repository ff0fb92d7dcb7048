"""Joins, lateral expansion, grouped aggregates, top-n and distinct rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.functions.scalars import WHITESPACE, words
from tidelog.operators.columns import fields_of


def join(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    """Inner join of two tables without a column name in common.

    No hint is set: Spark broadcasts a side whose size it knows to be small, and
    otherwise sorts and merges, splitting skewed partitions as it runs.
    """
    shared = sorted({c.lower() for c in left.columns} & {c.lower() for c in right.columns})
    if shared:
        raise ValueError(f"rename these columns on one side: {', '.join(shared)}")
    return left.join(right, on, "inner")


def lateral_split(df: DataFrame, column: str, separator: str, name: str) -> DataFrame:
    """One row per piece of a text; empty pieces stay, a NULL text gives no row."""
    return df.withColumn(name, F.explode(F.split(column, F.lit(_quoted(separator)), -1)))


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def lateral_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Beside each row, the fields of the JSON record in `column`."""
    return df.select("*", fields_of(F.from_json(column, schema)))


def unnest(df: DataFrame, column: str, name: str, position: str | None = None) -> DataFrame:
    """Cross join each row with the elements of its array; rows with none vanish."""
    rest = [c for c in df.columns if c != column]
    if position is None:
        return df.select(*rest, F.explode(column).alias(name))
    return df.select(*rest, F.posexplode(column).alias(position, name))


def group(df: DataFrame, keys: Sequence[str | Column], aggregates: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggregates.items()])


def count_rows(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """COUNT(*) per key: rows with NULL count too."""
    return group(df, keys, {name: F.count("*")})


def count_values(df: DataFrame, keys: Sequence[str], column: str, name: str = "count") -> DataFrame:
    """COUNT(column) per key: NULL is not counted."""
    return group(df, keys, {name: F.count(column)})


def distinct(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def limit(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The first `n` rows, in no order unless one is given."""
    return (df.orderBy(*order) if order else df).limit(n)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows of each key. Each task keeps `n` rows per key before the shuffle."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key, as an aggregate that is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)


def word_count(df: DataFrame, column: str) -> DataFrame:
    """How often each whitespace-separated word occurs.

    The texts are cut at ASCII blanks, which is several times faster; the rare other
    blanks are looked for in the distinct pieces only.
    """
    if df.isStreaming:
        counted = df.select(F.explode(words(column)).alias("word")).groupBy("word")
        return counted.agg(F.count("*").alias("count"))
    pieces = df.select(F.explode(F.split(column, r"\s+")).alias("_piece"))
    pieces = pieces.groupBy("_piece").agg(F.count("*").alias("_count"))
    found = pieces.select(F.explode(F.split("_piece", WHITESPACE)).alias("word"), "_count")
    return found.filter("word <> ''").groupBy("word").agg(F.sum("_count").alias("count"))


@dataclass(frozen=True)
class UserAggregate:
    """An aggregate in user code that can be computed in parts.

    `accumulate` takes a state and a pandas frame of some rows of one key, `merge` two
    states, `finish` turns a state into output rows (none, one or several). A state is
    a tuple with the fields of `state`; `output` lists the fields of an output row.
    Numbers come as pandas' nullable types. Native aggregates are many times faster: take
    this for code that Spark has no function for.
    """

    create: Callable[[], tuple]
    accumulate: Callable[[tuple, pd.DataFrame], tuple]
    merge: Callable[[tuple, tuple], tuple]
    finish: Callable[[tuple], list[tuple]]
    state: str
    output: str


# whole and floating numbers that keep NULL apart from NaN, and all their digits beside it
_NULLABLE = {
    pa.int8(): pd.Int8Dtype(),
    pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(),
    pa.float32(): pd.Float32Dtype(),
    pa.float64(): pd.Float64Dtype(),
}
_NAN = float("nan")


def _same_nan(value):
    """NaN never equals itself, so one object stands for all."""
    return _NAN if value != value else value


# states one task holds before it hands them on
STATES_PER_TASK = 50_000
# rows and bytes that a task brings together before it hands a key's rows to user code
ROWS_PER_FOLD, BYTES_PER_FOLD = 100_000, 1 << 25


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Neighbouring batches as one, up to about `ROWS_PER_FOLD` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS_PER_FOLD or sum(b.nbytes for b in held) >= BYTES_PER_FOLD:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def user_aggregate(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], aggregate: UserAggregate
) -> DataFrame:
    """Run a `UserAggregate` per key.

    Each task first folds its own rows into one state per key, so what the shuffle
    brings together for a key is a few small states per input partition, never its rows.
    The states of a key then come one after the other in a sorted partition.
    """
    keys, columns = list(keys), list(columns)
    key_fields = [df.schema[k] for k in keys]
    state_fields = T._parse_datatype_string(aggregate.state).fields
    output_fields = T._parse_datatype_string(aggregate.output).fields
    states = [f.name for f in state_fields]
    partial_schema = T.StructType(key_fields + state_fields)
    kinds = to_arrow_schema(partial_schema)
    output_schema = T.StructType(key_fields + output_fields)
    output_kinds = to_arrow_schema(output_schema)

    def fold(batches):
        held: dict[tuple, tuple] = {}

        def handed_on():
            columns = zip(*((*k, *s) for k, s in held.items()), strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=kind.type) for c, kind in zip(columns, kinds, strict=True)], schema=kinds
            )

        for run in _runs(batches):
            # keys stay Python values: beside a NULL, pandas would make whole numbers floats
            parts = [[_same_nan(v) for v in run.column(k).to_pylist()] for k in keys]
            numbers: dict[tuple, int] = {}
            codes = np.array([numbers.setdefault(key, len(numbers)) for key in zip(*parts, strict=True)], dtype=np.int64)
            order = np.argsort(codes, kind="stable")
            cuts = np.searchsorted(codes[order], np.arange(len(numbers) + 1)).tolist()
            rows = run.select(columns).to_pandas(types_mapper=_NULLABLE.get).take(order)
            for key, low, high in zip(numbers, cuts, cuts[1:]):
                held[key] = aggregate.accumulate(held.get(key, aggregate.create()), rows.iloc[low:high])
            if len(held) > STATES_PER_TASK:
                yield handed_on()
                held = {}
        if held:
            yield handed_on()

    def finish(batches):
        current, total, out = None, None, []

        def made(rows):
            columns = zip(*rows, strict=True)
            arrays = [
                pa.array(list(c), type=kind.type, from_pandas=n >= len(keys))
                for n, (c, kind) in enumerate(zip(columns, output_kinds, strict=True))
            ]
            return pa.RecordBatch.from_arrays(arrays, schema=output_kinds)

        for batch in batches:
            parts = [[_same_nan(v) for v in batch.column(k).to_pylist()] for k in keys]
            found = [batch.column(s).to_pylist() for s in states]
            for key, part in zip(zip(*parts, strict=True), zip(*found, strict=True), strict=True):
                if key != current:
                    if current is not None:
                        out += [(*current, *row) for row in aggregate.finish(total)]
                    current, total = key, aggregate.create()
                total = aggregate.merge(total, part)
            if out:
                yield made(out)
                out = []
        if current is not None:
            out += [(*current, *row) for row in aggregate.finish(total)]
        if out:
            yield made(out)

    partial = df.select(*dict.fromkeys([*keys, *columns])).mapInArrow(fold, partial_schema)
    dealt = partial.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(finish, output_schema)


# moments of one key that meet its total in one task
MOMENTS_PER_TASK = 2_000_000


def timers_with_total(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    delay: str = "5 seconds",
    moments_per_task: int = MOMENTS_PER_TASK,
) -> DataFrame:
    """(key, fired, total): for each distinct moment of a key, to the millisecond, `delay` after it
    and the sum over all rows of the key.

    The join sees each (key, moment) once. A key with very many moments gets one copy of its
    total per `moments_per_task` of them, and its moments are dealt out over the copies.
    """
    at = F.date_trunc("millisecond", ts).cast(df.schema[ts].dataType).alias("_at")
    moments = df.groupBy(key, at).agg(F.sum(value).alias("_sum"))
    totals = moments.groupBy(F.col(key).alias("_key")).agg(
        F.sum("_sum").alias("total"), F.ceil(F.count("*") / moments_per_task).alias("_copies")
    )
    fired = (F.col("_at") + F.expr(f"INTERVAL {delay}")).alias("fired")
    same_key = F.col(key).eqNullSafe(F.col("_key"))
    large = totals.filter("_copies > 1").select(F.col("_key").alias("_large"), "_copies")
    if large.isEmpty():
        return moments.join(totals, same_key).select(key, fired, "total")
    # at most one row of `large` per `moments_per_task` rows of the input
    dealt = moments.join(F.broadcast(large), F.col(key).eqNullSafe(F.col("_large")), "left").withColumn(
        "_part", F.pmod(F.xxhash64("_at"), F.coalesce("_copies", F.lit(1)))
    )
    copied = totals.select("_key", "total", F.explode(F.expr("sequence(0L, _copies - 1)")).alias("_copy"))
    joined = dealt.drop("_copies").join(copied, same_key & (F.col("_part") == F.col("_copy")))
    return joined.select(key, fired, "total")
