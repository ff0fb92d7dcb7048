"""Work that follows the order of rows inside a key, also when one key is huge.

A plain window puts all rows of a key into one task. Where the table has more rows than
`max_rows_per_task`, a job first looks for keys that are larger than that (partial counts,
so a cheap shuffle). Only the rows of those keys are cut, by range over (keys, order),
into slices of about equal size, so that a large key, or one crowded moment of it, spreads
over many slices; all other rows stay as they are in plain windows. The windows of large
keys run per (key, slice), and what a slice needs from the slices before it is computed
from one summary row per (key, slice).

A range cut has at most one key running over each of its borders, so the summaries that
must travel are fewer than the slices, of which there is one for `max_rows_per_task` rows.
They are broadcast up to `MOST_BROADCAST`, and joined by a shuffle beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import materialize

HOT_KEY_ROWS = 2_000_000
MOST_BROADCAST = 100_000

_SLICE = "_slice"

# name of the aggregate -> (over rows, over partial results)
_AGGREGATES = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}

Aggregates = dict[str, tuple[str, "Column | str"]]


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in keys])


def _apart(
    df: DataFrame, keys: Sequence[str], max_rows_per_task: int | None
) -> tuple[DataFrame, DataFrame | None, int]:
    """(the rows of all other keys, the rows of large keys if there are any, how many those are).

    None for the bound says that no key is large, which saves the look. At most one key in `max_rows_per_task` rows is large, so the driver may hold them.
    """
    if max_rows_per_task is None:
        return df, None, 0
    if df.select(F.lit(1)).limit(max_rows_per_task + 1).count() <= max_rows_per_task:
        return df, None, 0
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > max_rows_per_task).collect()
    if not sizes:
        return df, None, 0
    schema = T.StructType([T.StructField(f"_large_{k}", df.schema[k].dataType) for k in keys])
    large = df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in sizes], schema)
    large = F.broadcast(large) if len(sizes) <= MOST_BROADCAST else large
    same = _same(keys, "_large_")
    return df.join(large, same, "left_anti"), df.join(large, same, "left_semi"), sum(r["_rows"] for r in sizes)


def _sliced(rows: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, max_rows_per_task: int) -> DataFrame:
    """Rows with the number of their slice.

    The cut comes from a sample, so it is stored: every later read sees the same slices.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(partitions, -(-n // max_rows_per_task))
    ranged = rows.repartitionByRange(slices, *keys, *order)
    return materialize(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")


def _join_small(rows: DataFrame, small: DataFrame, on: Sequence[str], slices: int) -> DataFrame:
    """Left join with a frame of fewer rows than slices; NULL keys match each other."""
    renamed = small.withColumnsRenamed({c: f"_on_{c}" for c in on})
    renamed = F.broadcast(renamed) if slices <= MOST_BROADCAST else renamed
    return rows.join(renamed, _same(on, "_on_"), "left").drop(*[f"_on_{c}" for c in on])


def _slices_of(rows: DataFrame) -> int:
    return (rows.agg(F.max(_SLICE)).first()[0] or 0) + 1


def _combine(kind: str, left: Column, right: Column) -> Column:
    if kind == "min":
        return F.least(left, right)
    if kind == "max":
        return F.greatest(left, right)
    return F.coalesce(left + right, left, right)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggregates: Aggregates,
    previous: bool = False,
    max_rows_per_task: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """Each row with the aggregates of its key's rows up to and including it.

    `aggregates` maps a name to (sum | count | min | max, column). `max_rows_per_task` None means that the
    caller knows of no large key: the input is then read once. With `previous`
    there is also `previous_<name>`, the value before the row. `order` must be
    total inside a key.
    """
    rest, large, n = _apart(df, keys, max_rows_per_task)
    out = _running(rest, keys, order, aggregates, previous)
    if large is None:
        return out
    rows = _sliced(large, keys, order, n, max_rows_per_task)
    cut = _running(rows, [*keys, _SLICE], order, aggregates, previous)
    slices = Window.partitionBy(*keys).orderBy(_SLICE)
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*keys, _SLICE)
        .agg(*[_AGGREGATES[kind][0](column).alias(name) for name, (kind, column) in aggregates.items()])
        .select(
            *keys,
            _SLICE,
            F.row_number().over(slices).alias("_nth"),
            *[
                _AGGREGATES[kind][1](name).over(earlier).alias(f"_carried_{name}")
                for name, (kind, _) in aggregates.items()
            ],
        )
        .filter(F.col("_nth") > 1)
        .drop("_nth")
    )
    joined = _join_small(cut, carried, [*keys, _SLICE], _slices_of(rows))
    whole = joined.withColumns(
        {
            prefix + name: _combine(kind, F.col(f"_carried_{name}"), F.col(prefix + name))
            for prefix in (["", "previous_"] if previous else [""])
            for name, (kind, _) in aggregates.items()
        }
    ).drop(_SLICE, *[f"_carried_{name}" for name in aggregates])
    return out.unionByName(whole)


def _running(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], aggregates: Aggregates, previous: bool
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    frames = {"": window.rowsBetween(Window.unboundedPreceding, Window.currentRow)}
    if previous:
        frames["previous_"] = window.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "*",
        *[
            _AGGREGATES[kind][0](column).over(frame).alias(prefix + name)
            for prefix, frame in frames.items()
            for name, (kind, column) in aggregates.items()
        ],
    )


def over_preceding(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    aggregates: dict[str, Column],
    max_rows_per_task: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """Each row with aggregates over itself and the `preceding` rows before it in its key."""
    rest, large, n = _apart(df, keys, max_rows_per_task)
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-preceding, Window.currentRow)
    out = rest.select("*", *[agg.over(frame).alias(name) for name, agg in aggregates.items()])
    if large is None:
        return out

    # The last rows of each (key, slice) are lent to the slices after it. Any slice of a
    # key holds at least one row, so looking back over `preceding` slices is far enough.
    rows = _sliced(large, keys, order, n, max_rows_per_task)
    backwards = Window.partitionBy(*keys, _SLICE).orderBy(*[F.col(c).desc() for c in order])
    row = F.struct(*order, *[c for c in df.columns if c not in order])

    def place(entry: Column) -> Column:
        return F.struct(*[entry[c] for c in order])

    def earlier(x: Column, y: Column) -> Column:
        # by the order alone: other columns may be of types that have none
        return F.when(place(x) < place(y), -1).when(place(x) > place(y), 1).otherwise(0)

    slices = Window.partitionBy(*keys).orderBy(_SLICE)
    lent = (
        rows.withColumn("_back", F.row_number().over(backwards))
        .filter(F.col("_back") <= preceding)
        .groupBy(*keys, _SLICE)
        .agg(F.array_sort(F.collect_list(row), earlier).alias("_tail"))
        .select(
            _SLICE,
            F.flatten(F.collect_list("_tail").over(slices.rowsBetween(-preceding, -1))).alias("_tails"),
        )
        .filter(F.size("_tails") > 0)
        .select(
            _SLICE,
            F.explode(
                F.slice("_tails", F.greatest(F.size("_tails") - preceding + 1, F.lit(1)), preceding)
            ).alias("_row"),
        )
        .select("_row.*", _SLICE)
    )
    both = rows.withColumn("_lent", F.lit(False)).unionByName(lent.withColumn("_lent", F.lit(True)))
    frame = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(-preceding, Window.currentRow)
    cut = (
        both.select("*", *[agg.over(frame).alias(name) for name, agg in aggregates.items()])
        .filter(~F.col("_lent"))
        .drop("_lent", _SLICE)
    )
    return out.unionByName(cut)


def count_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    aggregates: dict[str, Column],
    max_rows_per_task: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """Aggregates over every `size` rows of a key, in order; an unfinished last window gives nothing."""
    numbered = running(df, keys, order, {"_nth": ("count", F.lit(1))}, max_rows_per_task=max_rows_per_task)
    return (
        numbered.withColumn("window_no", F.floor((F.col("_nth") - 1) / size))
        .groupBy(*keys, "window_no")
        .agg(F.count("*").alias("_rows"), *[agg.alias(name) for name, agg in aggregates.items()])
        .filter(F.col("_rows") == size)
        .drop("_rows")
    )


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap: Column | str,
    aggregates: Aggregates,
    max_rows_per_task: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """Session windows per key: (keys, window_start, window_end, aggregates).

    `gap` is an interval text, or a column of interval texts for a gap per row.
    """
    rest, large, n = _apart(df, keys, max_rows_per_task)
    out = _local_sessions(rest, keys, ts, gap, aggregates)
    if large is None:
        return out
    # One row per (key, moment, gap) first, so that no crowd at one moment resists the cut.
    gap = F.lit(gap) if isinstance(gap, str) else gap
    points = large.groupBy(*keys, F.col(ts).alias("_ts"), gap.alias("_gap")).agg(
        *[_AGGREGATES[kind][0](column).alias(name) for name, (kind, column) in aggregates.items()]
    )
    rows = _sliced(points, keys, ["_ts", "_gap"], n, max_rows_per_task)
    merges = {name: ("sum" if kind == "count" else kind, name) for name, (kind, _) in aggregates.items()}
    found = _local_sessions(rows, [*keys, _SLICE], "_ts", F.col("_gap"), merges)
    return out.unionByName(_stitch(found, keys, aggregates, _slices_of(rows)))


def _local_sessions(
    rows: DataFrame, keys: Sequence[str], ts: str, gap: Column | str, aggregates: Aggregates
) -> DataFrame:
    return (
        rows.groupBy(*keys, F.session_window(ts, gap).alias("_session"))
        .agg(*[_AGGREGATES[kind][0](column).alias(name) for name, (kind, column) in aggregates.items()])
        .select(
            *keys,
            F.col("_session.start").alias("window_start"),
            F.col("_session.end").alias("window_end"),
            *aggregates,
        )
    )


def _stitch(found: DataFrame, keys: Sequence[str], aggregates: Aggregates, slices_made: int) -> DataFrame:
    """Join up sessions that were cut by a slice border.

    A session is open to the left when it starts before some earlier slice's sessions
    end, and open to the right when it reaches the next slice. All sessions of a slice
    that are open to the left belong together, and only its last one can be open to
    the right: after merging the former, a (key, slice) has at most two open sessions.
    """
    merged = [_AGGREGATES[kind][1](name).alias(name) for name, (kind, _) in aggregates.items()]
    bounds = [F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end")]
    slices = Window.partitionBy(*keys).orderBy(_SLICE)
    borders = (
        found.groupBy(*keys, _SLICE)
        .agg(F.min("window_start").alias("_first"), F.max("window_end").alias("_last"))
        .select(
            *keys,
            _SLICE,
            F.max("_last").over(slices.rowsBetween(Window.unboundedPreceding, -1)).alias("_reached"),
            F.lead("_first").over(slices).alias("_next"),
        )
        .filter(F.col("_reached").isNotNull() | F.col("_next").isNotNull())
    )
    # rows of `borders`: keys with several slices only, so fewer than two per slice
    marked = _join_small(found, borders, [*keys, _SLICE], slices_made).withColumns(
        {
            "_left": F.coalesce(F.col("window_start") <= F.col("_reached"), F.lit(False)),
            "_right": F.coalesce(F.col("window_end") >= F.col("_next"), F.lit(False)),
        }
    )
    columns = [*keys, "window_start", "window_end", *aggregates]
    closed = marked.filter(~F.col("_left") & ~F.col("_right")).select(*columns)
    in_order = Window.partitionBy(*keys).orderBy("window_start", _SLICE, F.col("_left").desc())
    opened = (
        marked.filter(F.col("_left") | F.col("_right"))
        .groupBy(*keys, _SLICE, "_left")
        .agg(*bounds, *merged)
        .withColumn(
            "_reached",
            F.max("window_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1)),
        )
        .withColumn("_new", F.when(F.col("window_start") <= F.col("_reached"), 0).otherwise(1))
        .withColumn("_no", F.sum("_new").over(in_order))
        .groupBy(*keys, "_no")
        .agg(*bounds, *merged)
        .select(*columns)
    )
    return closed.unionByName(opened)
