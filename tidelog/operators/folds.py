"""User functions that go over the rows of a key in order, also where one key is huge.

`apply_in_order` hands a function the elements of each group as an iterator of record batches, in order, so
that it holds what it keeps and one batch. `rolling_reduce` gives each row the reduction of its key's rows
up to it. Where the function is associative, the rows of large keys are cut into slices by range: each slice
is reduced, the results of the slices are scanned on the driver (one for each slice), and each slice is
gone over again from what the slices before it came to. A function that is not associative has to go over
a key's rows one after the other; then a key is one task, which streams.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidelog.operators.ordered import _SLICE, HOT_KEY_ROWS, _apart, _sliced

Batches = Iterator[pa.RecordBatch]


def apply_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    function: Callable[[tuple, Batches], Batches],
    schema: str,
) -> DataFrame:
    """function(values of the keys, record batches of the group in order) -> record batches of `schema`.

    Groups are sorted by Spark, which spills. NULL is a key like any other.
    """

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(tuple(k.as_py() for k in key), batches)

    # the grouping below finds its rows dealt and sorted already, and leaves them so
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).groupBy(*keys).applyInArrow(run, schema)


def apply_to_windows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    order: Sequence[str],
    function: Callable[[tuple, Batches], Batches],
    schema: str,
    slide: str | None = None,
) -> DataFrame:
    """`apply_in_order` for the elements of each time window; the values of the keys are followed by its start and end."""
    placed = df.withColumn("_window", F.window(ts, size, slide))
    bounds = {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    rows = placed.withColumns(bounds).drop("_window")
    return apply_in_order(rows, [*keys, *bounds], order, function, schema)


def _scan(keys: Sequence[str], value: str, function: Callable, schema: T.StructType, carried: dict[int, object] | None):
    """Sorted rows with the reduction so far; a slice's first key goes on from what is carried to it."""
    kind = to_arrow_type(schema[-1].dataType)

    def run(batches: Iterable[pa.RecordBatch]) -> Batches:
        current, slice_no, total = None, None, None
        for batch in batches:
            out = []
            values = batch.column(value).to_pylist()
            rows = zip(*(batch.column(k).to_pylist() for k in keys), strict=True)
            slices = [None] * len(values) if carried is None else batch.column(_SLICE).to_pylist()
            for key, number, element in zip(rows, slices, values, strict=True):
                if number != slice_no:
                    current, slice_no, total = key, number, carried[number]
                elif key != current:
                    current, total = key, None
                if element is not None:
                    total = element if total is None else function(total, element)
                out.append(total)
            columns = [batch.column(f.name) for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, type=kind)], names=schema.names)

    return run


def _ends(keys: Sequence[str], value: str, function: Callable, names: Sequence[str], kinds: Sequence[pa.DataType]):
    """For each slice its first key, its last key, whether those are one, and the reduction of the last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Batches:
        found: list[tuple] = []
        number, first, current, total, changes = None, None, None, None, 0
        for batch in batches:
            values = batch.column(value).to_pylist()
            rows = zip(*(batch.column(k).to_pylist() for k in keys), strict=True)
            for key, n, element in zip(rows, batch.column(_SLICE).to_pylist(), values, strict=True):
                if n != number:
                    if number is not None:
                        found.append((number, *first, *current, changes == 0, total))
                    number, first, current, total, changes = n, key, key, None, 0
                elif key != current:
                    current, total, changes = key, None, changes + 1
                if element is not None:
                    total = element if total is None else function(total, element)
        if number is not None:
            found.append((number, *first, *current, changes == 0, total))
        columns = list(zip(*found, strict=True)) if found else [[] for _ in names]
        arrays = [pa.array(list(c), type=kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=list(names))

    return run


def rolling_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    function: Callable,
    name: str = "total",
    associative: bool = True,
    max_rows_per_task: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Each row with the values of its key so far, in `order`, reduced two by two by `function`.

    NULL changes nothing, and before the first value the result is NULL. `order` must be total inside a
    key. Say so if the function is not `associative`.
    """
    keys, order = list(keys), list(order)
    schema = T.StructType([*df.schema.fields, T.StructField(name, df.schema[value].dataType)])
    rest, large, n = (df, None, 0) if not associative else _apart(df, keys, max_rows_per_task)
    dealt = rest.repartition(*keys).sortWithinPartitions(*keys, *order)
    out = dealt.mapInArrow(_scan(keys, value, function, schema, None), schema)
    if large is None:
        return out
    sliced = _sliced(large, keys, order, n, max_rows_per_task)
    rows = sliced.repartition(_SLICE).sortWithinPartitions(_SLICE, *keys, *order)
    fields = [T.StructField(_SLICE, T.IntegerType())]
    fields += [T.StructField(f"{side}_{k}", df.schema[k].dataType) for side in ("first", "last") for k in keys]
    fields += [T.StructField("_alone", T.BooleanType()), T.StructField("_total", df.schema[value].dataType)]
    kinds = [to_arrow_type(f.dataType) for f in fields]
    ends = rows.mapInArrow(_ends(keys, value, function, [f.name for f in fields], kinds), T.StructType(fields))
    carried, before, so_far = {}, None, None
    # one row for each slice, of which there is one for `max_rows_per_task` rows
    for row in sorted(map(tuple, ends.collect()), key=lambda r: r[0]):
        number, first, last = row[0], row[1 : 1 + len(keys)], row[1 + len(keys) : 1 + 2 * len(keys)]
        alone, total = row[-2:]
        carried[number] = so_far if before == first else None
        if alone and carried[number] is not None:
            total = carried[number] if total is None else function(carried[number], total)
        before, so_far = last, total
    return out.unionByName(rows.mapInArrow(_scan(keys, value, function, schema, carried), schema))
