"""Stateful processors for `transformWithStateInPandas`: per-key state, timers and time-to-live.

Keys are any columns, values of any type; the types come from the frame. Rows of a key reach a processor in
frames of bounded size and are worked on a frame at a time. Where `order` names a column, the rows of a
key in one micro-batch are taken in that order; without it in the order they arrive. What has to
wait (for its order, or for event time) lies in list state as columns and is read back in
sorted slices, so a large key is never held in memory as a whole. A key has one timer, at the
earliest moment that it waits for.

A call for one key costs milliseconds, whatever it does. So the reduce, the count windows and the last rows deal
their keys by hash to `KEY_GROUPS` groups and work on a group's keys in one call, with one state for the group; only
state that expires by the clock is kept key by key.

Columns may hold NULLs: they travel as a value that is not looked at, beside a flag.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.session import configure

#: rows of one key that a task holds at once when it sorts
ROWS_PER_SLICE = 100_000
#: groups that keys are dealt to; a stream has to keep the number that it was started with
KEY_GROUPS = 1024
_FLAG = "_missing_"
_GROUP, _KEY = "_group", "_key"
_UFUNCS = {operator.add: np.add, max: np.maximum, min: np.minimum}


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _filler(kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit("1970-01-01").cast(kind)
    return F.lit(0).cast(kind) if isinstance(kind, (T.NumericType, T.BooleanType)) else F.lit("").cast(kind)


def _packed(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys, and each column filled and with a flag that tells whether it was NULL."""
    parts = []
    for c in dict.fromkeys(columns):
        if c not in keys:
            parts.append(F.coalesce(F.col(c), _filler(df.schema[c].dataType)).alias(c))
        parts.append(F.col(c).isNull().alias(_FLAG + c))
    return df.select(*keys, *parts)


def _apply(packed: DataFrame, keys, processor, schema: str, mode: str, time_mode: str) -> DataFrame:
    configure(packed.sparkSession)
    processor.names = packed.columns
    return packed.groupBy(*keys).transformWithStateInPandas(processor, schema, mode, time_mode)


def _schema(df: DataFrame, keys: Sequence[str], **others: str) -> str:
    kinds = [(k, df.schema[k].dataType.simpleString()) for k in keys] + list(others.items())
    return ", ".join(f"`{name}` {kind}" for name, kind in kinds)


def _key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """All key columns as one text, which is equal for equal keys."""
    parts = []
    for k in keys:
        kind, column = df.schema[k].dataType, F.col(k)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            column = column + F.lit(0).cast(kind)  # one zero
        elif isinstance(kind, T.BinaryType):
            column = F.hex(column)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(column)
        parts.append(column.cast("string"))
    return F.to_json(F.array(*parts))


def _key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The key columns from their text."""
    parts, out = F.from_json(_KEY, "array<string>"), []
    for n, k in enumerate(keys):
        kind, column = df.schema[k].dataType, parts[n]
        if isinstance(kind, T.BinaryType):
            column = F.unhex(column)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            column = F.from_json(column, kind)
        out.append(column.cast(kind).alias(k))
    return out


def _apply_to_groups(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], processor, outputs: dict[str, str], time_mode: str
) -> DataFrame:
    """(keys, outputs) of a processor of groups of keys."""
    named = df.withColumn(_KEY, _key_text(df, keys))
    packed = _packed(named, [_KEY], [_KEY, *columns])
    packed = packed.withColumn(_GROUP, F.pmod(F.xxhash64(_KEY), F.lit(KEY_GROUPS)).cast("int"))
    schema = ", ".join([f"{_KEY} string", *(f"`{name}` {kind}" for name, kind in outputs.items())])
    out = _apply(packed, [_GROUP], processor, schema, "append", time_mode)
    return out.select(*_key_columns(df, keys), *[F.col(f"`{name}`") for name in outputs])


def _series(values: np.ndarray, missing: np.ndarray) -> pd.Series:
    out = pd.Series(values)
    if missing.any():
        out = out.astype(object)
        out[missing] = None
    return out


class _Waiting:
    """Rows of a key that wait, as batches of columns in list state; the first `sorted_by` columns are their order."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, kinds: Sequence[str], sorted_by: int, timed: bool):
        columns = ", ".join(f"c{n} array<{kind}>" for n, kind in enumerate(kinds))
        self.handle, self.sorted_by, self.timed = handle, sorted_by, timed
        self.lists = [handle.getListState(f"{name}{n}", columns) for n in range(2)]
        self.at = handle.getValueState(f"{name}_at", "active int, timer bigint")

    def _now(self) -> tuple[int, int | None]:
        held = self.at.get()
        return (0, None) if held is None else (held[0], held[1])

    def add(self, columns: Sequence[np.ndarray]) -> None:
        if not len(columns[0]):
            return
        order = np.lexsort(columns[: self.sorted_by][::-1])
        columns = [np.asarray(c)[order] for c in columns]
        active, timer = self._now()
        self.lists[active].appendValue(tuple(c.tolist() for c in columns))
        if not self.timed:
            return
        first = int(columns[0][0])
        if timer is None or first < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
            self.at.update((active, first))

    def taken(self, upto=None) -> Iterator[list[np.ndarray]]:
        """Rows whose first column is at most `upto` (all without it), in sorted slices; the others stay.

        A slice holds about `ROWS_PER_SLICE` rows, more only where one value of the first column has more.
        """
        active, _ = self._now()

        def entries() -> Iterator[tuple[list, int]]:
            for entry in self.lists[active].get():
                first = np.asarray(entry[0])
                yield entry, len(first) if upto is None else int(np.searchsorted(first, upto, "right"))

        taken, rest, marks = 0, 0, []
        for entry, n in entries():
            taken, rest = taken + n, rest + len(entry[0]) - n
            marks.append(np.asarray(entry[0])[:n:1000])
        if taken:
            marks = np.sort(np.concatenate(marks))
            slices = -(-taken // ROWS_PER_SLICE)
            cuts = np.unique(marks[[len(marks) * k // slices for k in range(1, slices)]]) if slices > 1 else []
            for low, high in zip([None, *cuts], [*cuts, None], strict=True):
                parts: list[list] = []
                for entry, n in entries():
                    first = np.asarray(entry[0])[:n]
                    a = 0 if low is None else int(np.searchsorted(first, low, "left"))
                    b = n if high is None else int(np.searchsorted(first, high, "left"))
                    if b > a:
                        parts.append([np.asarray(c)[a:b] for c in entry])
                if parts:
                    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                    order = np.lexsort(columns[: self.sorted_by][::-1])
                    yield [c[order] for c in columns]
        least = None
        if rest and taken:
            for entry, n in entries():
                if n < len(entry[0]):
                    least = entry[0][n] if least is None else min(least, entry[0][n])
                    self.lists[1 - active].appendValue(tuple(c[n:] for c in entry))
        elif rest:
            least = min(entry[0][0] for entry, _ in entries())
        if taken:
            self.lists[active].clear()
            active = 1 - active
        if self.timed and least is not None:
            self.handle.registerTimer(int(least))
        self.at.update((active, least if self.timed else None))


def _named(rows: Iterator[pd.DataFrame], names: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Frames under the names of their columns, which the optimizer may have lost."""
    for frame in rows:
        frame.columns = list(names)
        yield frame


class _Processor(StatefulProcessor):
    """A processor over frames of (keys, columns), in the order of a column if one is named."""

    def __init__(self, keys: Sequence[str], columns: Sequence[str], kinds: Sequence[str], order: str | None):
        self.keys, self.columns, self.kinds, self.order = list(keys), list(columns), list(kinds), order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.order is not None:
            kinds = list(chain.from_iterable((kind, "boolean") for kind in self.kinds))
            place = self.columns.index(self.order)
            self.flat = [c for name in self.columns for c in (name, _FLAG + name)]
            # the order first
            self.flat = [self.flat.pop(2 * place), *self.flat]
            kinds = [kinds.pop(2 * place), *kinds]
            self.sorting = _Waiting(handle, "sorting", kinds, 1, timed=False)

    def frames(self, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = _named(rows, self.names)
        if self.order is None:
            yield from rows
            return
        held, n = [], 0
        for frame in rows:
            held.append(frame)
            n += len(frame)
            if n > ROWS_PER_SLICE:
                break
        else:
            if held:
                yield pd.concat(held, ignore_index=True).sort_values(self.order, kind="stable")
            return
        for frame in chain(held, rows):
            self.sorting.add([frame[c].to_numpy() for c in self.flat])
        for columns in self.sorting.taken():
            yield pd.DataFrame(dict(zip(self.flat, columns, strict=True)))

    def out(self, key, n: int, **columns) -> pd.DataFrame:
        keys = {name: pd.Series([value] * n, dtype=object) for name, value in zip(self.keys, key, strict=True)}
        return pd.DataFrame({**keys, **columns})

    def close(self) -> None:
        pass


def _parts(keys: Sequence[str]) -> tuple[np.ndarray, list[tuple[str, int, int]]]:
    """An order that brings the rows of a key together and leaves theirs, and (key, first, last + 1) of each in it."""
    codes, found = pd.factorize(np.asarray(keys, dtype=object))
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(len(found) + 1)).tolist()
    return order, list(zip(found.tolist(), cuts, cuts[1:]))


class _Reduce(_Processor):
    """Emits the key's reduced value after every row."""

    def __init__(self, keys, columns, kinds, order, function, value, id_column, ttl_ms):
        super().__init__(keys, columns, kinds, order)
        self.function, self.value, self.id_column, self.ttl_ms = function, value, id_column, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        kind = self.kinds[self.columns.index(self.value)]
        self.total = handle.getValueState("total", f"total {kind}", self.ttl_ms)

    def step(self, total, values: np.ndarray, missing: np.ndarray) -> tuple[np.ndarray, np.ndarray, object]:
        """(reduced value after each row, where there is none yet, the last one)."""
        values = values[~missing]  # as in SQL, NULL changes nothing
        ufunc = _UFUNCS.get(self.function) if values.dtype.kind in "iuf" else None
        before = [] if total is None else [total]
        if not len(values):
            so_far = before
        elif ufunc is not None:
            so_far = ufunc.accumulate(np.concatenate([np.asarray(before, dtype=values.dtype), values]))
        else:
            so_far = list(accumulate(chain(before, values.tolist()), self.function))
        at = np.cumsum(~missing) - 1 + len(before)
        totals = np.asarray(so_far)[np.maximum(at, 0)] if len(so_far) else np.zeros(len(at))
        if len(so_far):
            total = so_far[-1].item() if hasattr(so_far[-1], "item") else so_far[-1]
        return totals, at < 0, total

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.total.get()
        total = None if held is None else held[0]
        for frame in self.frames(rows):
            missing = frame[_FLAG + self.value].to_numpy(dtype=bool)
            totals, none, total = self.step(total, frame[self.value].to_numpy(), missing)
            ids = _series(frame[self.id_column].to_numpy(), frame[_FLAG + self.id_column].to_numpy(dtype=bool))
            yield self.out(key, len(frame), **{self.id_column: ids.to_numpy(), "total": _series(totals, none).to_numpy()})
        # written after every read as well, so that reading renews the time to live
        self.total.update((total,))


class _ReduceGroup(_Reduce):
    """The same for a group of keys."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        _Processor.init(self, handle)
        kind = self.kinds[self.columns.index(self.value)]
        self.totals = handle.getValueState("totals", f"found array<string>, totals array<{kind}>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.totals.get()
        last = {} if held is None else dict(zip(held[0], held[1], strict=True))
        for frame in self.frames(rows):
            order, parts = _parts(frame[_KEY])
            frame = frame.iloc[order]
            values, missing = frame[self.value].to_numpy(), frame[_FLAG + self.value].to_numpy(dtype=bool)
            totals, none = [], []
            for name, low, high in parts:
                so_far, unknown, last[name] = self.step(last.get(name), values[low:high], missing[low:high])
                totals.append(so_far)
                none.append(unknown)
            ids = _series(frame[self.id_column].to_numpy(), frame[_FLAG + self.id_column].to_numpy(dtype=bool))
            total = _series(np.concatenate(totals), np.concatenate(none)).to_numpy()
            yield pd.DataFrame({_KEY: frame[_KEY].to_numpy(), self.id_column: ids.to_numpy(), "total": total})
        self.totals.update((list(last), list(last.values())))


def running_reduce(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    id_column: str,
    function: Callable = operator.add,
    ttl_ms: int | None = None,
    order: str | None = None,
) -> DataFrame:
    """(keys, id column, total) after each row: the key's values so far, reduced two by two.

    State not touched for `ttl_ms` is forgotten.
    """
    keys = _names(keys)
    columns = list(dict.fromkeys([value, id_column, *([order] if order else [])]))
    kinds = [df.schema[c].dataType.simpleString() for c in columns]
    kind = df.schema[value].dataType.simpleString()
    outputs = {id_column: df.schema[id_column].dataType.simpleString(), "total": kind}
    if ttl_ms is None:
        processor = _ReduceGroup(keys, [_KEY, *columns], ["string", *kinds], order, function, value, id_column, None)
        return _apply_to_groups(df, keys, columns, processor, outputs, "none")
    processor = _Reduce(keys, columns, kinds, order, function, value, id_column, ttl_ms)
    return _apply(_packed(df, keys, columns), keys, processor, _schema(df, keys, **outputs), "append", "processingTime")


class _TopN(_Processor):
    """Emits the key's `n` largest values once per micro-batch."""

    def __init__(self, keys, columns, kinds, n: int):
        super().__init__(keys, columns, kinds, None)
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.best = handle.getValueState("best", f"vals array<{self.kinds[0]}>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (value,) = self.columns
        held = self.best.get()
        best = [] if held is None else list(held[0])
        for frame in self.frames(rows):
            values = frame[value].to_numpy()[~frame[_FLAG + value].to_numpy(dtype=bool)]
            if values.dtype.kind in "iuf" and len(values) > self.n:
                values = np.partition(values, len(values) - self.n)[-self.n :]
            best = sorted([*best, *values.tolist()], reverse=True)[: self.n]
        self.best.update((best,))
        if best:
            yield self.out(key, len(best), rank=np.arange(1, len(best) + 1, dtype=np.int32), value=best)


def top_values(df: DataFrame, keys: str | Sequence[str], value: str, n: int) -> DataFrame:
    """(keys, rank, value): the present `n` largest values of each key that got rows. For an upsert by (keys, rank)."""
    keys, kind = _names(keys), df.schema[value].dataType.simpleString()
    schema = _schema(df, keys, rank="int", value=kind)
    return _apply(_packed(df, keys, [value]), keys, _TopN(keys, [value], [kind], n), schema, "update", "none")


class _IdleCount(_Processor):
    """Emits the key's count once per micro-batch."""

    def __init__(self, keys, ttl_ms: int):
        super().__init__(keys, [], [], None)
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.count = handle.getValueState("count", "count bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.count.get()
        count = (0 if held is None else held[0]) + sum(map(len, rows))
        self.count.update((count,))
        yield self.out(key, 1, count=[count])


def count_with_expiry(df: DataFrame, keys: str | Sequence[str], ttl_ms: int) -> DataFrame:
    """(keys, count): running count per key; a key left idle for `ttl_ms` is forgotten and counts from 1 again."""
    keys = _names(keys)
    packed = df.select(*keys, F.lit(True).alias(f"{_FLAG}row"))
    return _apply(packed, keys, _IdleCount(keys, ttl_ms), _schema(df, keys, count="bigint"), "update", "processingTime")


class _CountWindow(_Processor):
    """Emits the sum of every `size` rows of each key of a group."""

    def __init__(self, keys, columns, kinds, order, value: str, size: int):
        super().__init__(keys, columns, kinds, order)
        self.value, self.size = value, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        kind = self.kinds[self.columns.index(self.value)]
        state = f"found array<string>, number array<bigint>, rows array<bigint>, total array<{kind}>"
        self.windows = handle.getValueState("windows", state)

    def step(self, state: tuple, values: np.ndarray, missing: np.ndarray):
        """(numbers, sums, whether they are known) of the windows that are full now, and the state after."""
        number, count, total = state
        place = (count + np.arange(len(values))) // self.size
        found = np.arange(int(place[-1]) + 1)
        starts = np.searchsorted(place, found)
        sums = np.add.reduceat(np.where(missing, 0, values), starts)
        known = np.add.reduceat((~missing).astype(int), starts) > 0
        if total is not None:
            sums[0], known[0] = sums[0] + total, True
        count += len(values)
        done = count // self.size
        total = sums[done].item() if done < len(found) and known[done] else None
        return number + np.arange(done), sums[:done], known[:done], (number + done, count % self.size, total)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.windows.get()
        last = {} if held is None else {k: tuple(state) for k, *state in zip(*held, strict=True)}
        for frame in self.frames(rows):
            order, parts = _parts(frame[_KEY])
            values = frame[self.value].to_numpy()[order]
            missing = frame[_FLAG + self.value].to_numpy(dtype=bool)[order]
            out, names = [], []
            for name, low, high in parts:
                *full, last[name] = self.step(last.get(name, (0, 0, None)), values[low:high], missing[low:high])
                if len(full[0]):
                    out.append(full)
                    names += [name] * len(full[0])
            if out:
                numbers, sums, known = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pd.DataFrame({_KEY: names, "window_no": numbers, "total": _series(sums, ~known).to_numpy()})
        if last:
            self.windows.update((list(last), *map(list, zip(*last.values(), strict=True))))


def count_window_sums(
    df: DataFrame, keys: str | Sequence[str], value: str, size: int, order: str | None = None
) -> DataFrame:
    """(keys, window_no, total) for every `size` rows of a key; an unfinished window waits."""
    keys = _names(keys)
    columns = list(dict.fromkeys([value, *([order] if order else [])]))
    kinds = [df.schema[c].dataType.simpleString() for c in columns]
    outputs = {"window_no": "bigint", "total": df.schema[value].dataType.simpleString()}
    processor = _CountWindow(keys, [_KEY, *columns], ["string", *kinds], order, value, size)
    return _apply_to_groups(df, keys, columns, processor, outputs, "none")


class _SumTimer(_Processor):
    """Adds rows up; event time reaching a moment emits the sum."""

    def __init__(self, keys, columns, kinds, value: str, millis: str, delay_ms: int):
        super().__init__(keys, columns, kinds, None)
        self.value, self.millis, self.delay_ms = value, millis, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.total = handle.getValueState("total", f"total {self.kinds[0]}")
        self.moments = _Waiting(handle, "moments", ["bigint"], 1, timed=True)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.total.get()
        total = 0 if held is None else held[0]
        for frame in self.frames(rows):
            values = frame[self.value].to_numpy()[~frame[_FLAG + self.value].to_numpy(dtype=bool)]
            total = total + values.sum().item() if len(values) else total
            timed = ~frame[_FLAG + self.millis].to_numpy(dtype=bool)
            self.moments.add([np.unique(frame[self.millis].to_numpy()[timed]) + self.delay_ms])
        self.total.update((total,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # timers fire after all rows of a micro-batch
        total = self.total.get()[0]
        for (moments,) in self.moments.taken(timerValues.getCurrentWatermarkInMs()):
            moments = np.unique(moments)
            yield self.out(key, len(moments), fired_ms=moments, total=[total] * len(moments))


def sum_on_timer(
    df: DataFrame, keys: str | Sequence[str], value: str, millis: str, delay_ms: int = 5_000
) -> DataFrame:
    """(keys, fired_ms, total): the key's sum when event time is `delay_ms` past each row.

    `df` needs a watermark; `millis` is its event time in epoch milliseconds.
    """
    keys, kind = _names(keys), df.schema[value].dataType.simpleString()
    kinds = [kind, "bigint"]
    processor = _SumTimer(keys, [value, millis], kinds, value, millis, delay_ms)
    schema = _schema(df, keys, fired_ms="bigint", total=kind)
    return _apply(_packed(df, keys, [value, millis]), keys, processor, schema, "append", "eventTime")


class _LastRows(_Processor):
    """Emits each row of a group of keys with the maximum over it and its key's rows before it, in event-time order."""

    def __init__(self, keys, columns, kinds, value: str, millis: str, id_column: str, preceding: int):
        super().__init__(keys, columns, kinds, None)
        self.value, self.millis, self.id_column, self.preceding = value, millis, id_column, preceding

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        value, number = self.kinds[0], self.kinds[2]
        self.waiting = _Waiting(handle, "waiting", ["bigint", number, "string", value, "boolean"], 2, timed=True)
        # the last rows of each key, in order
        self.last = handle.getValueState("last", f"found array<string>, vals array<{value}>, missing array<boolean>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        behind = timerValues.getCurrentWatermarkInMs()
        for frame in self.frames(rows):
            frame = frame[(frame[self.millis] > behind) & ~frame[_FLAG + self.millis]]  # others are late
            columns = [self.millis, self.id_column, _KEY, self.value, _FLAG + self.value]
            self.waiting.add([frame[c].to_numpy() for c in columns])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.last.get()
        last: dict[str, list[tuple]] = {}
        for name, *row in zip(*(held or ((), (), ())), strict=True):
            last.setdefault(name, []).append(tuple(row))
        for moments, ids, names, values, missing in self.waiting.taken(timerValues.getCurrentWatermarkInMs()):
            order, parts = _parts(names)
            moments, ids, names = moments[order], ids[order], np.asarray(names, dtype=object)[order]
            values, missing = values[order], missing[order].astype(bool)
            top, empty = values.copy(), missing.copy()
            before = [last.get(name, []) for name, _, _ in parts]
            # the rows before a key's first one come in front of its rows
            at = np.repeat([low for _, low, _ in parts], list(map(len, before)))
            earlier = [row for part in before for row in part]
            all_values = np.insert(values, at, np.asarray([v for v, _ in earlier], dtype=values.dtype))
            all_gone = np.insert(missing, at, np.asarray([g for _, g in earlier], dtype=bool))
            sizes = np.asarray([high - low for _, low, high in parts])
            lengths = np.asarray(list(map(len, before)))
            ends = np.cumsum(sizes + lengths)
            begins = ends - sizes - lengths
            place = np.arange(len(values)) + np.repeat(np.cumsum(lengths), sizes)
            for back in range(1, self.preceding + 1):
                # the value `back` rows before, where the key has one
                found = place - back
                there = found >= np.repeat(begins, sizes)
                there[there] = ~all_gone[found[there]]
                better = there & (empty | (all_values[np.maximum(found, 0)] > top))
                top[better], empty[better] = all_values[found[better]], False
            out = {_KEY: names, self.id_column: ids, "ms": moments, "top": _series(top, empty).to_numpy()}
            yield pd.DataFrame(out)
            for (name, _, _), low, high in zip(parts, begins.tolist(), ends.tolist(), strict=True):
                keep = max(low, high - self.preceding)
                last[name] = list(zip(all_values[keep:high].tolist(), all_gone[keep:high].tolist(), strict=True))
        rows = [(name, *row) for name, part in last.items() for row in part]
        if rows:
            self.last.update(tuple(map(list, zip(*rows, strict=True))))


def max_over_preceding(
    df: DataFrame, keys: str | Sequence[str], value: str, millis: str, id_column: str, preceding: int = 2
) -> DataFrame:
    """(keys, id column, ms, top): the largest of a row's value and the `preceding` ones before it.

    `df` needs a watermark; a row comes out once the watermark has reached it. Equal times are ordered by the id.
    Times up to 1970 are late from the start, as that is where watermarks begin.
    """
    keys = _names(keys)
    columns = [value, millis, id_column]
    kinds = [df.schema[c].dataType.simpleString() for c in columns]
    processor = _LastRows(keys, columns, kinds, value, millis, id_column, preceding)
    outputs = {id_column: kinds[2], "ms": "bigint", "top": kinds[0]}
    return _apply_to_groups(df, keys, columns, processor, outputs, "eventTime")


class _Late(StatefulProcessor):
    """Compares every row with the watermark of its micro-batch; keeps nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        behind = timerValues.getCurrentWatermarkInMs()
        for frame in _named(rows, self.names):
            kept = frame.drop(columns=["part", "until"])
            yield kept.assign(late=frame["until"] <= behind)

    def close(self) -> None:
        pass


def marked_late(df: DataFrame, until: Column, parts: int | None = None) -> DataFrame:
    """The rows of a stream with a watermark, and `late`: event time had passed `until` before the row's micro-batch.

    `until` is the point in time up to which a row is in time: its own, or the end of its window. A NULL one
    is in time. Nothing is dropped, so the rows in time and the late ones are the input together.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nested = {f.name: f.dataType for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    flat = df.withColumns({name: F.to_json(name) for name in nested})
    # the event time goes along under another name, where Spark does not know it: it would drop late rows
    names = {c: f"_{n}" for n, c in enumerate(df.columns)}
    millis = F.coalesce(F.unix_millis(until.cast("timestamp")), F.lit(2**62))
    packed = flat.select(
        F.pmod(F.xxhash64(*flat.columns), F.lit(parts)).alias("part"),
        *[F.coalesce(F.col(c), _filler(flat.schema[c].dataType)).alias(n) for c, n in names.items()],
        *[F.col(c).isNull().alias(_FLAG + n) for c, n in names.items()],
        millis.alias("until"),
    )
    kinds = [f"`{n}` {packed.schema[n].dataType.simpleString()}" for n in packed.columns if n not in ("part", "until")]
    out = _apply(packed, ["part"], _Late(), ", ".join([*kinds, "late boolean"]), "append", "eventTime")
    back = []
    for c, n in names.items():
        value = F.when(~F.col(_FLAG + n), F.col(n))
        back.append((F.from_json(value, nested[c]) if c in nested else value).alias(c))
    return out.select(*back, "late")
