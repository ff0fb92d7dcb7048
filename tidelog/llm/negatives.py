"""Hard negatives by a secondary sort: scores under (anchor, descending score, id) keys, read as a stream.

Rows of the table are scored against the anchors in blocks: a block of anchors is sent to the tasks, each
task reads its share of the table where it lies. What an anchor cannot need does not leave a task:

1. Of the rows with the anchor's label a task hands on the `positives` best; the best of these are the anchor's.
2. Now the windows are known that the positives open. Of the rows with other labels a task hands on, for each
   window, the `negatives` best inside.
3. Both kinds are shuffled by anchor and sorted by (anchor, descending score, positives first, id). One
   pass over the sorted rows opens a window at each positive and gives out the negatives that follow in it. It
   keeps the open windows of one anchor, never its rows.

Scores are exact: matrices of floats are only used where every sum stays below their whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.storage import Stored, shuffle_files_removed, store
from tidelog.session import work_dir

POSITIVES = 5
NEGATIVES = 3
#: components of the anchors sent to the tasks at once, and scores worked out at once
BLOCK_VALUES = 1 << 20
TILE = 1 << 21
_LONG = 2**63 - 1


def quantised(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(row, id, label, vector, anchor): components as floor(256 * x), rows without usable vector or label left out."""
    number = F.col(id_column)

    def whole(x):  # from 2^52 on a double is whole
        scaled = x.cast("double") * 256
        return F.when(F.abs(scaled) < 2**52, F.floor(scaled).cast("double")).otherwise(scaled)

    value = F.transform(F.col(vector), whole)
    usable = F.col(label).isNotNull() & F.col(vector).isNotNull()
    finite = F.forall(
        F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    moved = F.when(F.coalesce(number % 7 == 0, F.lit(False)), (F.col(label) + 1) % 10).otherwise(F.col(label))
    return table.filter(usable & F.coalesce(finite, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"),
        number.cast("bigint").alias("id"),
        moved.cast("bigint").alias("label"),
        value.alias("vector"),
        F.coalesce(number % 50 == 0, F.lit(False)).alias("anchor"),
    )


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows; missing places at the end are 0."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(np.asarray(vectors.offsets)).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.asarray(vectors.flatten(), dtype=float)
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of whole numbers, as 64-bit integers.

    Beyond 64 bits a score is the greatest or the least long.
    """
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    # no partial sum is beyond the product of the norms
    most = np.linalg.norm(left, axis=1).max(initial=0) * np.linalg.norm(right, axis=1).max(initial=0) * 1.001
    if most < 2**24:
        return (left.astype(np.float32) @ right.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (left @ right.T).astype(np.int64)
    if most < 2**62:
        return left.astype(np.int64) @ right.astype(np.int64).T
    whole = [[[int(x) for x in row] for row in side] for side in (left, right)]
    exact = [[min(max(sum(map(int.__mul__, a, b)), -_LONG), _LONG) for b in whole[1]] for a in whole[0]]
    return np.array(exact, dtype=np.int64).reshape(len(left), len(right))


def window(score: int) -> tuple[int, int]:
    """The least and the greatest negative score n with 50 * score <= 100 * n <= 95 * score."""
    return -(-50 * score // 100), 95 * score // 100


class _Best:
    """For each anchor and slot the best (score, id, row) so far: higher scores first, then smaller ids."""

    def __init__(self, anchors: int, slots: int, keep: int):
        self.keep = keep
        self.score = np.full((anchors, slots, keep), -_LONG, dtype=np.int64)
        self.id = np.zeros((anchors, slots, keep), dtype=np.int64)
        self.row = np.full((anchors, slots, keep), -1, dtype=np.int64)

    def offer(self, slot: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scores of all anchors (down) and some table rows (across, in ascending order of id)."""
        last = self.score[:, slot, -1][:, None]
        open_place = self.row[:, slot, -1][:, None] < 0
        anchor, at = np.nonzero(allowed & (open_place | (scores >= last)))
        if not len(anchor):
            return
        found = np.unique(anchor)
        value = [scores[anchor, at], ids[at], rows[at]]
        held = [x[found, slot] for x in (self.score, self.id, self.row)]
        real = held[2] >= 0
        owner = np.concatenate([np.broadcast_to(found[:, None], real.shape)[real], anchor])
        value = [np.concatenate([h[real], v]) for h, v in zip(held, value, strict=True)]
        order = np.lexsort((value[2], value[1], -value[0], owner))
        owner, value = owner[order], [v[order] for v in value]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        good = place < self.keep
        for target, v in zip((self.score, self.id, self.row), value, strict=True):
            target[owner[good], slot, place[good]] = v[good]

    def batch(self, rows: np.ndarray) -> pa.RecordBatch:
        anchor, slot, place = np.nonzero(self.row >= 0)
        found = [pa.array(x[anchor, slot, place]) for x in (self.score, self.id, self.row)]
        return pa.RecordBatch.from_arrays([pa.array(rows[anchor]), *found], names=["anchor", "score", "id", "row"])


_FOUND = "anchor bigint, score bigint, id bigint, row bigint"
#: an id that is missing comes after all others
_NO_ID = 2**63 - 1


def _tiles(batches: Iterable[pa.RecordBatch], anchors: int) -> Iterator[tuple]:
    """(ids, rows, labels, matrix) of some rows of the table, in ascending order of id."""
    for batch in batches:
        step = max(256, TILE // max(1, anchors))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            ids = np.asarray(part.column("id").fill_null(_NO_ID), dtype=np.int64)
            order = np.argsort(ids, kind="stable")
            rows, labels = (np.asarray(part.column(c))[order] for c in ("row", "label"))
            yield ids[order], rows, labels, _matrix(part.column("vector"))[order]


def _positives(sent, keep: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, vectors = sent.value[:3]
        best = _Best(len(rows), 1, keep)
        for ids, table_rows, table_labels, matrix in _tiles(batches, len(rows)):
            for label in np.intersect1d(labels, table_labels):  # only rows of one label meet
                own, other = np.flatnonzero(labels == label), np.flatnonzero(table_labels == label)
                scores = np.zeros((len(rows), len(other)), dtype=np.int64)
                scores[own] = products(vectors[own], matrix[other])
                allowed = (labels == label)[:, None] & (rows[:, None] != table_rows[other])
                best.offer(0, scores, allowed, ids[other], table_rows[other])
        yield best.batch(rows)

    return run


def _negatives(sent, keep: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, vectors, windows = sent.value
        slots = max(map(len, windows), default=0)
        # no score lies in the window of a slot that an anchor does not use
        low, high = np.full((len(rows), slots), _LONG), np.full((len(rows), slots), -_LONG)
        for j, own in enumerate(windows):
            for slot, (a, b) in enumerate(own):
                low[j, slot], high[j, slot] = a, b
        best = _Best(len(rows), slots, keep)
        for ids, table_rows, table_labels, matrix in _tiles(batches, len(rows)):
            scores = products(vectors, matrix)
            other = labels[:, None] != table_labels
            for slot in range(slots):
                inside = other & (scores >= low[:, slot, None]) & (scores <= high[:, slot, None])
                best.offer(slot, scores, inside, ids, table_rows)
        yield best.batch(rows)

    return run


def _windows_of(scores) -> list[tuple[int, int]]:
    found = (window(s) for s in sorted(set(scores or ()), reverse=True))
    return [(low, high) for low, high in found if low <= high]


_OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _stream(keep: int):
    """Rows sorted by (anchor, descending score, positives first, id) -> the negatives of each positive."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []
        for batch in batches:
            out: list[tuple] = []
            rows = (batch.column(c).to_pylist() for c in ("anchor", "anchor_id", "score", "positive", "id"))
            for number, anchor_id, score, positive, found in zip(*rows, strict=True):
                if number != anchor:
                    anchor, windows = number, []
                if positive:
                    low, high = window(score)
                    if low <= high:
                        windows.append([low, high, 0, found, score])
                    continue
                for w in windows:
                    if w[0] <= score <= w[1]:
                        w[2] += 1
                        out.append((anchor_id, w[3], w[2], found, w[4], score))
                windows = [w for w in windows if w[2] < keep and w[0] <= score]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in _OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


class _Blocks:
    """The anchors in blocks of about `values` components, each sent to the tasks while it is worked on."""

    def __init__(self, rows: Stored, values: int):
        self.spark = rows.rows.sparkSession
        self.anchors = rows.rows.filter("anchor")
        size = self.anchors.agg(F.sum(F.size("vector") + F.lit(8))).first()[0] or 0
        self.count = -(-int(size) // values)
        self.block = F.pmod(F.xxhash64("row"), F.lit(max(1, self.count)))

    def each(self, table: DataFrame, worker, keep: int, name: str, windows: DataFrame | None = None) -> DataFrame:
        """worker over the whole table for each block of anchors; what it finds is one table."""
        path, written = work_dir(self.spark, name), []
        for number in range(self.count):
            anchors = self.anchors.filter(self.block == number)
            if windows is not None:
                anchors = anchors.join(windows, anchors["row"] == windows["of"], "left")
            held = anchors.toArrow()
            if not held.num_rows:
                continue
            sent = [np.asarray(held["row"]), np.asarray(held["label"]), _matrix(held["vector"])]
            if windows is not None:
                sent.append([_windows_of(scores) for scores in held["scores"].to_pylist()])
            shared = self.spark.sparkContext.broadcast(tuple(sent))
            with shuffle_files_removed(self.spark):
                table.mapInArrow(worker(shared, keep), _FOUND).write.parquet(f"{path}/block={number}")
            shared.unpersist()
            written.append(f"{path}/block={number}")
        return self.spark.read.schema(_FOUND).parquet(*written) if written else self.spark.createDataFrame([], _FOUND)


def hard_negatives(
    table: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, block_values: int = BLOCK_VALUES
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for a table of vectors.

    `table` needs vec_id, embedding and label; other columns are left aside. Anchors are the rows whose
    vec_id is divisible by 50. A score is the inner product of two vectors' components floor(256 * x);
    where vec_id is divisible by 7 the label is first moved on by one, modulo 10. An anchor's positives are
    its `positives` best other rows of the same label; a negative of a positive is a row of another label
    with half to 95 % of its score. Higher scores come first, equal ones by smaller vec_id.

    Rows without label, without vector or with a component that is null or not finite take no part. A row
    without vec_id can be a negative or a positive, after all others of its score. Repeated rows are each a row
    of their own, anchors too. Of vectors of different lengths the components that both have count. Scores that
    do not fit 64 bits are the greatest or least long. An anchor without positives or negatives gives no rows,
    and neither does an empty table.

    At most `block_values` components of anchors are with a task or the driver at once (one vector, if longer).
    """
    rows = store(quantised(table), "vectors")
    blocks = _Blocks(rows, block_values)
    by_anchor = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    near = blocks.each(rows.rows, _positives, positives, "near")
    kept = store(near.withColumn("_place", F.row_number().over(by_anchor)).filter(F.col("_place") <= positives).drop("_place"), "positives")
    windows = kept.rows.groupBy(F.col("anchor").alias("of")).agg(F.collect_list("score").alias("scores"))
    far = blocks.each(rows.rows, _negatives, negatives, "far", windows)
    # windows that overlap find a row several times
    far = far.distinct()
    sides = [side.withColumn("positive", F.lit(p)) for side, p in ((kept.rows, True), (far, False))]
    scored = reduce(DataFrame.unionByName, sides)
    names = rows.rows.filter("anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    keyed = scored.join(names, "anchor").withColumn("down", F.bitwise_not("score"))
    mined = (
        keyed.repartition("anchor")
        .sortWithinPartitions("anchor", "down", F.desc("positive"), "id", "row")
        .withColumn("id", F.when(F.col("id") != _NO_ID, F.col("id")))
        .mapInArrow(_stream(negatives), _OUT)
    )
    return mined
