"""Threshold-scaled sketches: every shingle hash below a fixed fraction of all, whatever the text's length.

The shingles are runs of five lower-cased words (all words, where there are fewer), hashed to 48 bits. A
sketch keeps every hash below `FRACTION` of the range and, for short texts, at least the `FLOOR` smallest.
It says below which bound it is complete: the fraction's, the least hash left out, or none. Below the
smaller bound of two sketches both are whole samples by the same rule, so there

- |A and B| / |A| estimates how much of A is contained in B, however unequal they are, and
- the union of the hashes is the sketch of both texts together: sketches merge.

A fingerprint is a sketch as text: base 64 of six bytes for the bound and six for each hash, in order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.minhash import shingle_sets

FRACTION = 1 / 16
FLOOR = 32
ALL = 1 << 48
_SHIFT = np.uint64(16)
_DOCS_A_TURN = 500

Sketch = tuple[int, np.ndarray]


def sketch(shingles: np.ndarray, fraction: float = FRACTION, floor: int = FLOOR) -> Sketch:
    """(bound, sorted hashes below it) of a set of 64-bit shingle hashes."""
    hashes = np.unique(shingles >> _SHIFT)
    bound = int(ALL * fraction)
    kept = int(np.searchsorted(hashes, np.uint64(bound)))
    if kept >= floor:
        return bound, hashes[:kept]
    if len(hashes) <= floor:
        return ALL, hashes
    return int(hashes[floor - 1]) + 1, hashes[:floor]


def encode(made: Sketch) -> str:
    values = np.concatenate([np.array([made[0] - 1], dtype=np.uint64), made[1]])
    return base64.b64encode(values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decode(fingerprint: str) -> Sketch:
    raw = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, 2:] = raw
    values = wide.view(">u8").ravel().astype(np.uint64)
    return int(values[0]) + 1, values[1:]


def _within(a: Sketch, b: Sketch) -> tuple[np.ndarray, np.ndarray]:
    bound = np.uint64(min(a[0], b[0]))
    return a[1][: np.searchsorted(a[1], bound)], b[1][: np.searchsorted(b[1], bound)]


def merge(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of two texts' shingles together."""
    return min(a[0], b[0]), np.union1d(*_within(a, b))


def containment(a: Sketch, b: Sketch) -> float:
    """Estimated share of the shingles of `a` that `b` has; 0 where nothing of `a` is in reach."""
    left, right = _within(a, b)
    return len(np.intersect1d(left, right, assume_unique=True)) / len(left) if len(left) else 0.0


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated containment of the smaller in the larger; two sketches without shingles are alike."""
    left, right = _within(a, b)
    if not len(left) or not len(right):
        return float(not len(a[1]) and not len(b[1]))
    return len(np.intersect1d(left, right, assume_unique=True)) / min(len(left), len(right))


def _sketches(texts: list[str]) -> list[Sketch]:
    return [sketch(s) for s in shingle_sets(pa.array(texts, type=pa.string()))]


def _order(df: DataFrame) -> DataFrame:
    """Documents with the columns that put them in descending order of doc_id: those without one last, equal ids by a hash of the text."""
    text = F.coalesce("text", F.lit(""))
    return df.select(
        F.col("doc_id").isNull().cast("bigint").alias("last"),
        F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("key"),
        F.xxhash64(text).alias("mark"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text.alias("text"),
    )


_DEALT = "part int, guest boolean, last bigint, key bigint, mark bigint, copies bigint, doc_id bigint, text string"


def _deal(heads: list[tuple]):
    """Rows with the number of the range they are in. Equal rows of a batch are one with a count, and the
    first row of a range also goes, as a guest, to the range before it: that is where the text next to
    that range's last row is needed."""
    bounds = [np.array(c, dtype=np.int64) for c in zip(*heads, strict=True)]
    known = {head: n for n, head in enumerate(heads)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.asarray(batch.column(n)) for n in range(3)]
            order = np.lexsort(rows[::-1])
            first = np.ones(len(order), dtype=bool)
            first[1:] = np.any([r[order][1:] != r[order][:-1] for r in rows], axis=0)
            at = order[first]
            copies = np.diff(np.append(np.flatnonzero(first), len(order)))
            # rank of each row among the heads; a head comes before the rows that equal it
            both = [np.concatenate([b, r[at]]) for b, r in zip(bounds, rows, strict=True)]
            is_row = np.concatenate([np.zeros(len(heads), dtype=np.int8), np.ones(len(at), dtype=np.int8)])
            merged = np.lexsort([is_row, *both[::-1]])
            rank = np.empty(len(merged), dtype=np.int64)
            rank[merged] = np.cumsum(is_row[merged] == 0) - 1
            part = rank[len(heads) :]
            guests = [
                (j, known[k])
                for j, k in enumerate(zip(*(r[at].tolist() for r in rows), strict=True))
                if k in known and k not in shown
            ]
            shown.update(heads[n] for _, n in guests)
            pick = np.concatenate([np.arange(len(at)), np.array([j for j, _ in guests], dtype=np.int64)])
            part = np.concatenate([part, np.array([(n - 1) % len(heads) for _, n in guests], dtype=np.int64)])
            taken = batch.take(pa.array(at[pick]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part.astype(np.int32)),
                    pa.array(np.arange(len(pick)) >= len(at)),
                    *taken.columns[:3],
                    pa.array(copies[pick].astype(np.int64)),
                    *taken.columns[3:],
                ],
                names=["part", "guest", "last", "key", "mark", "copies", "doc_id", "text"],
            )

    return run


_OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range, its guest last -> each row beside its next one."""
    held: list[tuple] = []  # (order key, doc_id, text, copies, its sketch or None)

    def out(texts: list[tuple]) -> pa.RecordBatch:
        """Rows for all but the last of `texts`, and for its copies but one."""
        made = _sketches([t[2] for t in texts if t[4] is None])
        made.reverse()
        own = [t[4] if t[4] is not None else made.pop() for t in texts]
        pairs = []
        for j, (_, doc_id, text, copies, _) in enumerate(texts):
            if copies > 1:
                pairs += [(doc_id, j, j)] * (copies - 1)
            if j + 1 < len(texts):
                pairs.append((doc_id, j, j + 1))
        texts[-1] = (*texts[-1][:3], 1, own[-1])
        edited = []
        for _, j, k in pairs:
            text, half = texts[j][2], len(texts[j][2]) // 2
            edited.append(text[: len(text) - half] + texts[k][2][:half])
        changed = _sketches(edited)
        columns = [
            [doc_id for doc_id, _, _ in pairs],
            [len(texts[j][2]) for _, j, _ in pairs],
            [hashlib.sha256(e.encode()).hexdigest() for e in edited],
            [encode(own[j]) for _, j, _ in pairs],
            [encode(c) for c in changed],
            [likeness(own[j], c) for (_, j, _), c in zip(pairs, changed, strict=True)],
            [likeness(own[j], own[k]) for _, j, k in pairs],
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [c.split()[0] for c in _OUT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names)

    ended = False
    for batch in batches:
        for at in range(0, batch.num_rows, _DOCS_A_TURN):
            part = batch.slice(at, _DOCS_A_TURN)
            guest, *key, copies, doc_id, text = (c.to_pylist() for c in part.columns[1:])
            for g, k, c, i, t in zip(guest, zip(*key, strict=True), copies, doc_id, text, strict=True):
                if ended:  # further copies of the guest
                    break
                if not g and held and held[-1][0] == k:
                    _, i, t, before, made = held.pop()
                    held.append((k, i, t, before + c, made))
                else:
                    held.append((k, i, t, 1 if g else c, None))
                ended = g
            if len(held) > 1:
                yield out(held)
                held = held[-1:]


def scaled_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per document its fingerprint, and how alike it is to an edited text and to the next document.

    `docs` needs doc_id and text; other columns are left aside. The next document is the one with the
    next smaller doc_id, after the last the first. The edited text has the last floor(n_chars / 2) code
    points replaced by the first as many of the next document, or by all it has. Returned are
    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    A null text is an empty one; texts without words have fingerprints without hashes, which are alike
    to each other (1) and to no other (0). Rows without a doc_id come last. Rows of equal doc_id are
    next to each other in the order of a hash of their texts, and each gives a row. An only document is
    its own next one. No rows give no rows.

    The documents' keys are read first and dealt into `ranges` ranges (the session's shuffle partitions
    if not given), of which only the first key comes to the driver. Then each text is shuffled once, to
    its range, and read in order there; no range waits for another.
    """
    spark = docs.sparkSession
    rows = _order(docs)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.select("last", "key", "mark")
    dealt = keys.repartitionByRange(ranges, "last", "key", "mark").withColumn("part", F.spark_partition_id())
    heads = sorted(
        (r["h"]["last"], r["h"]["key"], r["h"]["mark"])
        for r in dealt.groupBy("part").agg(F.min(F.struct("last", "key", "mark")).alias("h")).collect()
    )
    if not heads:
        return spark.createDataFrame([], _OUT)
    placed = rows.mapInArrow(_deal(heads), _DEALT).repartitionById(len(heads), F.col("part"))
    return placed.sortWithinPartitions("guest", "last", "key", "mark").mapInArrow(_compare, _OUT)
