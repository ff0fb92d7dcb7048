"""Exact nearest neighbours by cosine similarity.

The collection stays where it lies: a block of query vectors is sent to the tasks, each of which goes over
its part of the collection in tiles and keeps the best per query. More queries are more blocks, one after the
other; no vector of the collection is ever shuffled. A query whose best in a tile is below the worst it
keeps already is passed over, which needs one maximum per query and tile.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidelog.operators.relational import top_n
from tidelog.session import materialize

# Query vectors sent to every task at once, and similarities worked out at once.
QUERIES_PER_BLOCK = 2_048
TILE = 1 << 21


def _unit(vectors) -> np.ndarray:
    matrix = np.stack([np.asarray(v, dtype=float) for v in vectors])
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    # a zero vector has no direction: NaN keeps it out of every result
    return matrix / np.where(norms == 0, np.nan, norms)


class _Best:
    """The `k` best (similarity, id) per query so far; equal similarities by smaller id."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.held = [(np.empty(0), None) for _ in queries]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(64, TILE // max(1, len(self.queries)))
        for at in range(0, len(ids), step):
            self._tile(ids[at : at + step], vectors[at : at + step])

    def _tile(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        similar = self.queries @ vectors.T
        floors = np.array([s[-1] if len(s) == self.k else -np.inf for s, _ in self.held])
        with np.errstate(invalid="ignore"):
            # a query or vector without direction is like nothing
            hopeful = np.flatnonzero((similar >= floors[:, None]).any(axis=1))
        for n in hopeful:
            scores = similar[n]
            best, best_ids = self.held[n]
            better = np.flatnonzero(scores >= floors[n])
            if len(better) > 4 * self.k:
                # the k best and all that equal the last of them
                kth = np.partition(scores[better], len(better) - self.k)[len(better) - self.k]
                better = better[scores[better] >= kth]
            scores = np.concatenate([best, scores[better]])
            found = ids[better] if best_ids is None else np.concatenate([best_ids, ids[better]])
            order = np.argsort(found, kind="stable")
            order = order[np.argsort(-scores[order], kind="stable")][: self.k]
            self.held[n] = scores[order], found[order]

    def rows(self, query_ids) -> pd.DataFrame:
        return pd.DataFrame(
            [
                (query, found, score)
                for query, (scores, ids) in zip(query_ids, self.held, strict=True)
                if ids is not None
                for score, found in zip(scores.tolist(), ids.tolist(), strict=True)
            ],
            columns=["query_id", "neighbour_id", "similarity"],
        )


def cosine_top_k(
    collection: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector: str = "embedding",
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """The `k` nearest rows of `collection` for each row of `queries`.

    `queries` has (query_id, vector); ids of the collection are numbers or text. About
    `queries_per_block` queries are sent to all tasks at once, and for each such block the collection is
    read once, without a shuffle. A task hands on no more than `k` rows per query.
    """
    rows = collection.select(F.col(id_column).alias("_id"), F.col(vector).alias("_vector"))
    wanted = queries.select("query_id", F.col("vector").alias("_query"))
    wanted = wanted.filter("_query IS NOT NULL")
    rows = rows.filter("_vector IS NOT NULL AND _id IS NOT NULL")
    schema = T.StructType(
        [
            wanted.schema["query_id"],
            T.StructField("neighbour_id", rows.schema["_id"].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    first = wanted.limit(queries_per_block + 1).collect()
    if len(first) <= queries_per_block:
        near = _near(rows, first, k, schema)
    else:
        # stored, so that every job finds the same queries in a block
        wanted = materialize(wanted, "queries")
        blocks = -(-wanted.count() // queries_per_block)
        block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
        parts = [_near(rows, wanted.filter(block == n).collect(), k, schema) for n in range(blocks)]
        near = reduce(DataFrame.unionByName, [materialize(part, "near") for part in parts])
    order = [F.col("similarity").desc(), F.col("neighbour_id")]
    return top_n(near, ["query_id"], order, k)


def _near(rows: DataFrame, queries: list, k: int, schema: T.StructType) -> DataFrame:
    if not queries:
        return rows.sparkSession.createDataFrame([], schema)
    ids = [q["query_id"] for q in queries]
    sent = rows.sparkSession.sparkContext.broadcast(_unit(q["_query"] for q in queries))

    def search(batches):
        best = _Best(sent.value, k)
        for batch in batches:
            if len(batch):
                best.add(batch["_id"].to_numpy(), _unit(batch["_vector"]))
        yield best.rows(ids)

    return rows.mapInPandas(search, schema)


def label_centroids(collection: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Mean vector of each label as (query_id, vector): ready to be used as queries.

    Each task adds up its vectors per label, so what meets is one sum per label and task. NULLs do not
    count, place by place.
    """
    rows = collection.filter(F.col(vector).isNotNull()).select(
        F.col(label).alias("query_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    schema = T.StructType([rows.schema["query_id"], *T._parse_datatype_string("place int, total double, n bigint").fields])

    kind = to_arrow_type(schema["query_id"].dataType)

    def add_up(batches):
        sums: dict = {}
        for batch in batches:
            labels, flat = batch.column(0).to_pylist(), batch.column(1).flatten()
            offsets = np.asarray(batch.column(1).offsets)
            sizes = np.diff(offsets)
            values = np.asarray(flat.fill_null(0.0), dtype=float)
            there = np.asarray(flat.is_valid().to_numpy(zero_copy_only=False), dtype=np.int64)
            place = np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)
            codes: dict = {}
            owner = np.repeat([codes.setdefault(x, len(codes)) for x in labels], sizes).astype(np.int64)
            width = int(sizes.max(initial=0))
            totals = np.bincount(owner * width + place, values, len(codes) * width).reshape(-1, width)
            counts = np.bincount(owner * width + place, there, len(codes) * width).reshape(-1, width)
            for x, c in codes.items():
                held = sums.setdefault(x, (np.zeros(0), np.zeros(0)))
                size = max(len(held[0]), width)
                sums[x] = tuple(np.pad(h, (0, size - len(h))) + np.pad(new[c], (0, size - width)) for h, new in zip(held, (totals, counts), strict=True))
        for x, (total, n) in sums.items():
            used = np.flatnonzero(n)
            columns = [pa.array([x] * len(used), type=kind), pa.array(used.astype(np.int32)), pa.array(total[used]), pa.array(n[used].astype(np.int64))]
            names = ["query_id", "place", "total", "n"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    partial = rows.mapInArrow(add_up, schema).groupBy("query_id", "place")
    means = partial.agg((F.sum("total") / F.sum("n")).alias("mean"))
    # one entry per dimension
    return means.groupBy("query_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "mean"))), lambda entry: entry["mean"]).alias("vector")
    )
