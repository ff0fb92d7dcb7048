"""Near copies: fast similarity sketches, banding, exact verification.

A text's set is that of its runs of five lower-cased words, as 64-bit fingerprints. The sketch has
`COORDINATES` bins. In round i each member of the set is hashed to a bin and leaves i plus its hash
there if that is less than what the bin holds; rounds go on until no bin is empty. From round
`COORDINATES` on, round i puts all members into bin i - COORDINATES, so 2 x COORDINATES rounds fill any
sketch. Two sketches agree in a bin with the sets' Jaccard similarity as probability, and the number of
agreeing bins is as concentrated as with independent draws (Dahlgaard, Knudsen, Thorup 2017).

Equal sets are one node. Nodes that agree in a band of `ROWS` bins are in a bucket together: those of
similarity 0.75 meet with a probability of 99.97 %, of 0.8 with 99.9997 %, of 0.45 with 30 %, of 0.3 with 3 %.
Only links between different components matter, so not all pairs of a bucket are looked at:

1. In a bucket each node meets the leader, the node with the most company in all its buckets. Each
   node is compared with the leader it meets most often.
2. In a bucket that still holds several components (of buckets with the same nodes one), all nodes outside
   its largest component are compared with all nodes of other components of the bucket, in blocks of
   about `BLOCK` by `BLOCK` nodes, so that a large bucket is many blocks. Sets whose sizes alone rule
   out the similarity are passed over; a task counts the members that a set has in common with all others at
   once, and hands on links only. Nodes that never meet in a bucket are not compared, however long
   the chain of buckets between them.

All comparisons are made on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.components import components
from tidelog.llm.storage import store
from tidelog.llm.words import FACTORS, mixed, pieces, words_of

SHINGLE = 5
COORDINATES = 256
ROWS = 6
BANDS = 42
BLOCK = 1024
_EMPTY = np.uint64(2**64 - 1)
_LOW = np.uint64(2**48 - 1)


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct fingerprints of its runs of n words."""
    for low, high in pieces(texts):
        words = words_of(texts.slice(low, high - low), lower=True)
        marks, _ = words.runs(n)
        for k in range(high - low):
            a, b = int(words.first[k]), int(words.first[k + 1])
            if b - a >= n:
                yield np.unique(marks[a : b - n + 1])
            elif b > a:
                few = np.zeros(1, dtype=np.uint64)
                for j in range(b - a):
                    few += words.mark[a + j : a + j + 1] * FACTORS[j : j + 1]
                yield mixed(few, 77 + b - a)
            else:
                yield np.zeros(0, dtype=np.uint64)


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """One row of t values for each set that is not empty; rows of empty sets stay empty."""
    out = np.full((len(sets), t), _EMPTY, dtype=np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    members = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    for i in range(2 * t):
        if not len(members):
            break
        hashed = mixed(members, i + 1)
        bins = (hashed >> np.uint64(48)).astype(np.int64) % t if i < t else i - t
        np.minimum.at(flat, owner * t + bins, (np.uint64(i) << np.uint64(48)) | (hashed & _LOW))
        open_rows = (out == _EMPTY).any(axis=1)
        going = open_rows[owner]
        members, owner = members[going], owner[going]
    return out


def band_keys(sketch: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """A key for each band of each sketch."""
    cut = sketch[:, : rows * bands].reshape(len(sketch), bands, rows)
    return mixed((mixed(cut) * FACTORS[:rows]).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))


_SKETCHED = (
    "row bigint, doc_id bigint, text string, n_shingles bigint, high bigint, low bigint, bands array<bigint>"
)
_DOCS_A_TURN = 400


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for at in range(0, batch.num_rows, _DOCS_A_TURN):
            part = batch.slice(at, _DOCS_A_TURN)
            texts = part.column(1)
            sets = list(shingle_sets(texts))
            found = sketches(sets)
            sizes = np.array([len(x) for x in sets], dtype=np.int64)
            full = sizes > 0
            keys = band_keys(found[full]).view(np.int64)
            counts = np.where(full, BANDS, 0)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            high = [int(mixed(x, 1001).sum(dtype=np.uint64)) for x in sets]
            low = [int(mixed(x, 1002).sum(dtype=np.uint64)) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(2) if part.num_columns > 2 else pa.array(np.arange(number, number + len(sets))),
                    part.column(0),
                    texts,
                    pa.array(sizes),
                    pa.array(np.array(high, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(low, dtype=np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                ],
                names=["row", "doc_id", "text", "n_shingles", "high", "low", "bands"],
            )
            number += len(sets)


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = pa.array([x.tobytes() for x in shingle_sets(batch.column(1))], type=pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["node", "members"])


def _verify(least_percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                left = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                right = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(left, right, assume_unique=True))
                linked.append(100 * both >= least_percent * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, type=pa.bool_())], names=["a", "b", "linked"]
            )

    return run


def links_between(
    some: list[np.ndarray], of_some: np.ndarray, others: list[np.ndarray], of_others: np.ndarray, least_percent: int
) -> Iterator[tuple[int, int]]:
    """Numbers of sets in different components that are similar enough; one pair for a set and a component.

    No set is empty.
    """
    if not some or not others:
        return
    order = np.argsort([len(x) for x in others], kind="stable")
    sizes, of_sorted = np.array([len(others[m]) for m in order]), of_others[order]
    known, places = np.unique(np.concatenate([others[m] for m in order]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(len(known), dtype=np.int32)
    for n, members in enumerate(some):
        low = np.searchsorted(100 * sizes, least_percent * len(members))
        high = np.searchsorted(least_percent * sizes, 100 * len(members), side="right")
        if low >= high:
            continue
        at = np.searchsorted(known, members)
        at = at[known[np.minimum(at, len(known) - 1)] == members]
        marked[at] = 1
        both = np.add.reduceat(marked[places[starts[low] : starts[high]]], starts[low:high] - starts[low])
        marked[at] = 0
        linked = 100 * both >= least_percent * (sizes[low:high] + len(members) - both)
        found = low + np.flatnonzero(linked & (of_sorted[low:high] != of_some[n]))
        _, first = np.unique(of_sorted[found], return_index=True)
        for m in order[found[first]].tolist():
            yield n, m


def _links_of_block(rows: pa.Table, least_percent: int) -> pa.RecordBatch:
    stray = np.asarray(rows.column("stray").to_numpy(zero_copy_only=False), dtype=bool)
    of = rows.column("of").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in rows.column("members")]
    a, b = np.flatnonzero(stray), np.flatnonzero(~stray)
    pairs = links_between([sets[n] for n in a], of[a], [sets[n] for n in b], of[b], least_percent)
    ends = np.array([(of[a[n]], of[b[m]]) for n, m in pairs], dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


def _block_links(least_percent: int):
    """Rows sorted by block -> links; the rows of one block follow each other."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            block = np.stack([batch.column(n).to_numpy() for n in ("key", "i", "j")])
            cuts = np.flatnonzero((block[:, 1:] != block[:, :-1]).any(axis=0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                now = tuple(block[:, low].tolist())
                if held and now != last:
                    yield _links_of_block(pa.Table.from_batches(held), least_percent)
                    held = []
                last = now
                held.append(batch.slice(low, high - low))
        if held:
            yield _links_of_block(pa.Table.from_batches(held), least_percent)

    return run


def _bucket_blocks(nodes: DataFrame) -> DataFrame:
    """(key, node, of) -> a row for each block a node takes part in, with the block's two numbers."""
    sizes = nodes.groupBy("key", "of").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "of")).alias("largest"))
    buckets = buckets.select(
        "key",
        F.col("largest.of").alias("main"),
        F.ceil(F.col("n") / BLOCK).alias("columns"),
        F.greatest(F.ceil((F.col("n") - F.col("largest.n")) / BLOCK), F.lit(1)).alias("rows"),
    )
    placed = nodes.join(buckets, "key")
    row = F.pmod(F.xxhash64("node", F.lit(1)), "rows")
    column = F.pmod(F.xxhash64("node", F.lit(2)), "columns")
    strays = placed.filter("of <> main").select(
        "key", "node", "of", F.lit(True).alias("stray"), row.alias("i"), F.explode(F.expr("sequence(0L, columns - 1)")).alias("j")
    )
    others = placed.select(
        "key", "node", "of", F.lit(False).alias("stray"), F.explode(F.expr("sequence(0L, rows - 1)")).alias("i"), column.alias("j")
    )
    return strays.unionByName(others)


def _with_component(rows: DataFrame, components_of: DataFrame, name: str) -> DataFrame:
    """The rows with the smallest node of their node's component."""
    of = components_of.select(F.col("a").alias("node"), F.col("b").alias("_of"))
    return rows.join(of, "node", "left").withColumn(name, F.coalesce("_of", "node")).drop("_of")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_percent: int = 75,
    number_col: str | None = None,
) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept), one row for each row of `docs`.

    Texts whose sets have at least `least_percent` of similarity are linked; `component_id` is the
    smallest id in reach. Empty texts (a null text is one) are linked with nothing. The row with the
    smallest id of a component is kept, one of those if rows repeat; a null id is larger than any other.
    `row` is a number given to each row, or what `number_col` has, which must differ between rows.
    Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if number_col:
        rows = docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.col(text_col).alias("text"),
            F.col(number_col).cast("bigint").alias("number"),
        )
    whole = store(rows.mapInArrow(_sketch, _SKETCHED), "sketches")
    docs_of = store(whole.rows.select("row", "doc_id", "n_shingles", "high", "low"), "sets").rows
    largest = F.lit((1 << 63) - 1)
    smallest = F.min(F.struct(F.coalesce("doc_id", largest).alias("order"), F.col("doc_id"), F.col("row")))
    nodes = store(
        whole.rows.filter("n_shingles > 0")
        .groupBy("high", "low")
        .agg(
            F.min("row").alias("node"),
            smallest.alias("least"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    ).rows
    spread = nodes.select("node", F.explode("bands").alias("key"))
    crowd = spread.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = store(spread.join(crowd, "key"), "buckets").rows
    company = buckets.groupBy("node").agg(F.sum("n").alias("company"))
    ranked = buckets.join(company, "node")
    leaders = store(
        ranked.groupBy("key").agg(F.max(F.struct("company", (-F.col("node")).alias("back"))).alias("leader")), "leaders"
    ).rows
    met = (
        buckets.join(leaders.select("key", (-F.col("leader.back")).alias("leader")), "key")
        .filter("node <> leader")
        .groupBy("node", "leader")
        .agg(F.count("*").alias("times"))
    )
    stars = store(met, "stars")
    company_nodes = buckets.select(F.col("node").alias("row")).distinct()
    texts = whole.rows.select("row", "text").join(company_nodes, "row", "left_semi")
    members = store(texts.mapInArrow(_members, "node bigint, members binary"), "members")
    whole.drop()

    best = stars.rows.groupBy("node").agg(
        F.max(F.struct("times", (-F.col("leader")).alias("back"))).alias("best")
    )
    best = best.select("node", (-F.col("best.back")).alias("leader")).select(*_pair("node", "leader")).distinct()
    right = members.rows.select(F.col("node").alias("b"), F.col("members").alias("right"))
    left = members.rows.select(F.col("node").alias("a"), F.col("members").alias("left"))
    checked = best.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    compared = store(checked.mapInArrow(_verify(least_percent), "a bigint, b bigint, linked boolean"), "compared")
    first = components(compared.rows.filter("linked").select("a", "b"))

    placed = store(_with_component(buckets.select("key", "node"), first.rows, "of"), "placed").rows
    several = placed.groupBy("key").agg(
        F.min("of").alias("x"),
        F.max("of").alias("y"),
        F.count("*").alias("n"),
        *[F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(name) for seed, name in ((3, "p"), (4, "q"))],
    )
    several = several.filter("x <> y").groupBy("n", "p", "q").agg(F.min("key").alias("key")).select("key")
    open_nodes = store(placed.join(several, "key").select("key", "node", "of"), "open").rows
    final = first
    if not open_nodes.isEmpty():
        partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = _bucket_blocks(open_nodes).join(members.rows, "node").repartition(partitions, "key", "i", "j")
        blocks = blocks.sortWithinPartitions("key", "i", "j")
        more = store(blocks.mapInArrow(_block_links(least_percent), "a bigint, b bigint").distinct(), "links")
        final = components(first.rows.unionByName(more.rows))
    members.drop()

    component = _with_component(nodes.select("high", "low", "node", "least"), final.rows, "component")
    component = store(component, "components").rows
    leasts = component.groupBy("component").agg(F.min("least").alias("first"))
    named = store(component.join(leasts, "component").select("high", "low", "first"), "named").rows
    joined = docs_of.join(named, ["high", "low"], "left")
    alone = F.col("first").isNull()
    return joined.select(
        "row",
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"),
    )
