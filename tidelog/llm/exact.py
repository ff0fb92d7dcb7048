"""Groups of documents with equal texts, by naming blocks.

A text is cut into blocks of a fixed size. Blocks are dealt to partitions, equal ones to the same, and
sorted there; each distinct one gets an integer name, its partition's number and its rank in it. Then each
pair of adjacent names gets a name of its own likewise, and so on, until a text has one name.
A hash only chooses the partition and names are ranks, so two texts of the same number of rounds share a
name only if they are equal. The work of a round is half that of the round before. Names need no order
between partitions, so no block is sampled for the driver.

A block that very many documents hold is first named inside each batch of rows, so the sort gets it
once for each batch; the joins that bring the names back have files on both sides, which lets
adaptive execution split a common key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.storage import Stored, store

BLOCK_BYTES = 2048

_CUT = (
    "row bigint, doc_id bigint, text_sha256 string, n_blocks int, "
    "local bigint, block binary, at array<struct<row bigint, place int>>"
)
_AT = pa.list_(pa.struct([("row", pa.int64()), ("place", pa.int32())]))
_ARROW = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("text_sha256", pa.string()),
        ("n_blocks", pa.int32()),
        ("local", pa.int64()),
        ("block", pa.binary()),
        ("at", _AT),
    ]
)
_BATCH_BYTES = 8 << 20


def cut_blocks(size: int):
    """A task's part: one row for each document, and one for each distinct block of some MB of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        rows = names = 0
        docs: list[dict] = []
        blocks: dict[bytes, list[dict]] = {}
        held = 0

        def out() -> pa.RecordBatch:
            nonlocal names
            found = docs + [
                {"local": base + names + n, "block": block, "at": at} for n, (block, at) in enumerate(blocks.items())
            ]
            names += len(blocks)
            return pa.RecordBatch.from_pylist(found, schema=_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                value = (text.as_py() or "").encode()
                row, rows = base + rows, rows + 1
                count = max(1, -(-len(value) // size))
                for place in range(count):
                    block = value[place * size : (place + 1) * size]
                    blocks.setdefault(block, []).append({"row": row, "place": place})
                docs.append(
                    {
                        "row": row,
                        "doc_id": doc_id.as_py(),
                        "text_sha256": hashlib.sha256(value).hexdigest(),
                        "n_blocks": count,
                    }
                )
                held += len(value) + 100
                if held > _BATCH_BYTES:
                    yield out()
                    docs, blocks, held = [], {}, 0
        if docs:
            yield out()

    return run


def rank_sorted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(local, block) sorted by block -> (local, name): equal blocks follow each other in one task."""
    name, last = TaskContext.get().partitionId() << 33, None
    for batch in batches:
        names = []
        for block in batch.column(1).to_pylist():
            if block != last:
                name, last = name + 1, block
            names.append(name)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, type=pa.int64())], names=["local", "name"]
        )


def _named_pairs(names: DataFrame) -> Stored:
    """One round: (row, names) with several names each -> (row, names) with half as many.

    The pairs are aggregated, sorted and numbered; 0 stands for no partner.
    """
    last = F.size("names") - 1
    pairs = names.select(
        "row",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), last, F.lit(2)),
                lambda i: F.struct(
                    F.element_at("names", i + 1).alias("left"),
                    F.when(i < last, F.element_at("names", i + 2)).otherwise(F.lit(0)).alias("right"),
                ),
            )
        ).alias("place", "pair"),
    )
    flat = store(pairs.select("row", "place", "pair.left", "pair.right"), "pairs")
    ranked = flat.rows.select("left", "right").distinct().sortWithinPartitions("left", "right")
    ranks = store(ranked.select("*", (F.monotonically_increasing_id() + 1).alias("name")), "names")
    joined = flat.rows.join(ranks.rows, ["left", "right"]).select("row", "place", "name")
    out = store(_in_order(joined), "named")
    flat.drop()
    ranks.drop()
    return out


def _in_order(named: DataFrame) -> DataFrame:
    """(row, place, name) -> (row, names): a text's names, as many as it has blocks."""
    ordered = F.sort_array(F.collect_list(F.struct("place", "name")))
    return named.groupBy("row").agg(F.transform(ordered, lambda x: x["name"]).alias("names"))


def name_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(row, doc_id, text_sha256, n_blocks, rounds, name): equal (rounds, name) means equal texts.

    `row` is a number given to each row of `docs`.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    cut = store(rows.mapInArrow(cut_blocks(block_bytes), _CUT), "blocks")
    blocks = cut.rows.filter("local is not null")
    order = blocks.select("local", "block").repartition(partitions, "block")
    ranks = store(
        order.sortWithinPartitions("block").mapInArrow(rank_sorted, "local bigint, name bigint"), "block-names"
    )
    held = blocks.select("local", "at").join(ranks.rows, "local")
    places = held.select("name", F.explode("at").alias("o")).select("o.row", "o.place", "name")
    current = store(_in_order(places), "named")
    ranks.drop()
    finished: list[DataFrame] = []
    rounds = 0
    while True:
        one = F.size("names") == 1
        finished.append(
            current.rows.filter(one).select("row", F.lit(rounds).alias("rounds"), F.col("names")[0].alias("name"))
        )
        longer = current.rows.filter(~one)
        if longer.isEmpty():
            break
        current = _named_pairs(longer)
        rounds += 1
    names = finished[0]
    for more in finished[1:]:
        names = names.unionByName(more)
    documents = cut.rows.filter("row is not null").select("row", "doc_id", "text_sha256", "n_blocks")
    return documents.join(names, "row")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of `docs`.

    Of equal texts the row with the largest id stays; of several such rows one. A null text is an
    empty text; a null id is less than any other. Other columns are not read, whatever their names.
    An empty table gives an empty result.
    """
    named = store(name_texts(docs, id_col, text_col, block_bytes), "texts")
    key = ["rounds", "name"]
    groups = (
        named.rows.groupBy(*key)
        .agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("stays"))
        .filter("group_size > 1")
    )
    copies = store(groups, "groups")
    joined = named.rows.join(copies.rows, key, "left")
    alone = F.col("stays").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("stays.row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )
