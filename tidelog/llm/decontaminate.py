"""Documents that hold benchmark items, found by fingerprints of item-sized windows.

All of it is DataFrame functions. Words are lower-cased; a text's shingles are its runs of five words,
hashed to 64 bits (with fewer words, the whole text as one).

1. A window has as many words as an item and lies inside the document (a shorter document is a window as
   a whole). Windows are laid at all starts, in any order of an item's parts, where the window holds so many
   shingles of items of its size that the similarity can be reached; no other window is like an item.
2. The window and the items get a 64-bit SimHash, each bit the majority of that bit over the shingles.
   Two texts of similarity 0.75 differ in about 11 bits, and hardly ever in more than `RADIUS`.
3. The fingerprint is cut into blocks of bits. Fingerprints that differ in at most 2 x blocks - 1 bits
   agree in a block up to one bit, so a join of the windows' blocks with the items' blocks, where an item
   also has each block with one bit flipped, finds all pairs within the radius.
4. Pairs are verified: the weighted Jaccard similarity of the shingles, each weighted by how often it
   occurs (sum of the smaller counts over sum of the larger), must be at least 0.75.

Only the items' tables are broadcast, after their rows have been counted; beyond `MOST_BROADCAST` rows
the same joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.storage import store

SHINGLE = 5
SIMILARITY = 0.75
BLOCKS = 12
RADIUS = 2 * BLOCKS - 1
MOST_BROADCAST = 1_000_000

_EDGES = [round(64 * n / BLOCKS) for n in range(BLOCKS + 1)]


def words(text: Column) -> Column:
    """Lower-cased words; none for a null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _shingles(word: Column) -> Column:
    runs = F.transform(
        F.sequence(F.lit(0), F.size(word) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(word, i + j) for j in range(SHINGLE)]),
    )
    few = F.array(F.xxhash64(F.array_join(word, " "), F.lit(0)))
    return (
        F.when(F.size(word) >= SHINGLE, runs)
        .when(F.size(word) > 0, few)
        .otherwise(F.array().cast("array<bigint>"))
    )


def shingled(text: Column) -> Column:
    """(n, marks): the number of words, and hashes of the runs of five words, in order.

    With fewer words the hash of the whole, without words none. The words are bound to a lambda's
    variable, since an expression that is named several times would be worked out several times.
    """
    bound = F.transform(
        F.array(words(text)), lambda w: F.struct(F.size(w).alias("n"), _shingles(w).alias("marks"))
    )
    return F.get(bound, F.lit(0))


def simhash(marks: Column) -> Column:
    """64 bits: bit b is set if it is set in more than half of the marks."""
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda b: F.aggregate(
            marks, F.lit(0).cast("bigint"), lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(F.lit(1))
        ),
    )
    half = F.size(marks)
    set_bits = F.transform(
        bits, lambda n, b: F.when(n * 2 > half, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(0)
    )
    return F.aggregate(set_bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def _block(fingerprint: str, n: int) -> Column:
    low, high = _EDGES[n], _EDGES[n + 1]
    return F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def window_blocks(fingerprint: str) -> Column:
    """(number, value) of each block."""
    return F.array(
        *[F.struct(F.lit(n).alias("block"), _block(fingerprint, n).alias("value")) for n in range(BLOCKS)]
    )


def item_blocks(fingerprint: str) -> Column:
    """(number, value) of each block, as it is and with one bit flipped."""
    out = []
    for n in range(BLOCKS):
        value = _block(fingerprint, n)
        for flip in [0, *[1 << b for b in range(_EDGES[n + 1] - _EDGES[n])]]:
            out.append(F.struct(F.lit(n).alias("block"), value.bitwiseXOR(F.lit(flip)).alias("value")))
    return F.array(*out)


def similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles."""
    left, right = F.col(a), F.col(b)

    def times(marks: Column, x: Column) -> Column:
        return F.size(F.filter(marks, lambda y: y == x))

    plain = (F.size(F.array_distinct(left)) == F.size(left)) & (F.size(F.array_distinct(right)) == F.size(right))
    counted = F.aggregate(
        F.array_distinct(left), F.lit(0), lambda n, x: n + F.least(times(left, x), times(right, x))
    )
    both = F.when(plain, F.size(F.array_intersect(left, right))).otherwise(counted)
    return both / (F.size(left) + F.size(right) - both)


def _bounded(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= MOST_BROADCAST else df


def _runs(hits: str, n: str, size: str, least: float) -> Column:
    """(low, high) of the runs of starts whose windows may be like an item, in order and apart.

    `hits` are the sorted places of the document's shingles that some item of this size has. A window of
    w shingles needs c of them, and holds hits[i] to hits[i + c - 1] if it starts from
    hits[i + c - 1] - w + 1 to hits[i]; both ends grow with i.
    """

    def shingles(words: str) -> Column:
        return F.greatest(F.col(words) - (SHINGLE - 1), F.lit(1))

    width = F.least(shingles(n), shingles(size))
    # shared / (width + shingles of the item - shared) >= least
    fewest = F.ceil((width + shingles(size)) * (least / (1 + least)) - 1e-6).cast("int")
    last = F.greatest(F.lit(0), F.col(n) - F.col(size))

    def run(hit: Column, i: Column, w: Column, c: Column) -> Column:
        low = F.greatest(F.lit(0), F.get(hit, i + c - 1) - w + 1, F.get(hit, i - 1) + 1)
        return F.struct(low.alias("low"), F.least(F.get(hit, i), last).alias("high"))

    bound = F.transform(
        F.array(F.struct(F.col(hits).alias("hit"), width.alias("w"), F.greatest(fewest, F.lit(1)).alias("c"))),
        lambda x: F.when(
            F.size(x["hit"]) >= x["c"],
            F.filter(
                F.transform(
                    F.sequence(F.lit(0), F.size(x["hit"]) - x["c"]), lambda i: run(x["hit"], i, x["w"], x["c"])
                ),
                lambda r: r["low"] <= r["high"],
            ),
        ),
    )
    return F.get(bound, F.lit(0))


def item_table(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, size, marks, bits) of the items that have a word."""
    cut = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"), shingled(F.col(text_col)).alias("cut"))
    marks = cut.select("item_id", F.col("cut.n").alias("size"), F.col("cut.marks").alias("marks"))
    return marks.filter("size > 0").withColumn("bits", simhash(F.col("marks")))


def contaminated_windows(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """(doc_id, hash, at, placed, item_id, similarity): windows like an item; `hash` is that of the document's text.

    `placed` tells that a shingle has the same place in the window as in an item of that size.
    """
    items = store(item_table(benchmark), "items").rows
    number = items.agg(F.sum(F.size("marks"))).first()[0] or 0
    placed = items.select("size", F.posexplode("marks").alias("place", "mark")).distinct()
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("_text")
    )
    cut = texts.select("doc_id", "hash", shingled(F.col("_text")).alias("cut"))
    spread = cut.select("doc_id", "hash", F.col("cut.n").alias("n"), F.posexplode("cut.marks").alias("p", "mark"))
    last = F.greatest(F.lit(0), F.col("n") - F.col("size"))
    at = F.greatest(F.lit(0), F.least(F.col("p") - F.col("place"), last))
    met = spread.join(_bounded(placed, number), "mark").groupBy("doc_id", "hash", "n", "size")
    met = met.agg(F.array_sort(F.collect_set("p")).alias("hits"), F.collect_set(at).alias("placed"))
    runs = met.withColumn("runs", _runs("hits", "n", "size", least)).filter(F.size("runs") > 0)
    starts = store(runs.select("doc_id", "hash", "size", "runs", "placed"), "starts").rows
    keys = starts.select(F.col("doc_id").alias("d"), F.col("hash").alias("h"), "size", "runs", "placed")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h"))
    held = texts.join(keys, same).withColumn("cut", shingled(F.col("_text")))
    laid = held.select(
        "doc_id", "hash", "size", "placed", F.col("cut.marks").alias("marks"), F.inline("runs").alias("low", "high")
    ).withColumn("at", F.explode(F.sequence("low", "high")))
    windows = laid.select(
        "doc_id",
        "hash",
        "size",
        "at",
        F.array_contains("placed", F.col("at")).alias("placed"),
        F.slice("marks", F.col("at") + 1, F.greatest(F.col("size") - (SHINGLE - 1), F.lit(1))).alias("window"),
    ).distinct()
    printed = store(windows.withColumn("bits", simhash(F.col("window"))), "windows").rows
    probes = printed.select("*", F.inline(window_blocks("bits")))
    index = items.select(
        F.col("item_id"),
        "size",
        F.col("marks").alias("item"),
        F.col("bits").alias("item_bits"),
        F.inline(item_blocks("bits")),
    )
    near = probes.join(_bounded(index, number * 8), ["size", "block", "value"]).filter(
        F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits"))) <= RADIUS
    )
    # a pair that meets in several blocks is taken in the first of them
    agree = [
        F.when(F.bit_count(_block("bits", n).bitwiseXOR(_block("item_bits", n))) <= 1, F.lit(n)) for n in range(BLOCKS)
    ]
    pairs = near.filter(F.col("block") == F.coalesce(*agree))
    verified = pairs.withColumn("similarity", similarity("window", "item")).filter(F.col("similarity") >= least)
    return verified.select("doc_id", "hash", "at", "placed", "item_id", "similarity")


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """(doc_id, hash, contaminated, item_id, similarity, at), one row for each row of `docs`.

    The most similar item counts, of equals the one with the smallest id, at its first place; of equal
    windows those come first in which a shingle has its place in the item. A null text is empty; empty texts and items are like nothing. Items of fewer than five words are only
    found in documents of fewer than five words. Equal rows get equal results; null ids are ids like
    any other. Other columns are not read.
    """
    found = contaminated_windows(docs, benchmark, id_col, text_col, least)
    best = F.max(F.struct("similarity", (-F.col("item_id")).alias("item"), "placed", (-F.col("at")).alias("at")))
    worst = found.groupBy(F.col("doc_id").alias("d"), F.col("hash").alias("h")).agg(best.alias("best"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("hash"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h"))
    return rows.join(worst, same, "left").select(
        "doc_id",
        "hash",
        F.col("best").isNotNull().alias("contaminated"),
        (-F.col("best.item")).alias("item_id"),
        F.col("best.similarity").alias("similarity"),
        (-F.col("best.at")).alias("at"),
    )


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """The rows of `docs` that hold nothing like an item, with all their columns.

    Rows with a null or empty text stay, and so does everything where there are no items; equal rows stay or go
    together. Columns of `docs` may have any names.
    """
    found = contaminated_windows(docs, benchmark, id_col, text_col, least)
    found = found.select(F.col("doc_id").alias("_d"), F.col("hash").alias("_h")).distinct()
    same = docs[id_col].cast("bigint").eqNullSafe(found["_d"]) & (F.xxhash64(docs[text_col]) == found["_h"])
    return docs.join(found, same, "left_anti")
