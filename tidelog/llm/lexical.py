"""Ranked lexical search with MaxScore over term-pair bounds.

The queries are known, so what is kept of a document are its number of terms and the frequencies of those
terms that some query has. Each task takes such rows in shards and makes of each an inverted index: for each term the
documents with the score it adds there, and the greatest such score. For pairs of terms that queries have together it
intersects the two lists and stores the greatest joint score and the k-th greatest.

A query's terms are read from the greatest maximum to the least. The terms not read yet can add no more than the sum of
their maxima, and less where two of them form a stored pair: then the pair's joint maximum (or the greater single
one) stands for both. Once that bound is below the k-th best score known, no further document can
come in: only those seen so far are looked up in the remaining lists, and they leave as soon as their
score and the bound stay below. A k-th joint score of a pair is a first threshold before anything is read.
The best of a task's earlier shards are a threshold for its later ones. All bounds hold for every document and
equal scores are kept, so the result is that of scoring all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.storage import store
from tidelog.llm.words import pieces, words_of

BEST = 20
#: bytes of query texts that are sent to the tasks at once
BLOCK_BYTES = 4 << 20
SHARD_DOCS = 1 << 16
SHARD_POSTINGS = 1 << 22

_BREAKS = np.ones(256, dtype=bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _BREAKS[_low : _high + 1] = False


class Queries(NamedTuple):
    """The queries of a block: terms are numbers in `marks`, sorted fingerprints."""

    numbers: list[int]
    terms: list[dict[int, int]]  # of each query: term -> how often
    marks: np.ndarray


def queries_of(numbers: list[int], texts: list[str | None]) -> Queries:
    words = words_of(pa.array(texts, type=pa.string()), lower=True, breaks=_BREAKS)
    marks, term = np.unique(words.mark, return_inverse=True)
    found = []
    for n in range(len(texts)):
        each, often = np.unique(term[words.first[n] : words.first[n + 1]], return_counts=True)
        found.append(dict(zip(each.tolist(), often.tolist(), strict=True)))
    return Queries(numbers, found, marks)


_FORWARD = "doc_id bigint, n bigint, terms array<int>, often array<int>"


def _forward(sent):
    """(doc_id, text) -> number of terms, and the queries' terms in it with their frequencies."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = sent.value
        for batch in batches:
            for low, high in pieces(batch.column(1)):
                part = batch.slice(low, high - low)
                words = words_of(part.column(1), lower=True, breaks=_BREAKS)
                at = np.minimum(np.searchsorted(marks, words.mark), max(0, len(marks) - 1))
                hit = marks[at] == words.mark if len(marks) else np.zeros(len(words.mark), dtype=bool)
                key, often = np.unique(words.text[hit] * max(1, len(marks)) + at[hit], return_counts=True)
                owner, term = np.divmod(key, max(1, len(marks)))
                offsets = pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(often.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "often"],
                )

    return run


class Statistics(NamedTuple):
    documents: int  # with a term
    terms: int  # all, with repeats
    weight: np.ndarray  # of each term of the queries
    frequency: np.ndarray  # documents that have it


def weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * f + 1))) for f in frequency.tolist()], dtype=np.int64)


def pairs_of(queries: Queries, frequency: np.ndarray) -> list[tuple[int, int]]:
    """The pairs to intersect: terms that follow each other in a query sorted by document frequency.

    Those are read one after the other, and those read last have the longest lists.
    """
    return sorted({pair for terms in queries.terms for pair in neighbours(terms, frequency)})


def neighbours(terms: dict[int, int], frequency: np.ndarray) -> list[tuple[int, int]]:
    order = sorted(terms, key=lambda t: (-frequency[t], t))
    return list(zip(order, order[1:], strict=False))


class Shard:
    """An inverted index of some documents, in ascending order of id."""

    def __init__(self, ids, n, lengths, terms, often, stats: Statistics, pairs, best: int):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.best, self.frequency = ids[order], best, stats.frequency
        doc = np.repeat(place, lengths)
        top = 25 * int(n.max(initial=0)) * stats.documents
        share = (25 * n * stats.documents) // max(1, stats.terms) if top < 2**63 else np.array(
            [25 * int(x) * stats.documents // stats.terms for x in n], dtype=np.int64
        )
        long = np.repeat(75 + share, lengths)
        score = stats.weight[terms] * ((1_000_000_000 * often) // (1000 * often + 12 * long))
        useful = score > 0
        doc, term, score = doc[useful], terms[useful], score[useful]
        order = np.lexsort((doc, term))
        self.doc, self.score = doc[order], score[order]
        self.first = np.searchsorted(term[order], np.arange(len(stats.weight) + 1))
        self.most = np.zeros(len(stats.weight), dtype=np.int64)
        np.maximum.at(self.most, term, score)
        self.joint = self._intersections(pairs)

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.first[term], self.first[term + 1])
        return self.doc[at], self.score[at]

    def _intersections(self, pairs) -> dict[tuple[int, int], tuple[int, int]]:
        """For each pair (greatest joint score, the k-th greatest or 0) over the documents with both."""
        found, dense, held = {}, np.zeros(len(self.ids), dtype=np.int64), None
        for a, b in pairs:
            if a != held:
                if held is not None:
                    dense[self.list_of(held)[0]] = 0
                docs, scores = self.list_of(a)
                dense[docs] = scores
                held = a
            docs, scores = self.list_of(b)
            other = dense[docs]
            both = (other + scores)[other > 0]
            kth = int(np.partition(both, -self.best)[-self.best]) if len(both) >= self.best else 0
            found[a, b] = found[b, a] = int(both.max(initial=0)), kth
        return found


class Found(NamedTuple):
    ids: np.ndarray
    scores: np.ndarray
    postings: int  # read or looked up


def _bounds(shard: Shard, order: list[int], terms: dict[int, int], with_pairs: bool) -> list[int]:
    """For each place in the order the most that the terms from there on can add to a document."""
    out, total, single = [0], 0, {}
    for t in reversed(order):
        most = terms[t] * int(shard.most[t])
        saved, partner = 0, None
        for u in single if with_pairs else ():
            joint = shard.joint.get((t, u))
            if joint is None:
                continue
            q = min(terms[t], terms[u])
            both = q * joint[0] + (terms[t] - q) * int(shard.most[t]) + (terms[u] - q) * int(shard.most[u])
            saving = most + single[u] - max(both, most, single[u])
            if saving > saved:
                saved, partner = saving, u
        if partner is None:
            single[t] = most
        else:
            del single[partner]
        total += most - saved
        out.append(total)
    return out[::-1]


def search(shard: Shard, terms: dict[int, int], known: int = 0, with_pairs: bool = True) -> Found:
    """The documents of the shard that can be among the best, given that `best` documents elsewhere have `known`."""
    k = shard.best
    order = sorted((t for t in terms if shard.most[t] > 0), key=lambda t: (-terms[t] * int(shard.most[t]), t))
    rest = _bounds(shard, order, terms, with_pairs)
    least = known
    if with_pairs:
        for pair in neighbours(terms, shard.frequency):
            least = max(least, min(terms[t] for t in pair) * shard.joint[pair][1])
    total = np.zeros(len(shard.ids), dtype=np.int64)
    candidates = scores = None
    postings = 0
    for at, t in enumerate(order):
        docs, added = shard.list_of(t)
        if candidates is None and rest[at] < least:
            candidates = np.flatnonzero(total > 0)
            scores = total[candidates]
        if candidates is None:
            total[docs] += terms[t] * added
            postings += len(docs)
            if at & (at + 1) == 0 and len(total) >= k:  # after 1, 2, 4, 8 ... terms
                least = max(least, int(np.partition(total, -k)[-k]))
            continue
        good = scores + rest[at] >= least
        candidates, scores = candidates[good], scores[good]
        place = np.minimum(np.searchsorted(docs, candidates), len(docs) - 1)
        scores = scores + np.where(docs[place] == candidates, terms[t] * added[place], 0)
        postings += len(candidates)
        if len(scores) >= k:
            least = max(least, int(np.partition(scores, -k)[-k]))
    if candidates is None:
        candidates = np.flatnonzero(total > 0)
        scores = total[candidates]
    good = scores >= max(1, least)
    return Found(shard.ids[candidates[good]], scores[good], postings)


_HITS = "item bigint, doc_id bigint, score bigint"
#: a missing id comes after all others
_NO_ID = 2**63 - 1


def _search(sent, best: int):
    def shards(batches) -> Iterator[list[pa.RecordBatch]]:
        held, docs, postings = [], 0, 0
        for batch in batches:
            held.append(batch)
            docs += batch.num_rows
            postings += len(batch.column("terms").flatten())
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield held
                held, docs, postings = [], 0, 0
        if docs:
            yield held

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, stats, pairs = sent.value
        hits = {n: (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for n in range(len(queries.numbers))}
        for held in shards(batches):
            table = pa.Table.from_batches(held).combine_chunks()
            terms, often = (table[c].combine_chunks() for c in ("terms", "often"))
            shard = Shard(
                np.asarray(table["doc_id"].fill_null(_NO_ID)),
                np.asarray(table["n"]),
                np.diff(np.asarray(terms.offsets)),
                np.asarray(terms.flatten()),
                np.asarray(often.flatten()).astype(np.int64),
                stats,
                pairs,
                best,
            )
            for n, (ids, scores) in hits.items():
                found = search(shard, queries.terms[n], int(scores[-1]) if len(scores) == best else 0)
                ids, scores = np.concatenate([ids, found.ids]), np.concatenate([scores, found.scores])
                order = np.lexsort((ids, -scores))[:best]
                hits[n] = ids[order], scores[order]
        sizes = [len(ids) for ids, _ in hits.values()]
        ids, scores = (np.concatenate([h[c] for h in hits.values()] or [np.zeros(0, dtype=np.int64)]) for c in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(queries.numbers, dtype=np.int64), sizes)),
                pa.array(ids, mask=ids == _NO_ID),
                pa.array(scores),
            ],
            names=["item", "doc_id", "score"],
        )

    return run


def _statistics(forward: DataFrame, size: int) -> Statistics:
    row = forward.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = forward.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    frequency = np.zeros(size, dtype=np.int64)
    frequency[np.asarray(counts["term"])] = np.asarray(counts["count"])
    return Statistics(row[0], row[1], weights(row[0], frequency), frequency)


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the `best` documents of each item, the highest score first.

    `docs` needs doc_id and text, `items` item_id and text; other columns are left aside. Terms are runs
    of ASCII letters, digits and characters beyond ASCII, A-Z as a-z; a null text has none. A term of weight
    w adds w * ((10^9 * tf) div (1000 * tf + 12 * m)) to the score of a document for each time the item has
    it; w is floor(1000 * ln((2N + 2) / (2df + 1))) and m is 75 + (25 * n * N) div L, where N documents
    have terms, L in all, n of them in this document, df have this term, tf times in this one.

    Equal scores are ranked by ascending doc_id, rows without one last. Only scores above 0 are
    returned, so an item without terms, or without documents, gives no rows. Repeated rows are documents, or items,
    of their own.

    Items are taken in blocks of about `block_bytes` of text (one item, if longer); a block is what the driver and
    each task hold. Documents are read once a block; their rows of query terms are stored in the shared folder.
    """
    spark = docs.sparkSession
    wanted = store(items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.coalesce("text", F.lit("")).alias("text")), "items").rows
    size = wanted.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-int(size) // block_bytes)
    block = F.pmod(F.xxhash64("item"), F.lit(max(1, blocks)))
    hits = [spark.createDataFrame([], _HITS)]
    for number in range(blocks):
        held = wanted.filter(block == number).select("item", "text").toArrow()
        queries = queries_of(held["item"].to_pylist(), held["text"].to_pylist())
        if not len(queries.marks):
            continue
        marks = spark.sparkContext.broadcast(queries.marks)
        forward = store(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_forward(marks), _FORWARD), "forward").rows
        stats = _statistics(forward, len(queries.marks))
        sent = spark.sparkContext.broadcast((queries, stats, pairs_of(queries, stats.frequency)))
        hits.append(store(forward.mapInArrow(_search(sent, best), _HITS), "hits").rows)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, hits).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(wanted.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
