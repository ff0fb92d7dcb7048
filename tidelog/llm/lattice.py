"""Probability of a text under all its segmentations into pieces of an existing vocabulary.

A text is its words, A-Z as a-z, each after a blank, and an end. Pieces do not cross words, so the lattice of a text
falls apart into those of its words, and the marginal probability of a word, the sum over all its
segmentations of the product of their pieces' probabilities, is worked out once for each distinct word by
the forward recursion in logarithms. Every byte is a piece, so each word has a segmentation.

The vocabulary is that of a public byte-level tokenizer. The score of a piece is the logarithm of how
often it occurs when the tokenizer cuts the words of the training documents, smoothed by the prior of the vocabulary,
where a piece's probability falls with its rank in the file.

Words are counted by Spark, exactly. What documents need of a word (its count and its marginal) is sent to
the tasks for the most frequent words, at most `MOST_HEAD` of them, and joined for all others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log, log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.storage import store
from tidelog.llm.tokens import Encoder, default_tokenizer
from tidelog.llm.words import mixed, pieces, words_of
from tidelog.session import bounded_batches

#: the most frequent words that are sent to every task, at most
MOST_HEAD = 300_000
#: weight of the vocabulary's prior, in pieces
PRIOR = 50_000.0
#: words that a task holds before it hands them on
_MOST_KEPT = 200_000
#: stands for the end of a text in the table of words; no word is empty
END = ""
_SPAN = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_RANDOM = np.random.Generator(np.random.PCG64(4711))
_BYTES = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + n): b for n, b in enumerate(others)}


def vocabulary(path: str) -> list[bytes]:
    """The pieces of a byte-level tokenizer file by id; empty for those that are no bytes of text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    found = tokenizer.get_vocab(with_added_tokens=True)
    letters = byte_letters()
    out = [b""] * (max(found.values()) + 1)
    for piece, number in found.items():
        if all(c in letters for c in piece):
            out[number] = bytes(letters[c] for c in piece)
    for number in tokenizer.get_added_tokens_decoder():
        out[number] = b""
    return out


def prior(size: int) -> np.ndarray:
    """Probability of a piece by its rank alone."""
    weight = 1.0 / (np.arange(size) + 100.0)
    return weight / weight.sum()


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


@dataclass
class Pieces:
    """Log probability of each piece, found by the fingerprint of its bytes."""

    keys: np.ndarray
    logs: np.ndarray
    probes: int
    longest: int

    @classmethod
    def of(cls, strings: list[bytes], logs: np.ndarray) -> Pieces:
        keys, found = np.zeros(_SPAN, dtype=np.uint64), np.full(_SPAN, -np.inf)
        most = 0
        for piece, value in zip(strings, logs, strict=True):
            if not piece:
                continue
            mark = cls.mark(np.frombuffer(piece, dtype=np.uint8).reshape(1, -1))[0]
            slot, step = int(mark >> np.uint64(46)), 0
            while keys[(slot + step) % _SPAN]:
                step += 1
            keys[(slot + step) % _SPAN], found[(slot + step) % _SPAN] = mark, value
            most = max(most, step)
        return cls(keys, found, most + 1, max(map(len, strings)))

    @staticmethod
    def mark(rows: np.ndarray) -> np.ndarray:
        """Fingerprints of byte strings of equal length, one in each row."""
        total = (_BYTES[rows] * _powers(_BASE, rows.shape[1])).sum(axis=1, dtype=np.uint64)
        return mixed(total, rows.shape[1])

    def find(self, marks: np.ndarray) -> np.ndarray:
        """Log probabilities; minus infinity for what is no piece."""
        slot = (marks >> np.uint64(46)).astype(np.int64)
        held = self.keys[slot]
        out = np.where(held == marks, self.logs[slot], -np.inf)
        # most slots are empty, which settles it; the few others go on to the next slot
        going = np.flatnonzero((held != marks) & (held != 0))
        for step in range(1, self.probes):
            if not len(going):
                break
            at = (slot[going] + step) % _SPAN
            held = self.keys[at]
            hit = held == marks[going]
            out[going[hit]] = self.logs[at[hit]]
            going = going[~hit & (held != 0)]
        return out

    def marginals(self, rows: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations, for byte strings of equal length."""
        n, size = rows.shape
        up, down = _powers(_BASE, size), _powers(_INVERSE, size)
        sums = np.zeros((size + 1, n), dtype=np.uint64)
        np.cumsum(_BYTES[rows.T] * up[:, None], axis=0, out=sums[1:])
        forward = np.full((size + 1, n), -np.inf)
        forward[0] = 0.0
        for end in range(1, size + 1):
            for start in range(max(0, end - self.longest), end):
                marks = mixed((sums[end] - sums[start]) * down[start], end - start)
                logs = self.find(marks)
                hit = np.flatnonzero(logs > -np.inf)
                if len(hit):
                    forward[end, hit] = np.logaddexp(forward[end, hit], forward[start, hit] + logs[hit])
        return forward[size]

    def words(self, words: list[bytes]) -> np.ndarray:
        """Marginals of words, each after a blank; those of the same length together."""
        out = np.zeros(len(words))
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(sizes, kind="stable")
        cuts = np.flatnonzero(np.diff(sizes[order])) + 1
        for group in np.split(order, cuts):
            if not len(group):
                continue
            size = int(sizes[group[0]]) + 1
            step = max(1, 400_000 // size)
            for low in range(0, len(group), step):
                part = group[low : low + step]
                data = b"".join([b" " + words[i] for i in part])
                out[part] = self.marginals(np.frombuffer(data, dtype=np.uint8).reshape(len(part), size))
        return out


def held_out(id_col: str, folds: int = 7, held: int = 2) -> Column:
    """Whether a document is left out of the training; one with a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == held, F.lit(False))


_COUNTED = "word string, train bigint, total bigint"


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The stretches of UTF-8 bytes as strings, A-Z as a-z."""
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], sizes)
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_LOWER[data[at]])]
    return pa.Array.from_buffers(pa.string(), len(sizes), buffers)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(held_out, text) -> words with their counts, each word once for every `_MOST_KEPT` that were found."""
    kept: list[tuple] = []

    def out() -> pa.RecordBatch:
        marks, train, total = (np.concatenate([k[n] for k in kept]) for n in range(3))
        words = pa.concat_arrays([k[3] for k in kept])
        _, first, inverse = np.unique(marks, return_index=True, return_inverse=True)
        sums = [pa.array(np.bincount(inverse, weights=x).astype(np.int64)) for x in (train, total)]
        return pa.RecordBatch.from_arrays([words.take(pa.array(first)), *sums], names=["word", "train", "total"])

    end = [0, 0]
    for batch in batches:
        held, texts = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), dtype=bool), batch.column(1)
        end[0] += int((~held).sum())
        end[1] += len(held)
        for low, high in pieces(texts):
            found = words_of(texts.slice(low, high - low), lower=True)
            if not len(found.mark):
                continue
            marks, first, inverse, count = np.unique(
                found.mark, return_index=True, return_inverse=True, return_counts=True
            )
            train = np.bincount(inverse, weights=~held[low + found.text], minlength=len(marks)).astype(np.int64)
            kept.append((marks, train, count, _strings(found.data, found.start[first], found.end[first])))
            if sum(len(k[0]) for k in kept) > _MOST_KEPT:
                yield out()
                kept = []
    if kept:
        yield out()
    yield pa.RecordBatch.from_arrays(
        [pa.array([END]), pa.array(end[:1], type=pa.int64()), pa.array(end[1:], type=pa.int64())],
        names=["word", "train", "total"],
    )


def _cut(path: str, size: int):
    """(word, train) -> (piece, n): how often the tokenizer makes each piece of the words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Encoder.of(path).tokenizer  # a worker's only one: the library keeps the memory of each that was used
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), np.asarray(batch.column(1))
            for low in range(0, len(words), 5000):
                part = [" " + w for w in words[low : low + 5000]]
                ids = [e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
                flat = np.fromiter((x for one in ids for x in one), dtype=np.int64, count=int(sizes.sum()))
                np.add.at(total, flat, np.repeat(counts[low : low + len(part)], sizes))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

    return run


_WORDS = "mark bigint, train bigint, total bigint, marginal double"


def _score_words(table: Pieces):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            found = words_of(column)
            values = table.words([w.encode() for w in column.to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.mark.view(np.int64)), batch.column(1), batch.column(2), pa.array(values)],
                names=["mark", "train", "total", "marginal"],
            )

    return run


_DOCS = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, "
    "rest array<bigint>"
)


def _score_docs(head, base_of_total: float, end_train: int, end_log: float):
    """(doc_id, held_out, text) -> sums over the words that were sent, and the marks of the other words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, train, logs = head.value
        bases = np.log10(train + 1.0) - base_of_total
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(2)
            for low, high in pieces(texts):
                found = words_of(texts.slice(low, high - low), lower=True)
                at = np.minimum(np.searchsorted(marks, found.mark), max(0, len(marks) - 1))
                there = marks[at] == found.mark if len(marks) else np.zeros(len(found.mark), dtype=bool)
                n = high - low
                at, owner = at[there], found.text[there]

                def total(values, owner=owner, n=n):
                    return np.bincount(owner, weights=values, minlength=n)[:n]

                known = total(train[at] > 0).astype(np.int64) if len(at) else np.zeros(n, dtype=np.int64)
                base = total(bases[at]) if len(at) else np.zeros(n)
                score = total(logs[at]) if len(at) else np.zeros(n)
                others = np.flatnonzero(~there)
                offsets = np.searchsorted(found.text[others], np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + n)),
                        batch.column(0).slice(low, n),
                        batch.column(1).slice(low, n),
                        pa.array((np.diff(found.first) + 1).astype(np.int64)),
                        pa.array(known + int(end_train > 0)),
                        pa.array(base + log10(end_train + 1) - base_of_total),
                        pa.array(score + end_log),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.mark[others].view(np.int64))),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rest"],
                )
                number += n

    return run


def lattice_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    folds: int = 7,
    held: int = 2,
    most_head: int = MOST_HEAD,
    prior_weight: float = PRIOR,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each row of `docs`.

    Learns from the documents whose crc32(id) modulo `folds` is not `held`. `base_score` is the unigram
    score of whole words with one added to each count, `score` the log10 probability over all
    segmentations. A null text is an empty one, which is its end alone; a null id is no held-out id.
    Repeated rows count repeatedly. Without training documents the prior alone scores. Other columns
    are not read.
    """
    tokenizer = tokenizer or default_tokenizer()
    spark = bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), held_out(id_col, folds, held).alias("held_out"), F.col(text_col).alias("text")
    )
    counted = rows.select("held_out", "text").mapInArrow(_count, _COUNTED)
    words = store(
        counted.groupBy("word").agg(F.sum("train").alias("train"), F.sum("total").alias("total")), "words"
    ).rows
    end = words.filter(F.col("word") == END).agg(F.sum("train").alias("train")).first()
    end_train = int(end["train"] or 0)
    sums = words.agg(F.sum("train").alias("n"), F.count_if(F.col("train") > 0).alias("v")).first()
    n, v = int(sums["n"] or 0), int(sums["v"] or 0)

    strings = vocabulary(tokenizer)
    seen = (
        words.filter((F.col("train") > 0) & (F.col("word") != END))
        .select("word", "train")
        .mapInArrow(_cut(tokenizer, len(strings)), "piece bigint, n bigint")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .collect()  # as many rows as the vocabulary has pieces, at most
    )
    counts = np.zeros(len(strings))
    for row in seen:
        counts[row["piece"]] = row["n"]
    possible = np.array([len(s) > 0 for s in strings])
    before = np.where(possible, prior(len(strings)), 0.0)
    before /= before.sum()
    all_pieces = counts[possible].sum() + end_train + 1 + prior_weight
    with np.errstate(divide="ignore"):
        logs = np.where(possible, np.log((counts + prior_weight * before) / all_pieces), -np.inf)
    table = Pieces.of(strings, logs)
    end_log = log((end_train + 1) / all_pieces) / log(10)

    scored = store(
        words.filter(F.col("word") != END).mapInArrow(_score_words(table), _WORDS), "scored-words"
    ).rows
    sizes = scored.groupBy("total").agg(F.count("*").alias("n")).orderBy(F.desc("total")).limit(most_head).collect()
    taken, least = 0, None
    for row in sizes:
        if taken + row["n"] > most_head:
            break
        taken, least = taken + row["n"], row["total"]
    frequent = scored.filter(F.col("total") >= least) if least is not None else scored.limit(0)
    found = frequent.select("mark", "train", "marginal").toArrow()  # most_head rows at most
    marks = found["mark"].to_numpy().view(np.uint64)
    order = np.argsort(marks)
    head = spark.sparkContext.broadcast(
        (
            marks[order],
            found["train"].to_numpy()[order],
            found["marginal"].to_numpy()[order] / log(10),
        )
    )
    base_of_total = log10(n + v + 1)
    partly = store(rows.mapInArrow(_score_docs(head, base_of_total, end_train, end_log), _DOCS), "partly").rows
    rest = partly.select("row", F.explode("rest").alias("mark"))
    others = scored.filter(F.col("total") < least) if least is not None else scored
    added = (
        rest.join(others.select("mark", "train", "marginal"), "mark")
        .groupBy("row")
        .agg(
            F.count_if(F.col("train") > 0).alias("more_known"),
            F.sum(F.log10(F.col("train") + 1) - base_of_total).alias("more_base"),
            F.sum(F.col("marginal") / log(10)).alias("more_score"),
        )
    )
    return partly.drop("rest").join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
