"""Passages that occur again: found by anchors, confirmed window by window, located by automata.

A window is `n` words in a row. Each window has an anchor, the run of n / 3 words in it with the least
fingerprint, so equal windows have equal anchors and only one run of words in ten or so is an anchor.

1. Anchors that occur at one place only are dropped: their windows occur once. What the other anchors
   cover of a document are its passages, of which equal ones become one with a count.
2. The windows of the passages are counted by 128-bit fingerprints; those that occur twice or more recur.
   The others are the few that are sent back to their passage.
3. A passage's stretch of recurring windows is covered by windows at its start, every n words, and at
   its end. Those are the patterns. A task takes passages up to a number of characters, compiles the
   patterns recurring in them into one Aho-Corasick automaton and streams the passages through it: the
   automata are shards of the pattern set, each sized by a parameter, and a passage meets the shard that has its
   patterns. Every match is a recurring window, and what they cover is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.storage import store
from tidelog.llm.words import FACTORS, Words, mixed, pieces, words_of

WINDOW = 35
SHARD_CHARS = 4_000_000
_TOP = np.uint64(2**64 - 1)


def _sliding(values: np.ndarray, n: int, choose) -> np.ndarray:
    """choose(values[i : i + n]) for each i, in about log2(n) passes."""
    reach, out = 1, values
    while reach * 2 <= n:
        out = choose(out[: len(out) - reach], out[reach:])
        reach *= 2
    if reach < n:
        count, shift = len(values) - n + 1, n - reach
        out = choose(out[:count], out[shift : shift + count])
    return out


def anchors(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor of each window, whether it is in one text, for each word: does an anchor begin there)."""
    k = max(1, n // 3)
    count = len(words.mark) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool), np.zeros(0, dtype=bool)
    marks, _ = words.runs(k, FACTORS[100:])
    marks = np.minimum(marks, _TOP - np.uint64(1)) + np.uint64(1)  # 0 is no mark
    least = _sliding(marks, n - k + 1, np.minimum)[:count]
    inside = words.text[:count] == words.text[n - 1 :]
    # a run is the anchor of a window if the greatest of the minima it takes part in is its own mark
    shown = np.where(inside, least, np.uint64(0))
    pad = np.zeros(n - k, dtype=np.uint64)
    greatest = _sliding(np.concatenate([pad, shown, pad]), n - k + 1, np.maximum)
    begins = greatest[: len(marks)] == marks
    return least, inside, begins


_SCANNED = "row bigint, doc_id bigint, text string, n_words bigint, whole_sha256 string, anchors array<bigint>"


def _scan(n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(1)
            for low, high in pieces(texts):
                part = texts.slice(low, high - low)
                words = words_of(part)
                _, _, begins = anchors(words, n)
                k = max(1, n // 3)
                at = np.flatnonzero(begins)
                marks = words.runs(k, FACTORS[100:])[0][at] if len(at) else np.zeros(0, dtype=np.uint64)
                owner = words.text[at]
                # each once for a text, or twice if it begins at several places of it
                order = np.lexsort((marks, owner))
                marks, owner = marks[order], owner[order]
                if len(marks):
                    same = np.zeros(len(marks), dtype=bool)
                    same[1:] = (marks[1:] == marks[:-1]) & (owner[1:] == owner[:-1])
                    third = np.zeros(len(marks), dtype=bool)
                    third[2:] = same[2:] & same[1:-1]
                    marks, owner = marks[~third], owner[~third]
                offsets = np.searchsorted(owner, np.arange(high - low + 1)).astype(np.int32)
                hashes = [
                    hashlib.sha256(b" ".join(words.strings(words.first[j], words.first[j + 1]))).hexdigest()
                    for j in range(high - low)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + high - low)),
                        batch.column(0).slice(low, high - low),
                        part,
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.array(hashes),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(marks.view(np.int64))),
                    ],
                    names=["row", "doc_id", "text", "n_words", "whole_sha256", "anchors"],
                )
                number += high - low

    return run


def _stretches(chosen: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each stretch of consecutive numbers in a sorted array."""
    if not len(chosen):
        return []
    breaks = np.flatnonzero(np.diff(chosen) > 1)
    return list(zip(chosen[np.append(0, breaks + 1)].tolist(), chosen[np.append(breaks, len(chosen) - 1)].tolist(), strict=True))


def _print128(words: Words) -> tuple[int, int]:
    """A fingerprint of all words in order."""
    place = mixed(np.arange(len(words.mark), dtype=np.uint64), 9)
    both = mixed(words.mark + place, 10)
    high = int(both.sum(dtype=np.uint64))
    low = int(mixed(both, 11).sum(dtype=np.uint64))
    return int(np.uint64(high).astype(np.int64)), int(np.uint64(low).astype(np.int64))


_PASSAGES = "row bigint, start bigint, high bigint, low bigint, passage string"


def _passages(n: int):
    k = max(1, n // 3)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, wanted = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
            # the text goes along, for the documents that words are removed from
            out: list[tuple] = [(row, -1, 0, 0, texts[j].as_py()) for j, row in enumerate(rows)]
            for j, row in enumerate(rows):
                words = words_of(texts.slice(j, 1))
                least, _, _ = anchors(words, n)
                known = np.asarray(wanted[j].values).view(np.uint64)
                known = np.minimum(known, _TOP - np.uint64(1)) + np.uint64(1)
                for first, last in _stretches(np.flatnonzero(np.isin(least, known))):
                    passage = b" ".join(words.strings(first, last + n)).decode()
                    cut = Words(*[None] * 5, words.mark[first : last + n])
                    out.append((row, first, *_print128(cut), passage))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
                names=["row", "start", "high", "low", "passage"],
            )

    return run


def _windows(n: int):
    """(passage number, copies, text) -> a row for each window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            numbers = np.asarray(batch.column(0))
            copies = np.asarray(batch.column(1))
            for low, high in pieces(texts):
                words = words_of(texts.slice(low, high - low))
                first, inside = words.runs(n)
                second, _ = words.runs(n, FACTORS[150:])
                at = np.flatnonzero(inside)
                owner = words.text[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first[at].view(np.int64)),
                        pa.array(second[at].view(np.int64)),
                        pa.array(numbers[low + owner]),
                        pa.array((at - words.first[owner]).astype(np.int32)),
                        pa.array(copies[low + owner]),
                    ],
                    names=["x", "y", "number", "at", "copies"],
                )

    return run


def pattern_starts(starts: np.ndarray, n: int) -> list[int]:
    """Windows that cover the same words as all windows at the given starts."""
    out: list[int] = []
    for first, last in _stretches(starts):
        out += [*range(first, last, n), last]
    return out


def compiled(patterns: Iterable[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for pattern in patterns:
        automaton.add_word(pattern, len(pattern))
    automaton.make_automaton()
    return automaton


def located(automaton: ahocorasick.Automaton, passage: str, n: int) -> list[tuple[int, int]]:
    """(first word, word after the last) of what the patterns cover of a passage, in order.

    Passage and patterns are words with one blank around each, so a match is one of whole words.
    """
    text = f" {passage} "
    blanks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32) == 32)
    ends = [end for end, _ in automaton.iter(text)]
    after = np.searchsorted(blanks, np.array(ends, dtype=np.int64))
    out: list[tuple[int, int]] = []
    for stop in after.tolist():
        start = stop - n
        if out and start <= out[-1][1]:
            out[-1] = (min(out[-1][0], start), stop)
        else:
            out.append((start, stop))
    return out


def _locate(n: int, shard_chars: int):
    """(passage number, text, starts of windows that do not recur or null for none) -> (number, covered words)."""
    kinds = pa.schema([("number", pa.int64()), ("covered", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns: set[str] = set()
        held: list[tuple[int, str]] = []
        chars = 0

        def shard() -> pa.RecordBatch:
            automaton = compiled(patterns)
            found = [
                {"number": number, "covered": [{"a": a, "b": b} for a, b in located(automaton, text, n)]}
                for number, text in held
            ]
            return pa.RecordBatch.from_pylist(found, schema=kinds)

        for batch in batches:
            for number, text, once in zip(*batch.columns, strict=True):
                passage = text.as_py()
                words = passage.split(" ")
                where = np.arange(len(words) - n + 1)
                if once.is_valid:
                    where = np.delete(where, np.asarray(once.values))
                if not len(where):
                    continue
                for at in pattern_starts(where, n):
                    patterns.add(f" {' '.join(words[at : at + n])} ")
                held.append((number.as_py(), passage))
                chars += len(passage)
                if chars >= shard_chars:
                    yield shard()
                    patterns, held, chars = set(), [], 0
        if held:
            yield shard()

    return run


_FINISHED = ("row", "doc_id", "text", "n_words", "whole_sha256", "covered")
_OUT = "row bigint, doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def _finish(with_text: bool):
    kinds = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64())]
        + [("kept_sha256", pa.string()), ("kept", pa.string())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                out = []
                for row in batch.slice(low, 500).to_pylist():
                    removed, digest, text = 0, row["whole_sha256"], None
                    if row["covered"] or with_text:
                        words = (row["text"] or "").encode().split()
                        keep = np.ones(len(words), dtype=bool)
                        for x in row["covered"] or ():
                            keep[x["a"] : x["b"]] = False
                        removed = int(len(words) - keep.sum())
                        joined = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
                        digest = hashlib.sha256(joined).hexdigest()
                        text = joined.decode() if with_text else None
                    out.append(
                        {
                            "row": row["row"],
                            "doc_id": row["doc_id"],
                            "n_words": row["n_words"],
                            "n_removed": removed,
                            "kept_sha256": digest,
                            "kept": text,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return run


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    shard_chars: int = SHARD_CHARS,
    with_text: bool = True,
) -> DataFrame:
    """(row, doc_id, n_words, n_removed, kept_sha256, kept), one row for each row of `docs`.

    Each word in a window whose words occur at another place too, of any row, is removed; `kept` is
    what is left, joined by one blank (null unless `with_text`). A null text is an empty one. Repeated
    rows repeat each other's windows. Ids may be null. Other columns are not read.
    """
    if not 1 <= window <= 100:
        raise ValueError("a window has 1 to 100 words")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    whole = store(rows.mapInArrow(_scan(window), _SCANNED), "scanned")
    base = store(whole.rows.select("row", "doc_id", "n_words", "whole_sha256"), "documents")
    begun = whole.rows.select("row", F.explode("anchors").alias("mark"))
    again = begun.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark")
    again = store(again, "anchors")
    wanted = begun.join(again.rows, "mark").groupBy("row").agg(F.collect_set("mark").alias("marks"))
    wanted = store(wanted, "wanted")
    again.drop()
    cut = whole.rows.select("row", "text").join(wanted.rows, "row").select("row", "text", "marks")
    passages = store(cut.mapInArrow(_passages(window), _PASSAGES), "passages")
    wanted.drop()
    if not with_text:
        whole.drop()
    key = ["high", "low"]
    cuts = passages.rows.filter("start >= 0")
    counted = cuts.groupBy(*key).agg(F.count("*").alias("copies"), F.first("passage").alias("passage"))
    distinct = store(
        counted.select(F.monotonically_increasing_id().alias("number"), *key, "copies", "passage"), "distinct"
    ).rows
    windows = distinct.select("number", "copies", "passage").mapInArrow(
        _windows(window), "x bigint, y bigint, number bigint, at int, copies bigint"
    )
    # nearly all windows here recur, so the few that do not are looked for: such a window is in one place
    single = windows.groupBy("x", "y").agg(
        F.sum("copies").alias("n"), F.min("number").alias("number"), F.min("at").alias("at")
    )
    single = single.filter("n = 1").groupBy("number").agg(F.collect_list("at").alias("once"))
    once = store(single, "once")
    found = distinct.select("number", "passage").join(once.rows, "number", "left")
    covered = store(
        found.mapInArrow(_locate(window, shard_chars), "number bigint, covered array<struct<a: bigint, b: bigint>>"),
        "covered",
    )
    once.drop()
    named = store(distinct.select(*key, "number").join(covered.rows, "number").select(*key, "covered"), "named")
    places = cuts.select("row", "start", *key).join(named.rows, key)
    moved = F.transform("covered", lambda x: F.struct((x["a"] + F.col("start")).alias("a"), (x["b"] + F.col("start")).alias("b")))
    of_row = places.select("row", moved.alias("covered")).groupBy("row").agg(F.flatten(F.collect_list("covered")).alias("covered"))
    of_row = store(of_row, "removed")
    if with_text:
        passages.drop()
        changed = whole.rows.drop("anchors").join(of_row.rows, "row", "left")
        return changed.mapInArrow(_finish(True), _OUT)
    # only texts that hold a passage are read again
    texts = passages.rows.filter("start < 0").select("row", F.col("passage").alias("text"))
    changed = texts.join(of_row.rows, "row")
    return base.rows.join(changed, "row", "left").select(*_FINISHED).mapInArrow(_finish(False), _OUT)
