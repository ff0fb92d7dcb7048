"""Token ids of documents in ORC files.

Documents are dealt out by ranges of their id, so that the files in order of their shard hold the
documents in ascending order. A task encodes its range and writes it: ORC keeps the ids as run-length
encoded integers, in stripes that readers share out between them, with row indexes and Bloom filters
on `doc_id` by which a reader of a few documents skips the rest. Each row knows the tokens before it in
its shard; one number for each shard, the tokens of the shards before, makes that a place in the corpus.

Encoding: a token never spans the border between a word and a blank before the next one, so texts
without doubled white space are cut there, each distinct piece of a batch is looked up once, and its ids are
kept for the next time.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.storage import shuffle_files_removed
from tidelog.llm.words import pieces
from tidelog.session import bounded_batches

SCHEMA = "shard int, doc_id bigint, at bigint, n_tokens bigint, ids array<int>"
#: distinct pieces whose ids a worker keeps; beyond it, pieces that are not kept are encoded again
KEPT_PIECES = 300_000
_BATCH_BYTES = 4_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# letters of ASCII and Latin-1, then marks: the borders between them are borders of tokens
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
# two characters of white space, as `str.isspace` has them; looked for in whole columns
_DOUBLED = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
_PLAIN = rf"( ?[{_LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)"
_WORD = r"\A [A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+\z"
_IS_LETTER, _IS_MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_IS_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_IS_MARK[0x21:0x7F] = ~_IS_LETTER[0x21:0x7F]
_IS_MARK[[ord("'"), *range(ord("0"), ord("9") + 1)]] = False


def _byte_letters() -> dict[int, str]:
    """For each byte its letter in byte-level vocabularies: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


def _cut(texts: pa.Array, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(first byte of each piece, distinct pieces, which of them each piece is) of texts without doubled white space.

    A piece begins with a text, at a blank, at and after a line's end, and at a mark after a letter.
    """
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8)[: offsets[-1]] if buffer is not None else np.zeros(0, dtype=np.uint8)
    line = data == 0x0A
    begins = line | (data == 0x20)
    begins[1:] |= line[:-1] | (_IS_MARK[data[1:]] & _IS_LETTER[data[:-1]])
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    begins[: offsets[0]] = False
    start = np.flatnonzero(begins)
    if not len(start):
        return start, pa.array([], type=pa.large_string()), start
    bounds = pa.py_buffer(np.append(start, offsets[-1]).astype(np.int64))
    found = pa.Array.from_buffers(pa.large_string(), len(start), [None, bounds, buffer]).dictionary_encode()
    return start, found.dictionary, np.asarray(found.indices).astype(np.int64)


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist


class Encoder:
    """Ids of texts as the tokenizers library gives them, without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.newline = self._direct(["\n"])[0]
        self.kept: dict[str, bytes] = {"\n": self.newline}
        self.plain = re.compile(_PLAIN).fullmatch
        self.letters = _byte_letters()
        pieces = self.tokenizer.get_vocab(with_added_tokens=True)
        self.blank = np.zeros(max(pieces.values()) + 1, dtype=bool)
        self.blank[[n for piece, n in pieces.items() if piece.startswith(self.letters[0x20])]] = True

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder: it outlives a task."""
        found = sys.__dict__.setdefault("_tidelog_encoders", {})
        if path not in found:
            found[path] = cls(path)
        return found[path]

    def _direct(self, texts: Sequence[str]) -> list[bytes]:
        """Ids by the library's whole way."""
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _one(self, piece: str) -> bytes:
        """Ids of a piece that is one token for the pre-tokenizer, from the library's model."""
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _keep(self, piece: str, ids: bytes) -> bytes:
        if len(self.kept) < KEPT_PIECES:
            self.kept[piece] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that is not kept. Words are kept without the marks after them."""
        if "\n" in piece:  # a single one, as white space is not doubled
            return self.newline.join([self._get(x) for x in piece.split("\n")])
        parts = self.plain(piece)
        if not parts:
            return self._keep(piece, self._direct([piece])[0] if piece else b"")
        word, marks = parts.groups()
        kept = self.kept
        ids = kept.get(word) or self._keep(word, self._one(word))
        return ids + (kept.get(marks) or self._keep(marks, self._one(marks))) if marks else ids

    def _get(self, piece: str) -> bytes:
        ids = self.kept.get(piece)
        return self._piece(piece) if ids is None else ids

    def _new(self, found: pa.Array) -> list[bytes]:
        """Ids of distinct pieces that are not kept. Blanks with letters go to the library as one text: only first tokens hold a blank."""
        names, plain = _listed(found), pc.match_substring_regex(found, _WORD).to_pylist()
        together = [name for name, is_plain in zip(names, plain, strict=True) if is_plain]
        parts = ["".join(together[low : low + 1000]) for low in range(0, len(together), 1000)]
        flat = np.frombuffer(b"".join(self._direct(parts)) if parts else b"", dtype=np.uint32)
        starts = np.flatnonzero(self.blank[flat]) * 4
        if len(starts) != len(together):  # not a vocabulary of this kind
            return [self._get(x) for x in names]
        data, ends = flat.tobytes(), np.append(starts, len(flat) * 4).tolist()
        encoded = (data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
        return [self._keep(x, next(encoded)) if is_plain else self._get(x) for x, is_plain in zip(names, plain, strict=True)]

    def ids(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in one run, how many each text has); `end` follows the ids of each."""
        texts = texts.cast(pa.large_string())
        doubled = pc.match_substring_regex(texts, _DOUBLED)
        whole = texts.filter(doubled).to_pylist()
        direct = self._direct(whole) if whole else []
        texts = pc.if_else(doubled, "", texts)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        start, distinct, codes = _cut(texts, offsets)
        found = list(map(self.kept.get, _listed(distinct)))
        new = [n for n, ids in enumerate(found) if ids is None]
        for n, ids in zip(new, self._new(distinct.take(pa.array(new, type=pa.int64()))), strict=True):
            found[n] = ids
        # each text has one piece more: its end, or all of it
        last = np.full(len(texts), len(found))
        last[np.asarray(doubled)] = np.arange(len(found) + 1, len(found) + 1 + len(direct))
        found += [end, *(ids + end for ids in direct)]
        bounds = np.searchsorted(start, offsets)
        codes = np.insert(codes, bounds[1:], last)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        before, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), dtype=np.uint32)
        sizes = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(before[codes] - ends[:-1], sizes)
        at += np.arange(ends[-1])
        return flat[at], np.diff(ends[bounds + np.arange(len(bounds))])

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        ids, sizes = self.ids(pa.array(texts, type=pa.large_string()))
        ends = np.cumsum(sizes) * 4
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(ends - sizes * 4, ends, strict=True)]


def encode_range(path: str, end_id: int):
    """A task's part of `write_tokens`: (doc_id, text) in order -> rows of SCHEMA."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, at = Encoder.of(path), TaskContext.get().partitionId(), 0
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for low, high in pieces(texts, _BATCH_BYTES):
                ids, sizes = encoder.ids(texts.slice(low, high - low), end)
                ends = np.cumsum(sizes)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), shard, dtype=np.int32)),
                        batch.column(0).slice(low, high - low),
                        pa.array(at + ends - sizes),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.view(np.int32))),
                    ],
                    names=["shard", "doc_id", "at", "n_tokens", "ids"],
                )
                at += int(ends[-1])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    shards: int | None = None,
    row_stride: int = 1000,
    stripe_bytes: int = 16 << 20,
) -> None:
    """Encode each text, end it with `end_id` and write the ids as ORC in ascending order of the id.

    A null text is an empty one: its ids are the end alone. A null id comes before all others. Rows
    with the same id follow each other by the hash of their text; equal rows are written each. Other
    columns are not read. An empty table makes files without rows. `shards` defaults to the session's
    shuffle partitions.
    """
    spark = bounded_batches(docs.sparkSession)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranges = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    encoded = ranges.mapInArrow(encode_range(tokenizer or default_tokenizer(), end_id), SCHEMA)
    writer = encoded.write.mode("errorifexists")
    for key, value in {
        "compression": "zstd",
        "orc.create.index": "true",
        "orc.row.index.stride": row_stride,
        "orc.stripe.size": stripe_bytes,
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": "0.01",
    }.items():
        writer = writer.option(key, value)
    with shuffle_files_removed(spark):
        writer.orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files; `start` counts the ids of all documents before.

    The places of the shards come from a sum over their row counts, one number for each file.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    sums = sorted((r["shard"], r["n"]) for r in rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    before, bases = 0, []
    for shard, n in sums:
        bases.append((shard, before))
        before += n
    places = spark.createDataFrame(bases, "shard int, before bigint")
    return rows.join(F.broadcast(places), "shard").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids"
    )


def lookup(spark: SparkSession, path: str, ids: Sequence[int]) -> DataFrame:
    """The rows of some documents; min/max and Bloom filters of `doc_id` skip the other stripes."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows.filter(F.col("doc_id").isin(list(ids))).select("doc_id", "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the CRC-32 of ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            values = np.asarray(ids.flatten()).astype("<u4").tobytes()
            ends = np.cumsum(np.asarray(pa.compute.list_value_length(ids), dtype=np.int64)) * 4
            crc = [zlib.crc32(values[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(crc, type=pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    bounded_batches(tokens.sparkSession)
    return tokens.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
