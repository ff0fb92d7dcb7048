"""Web archives as seekable Zstandard bundles.

A task appends its records to one archive: some records make a frame, a frame is compressed by itself,
and a skippable frame at the end of the file holds the seek table, the sizes of all frames before it.
The index maps a record's identifier to its archive, its frame and its place in that frame, so that one
record costs the reading of one frame. Readers share out frames, not files.

An attempt of a task that fails leaves an archive that no index row names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.storage import Stored, filesystem, store
from tidelog.session import work_dir

# The seekable format's numbers, and the names of the archive format.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_URN = "urn:x-page:"

INDEX = "page_id bigint, record_id string, path string, frame int, at int, size int"
_LARGEST = (1 << 63) - 1


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame for frames of these (compressed, plain) sizes."""
    entries = b"".join(struct.pack("<II", *x) for x in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer


class Archive:
    """Reading one bundle frame by frame."""

    def __init__(self, path: str):
        files, name = filesystem(path)
        self.file = files.open_input_file(name)
        end = self.file.size()
        self.file.seek(end - 9)
        count, descriptor, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != _SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        width = 12 if descriptor & 0x80 else 8
        self.file.seek(end - 9 - count * width)
        table = self.file.read(count * width)
        self.frames, place = [], 0
        for n in range(count):
            packed, plain = struct.unpack_from("<II", table, n * width)
            self.frames.append((place, packed, plain))
            place += packed

    def frame(self, number: int) -> bytes:
        place, packed, plain = self.frames[number]
        self.file.seek(place)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def _record(row: dict, payload: bytes) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    response = row["refers_to"] is None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if response else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if response else 'revisit'}",
        f"WARC-Record-ID: <{row['record_id']}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        head.insert(3, f"WARC-Target-URI: {quote(row['url'], safe=':/?#[]@!$&()*+,;=%~-._')}")
    if not response:
        head += [f"WARC-Refers-To: <{row['refers_to']}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(place, size, header fields, block) of each record of a frame."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        begin = head + 4
        end = begin + int(fields["Content-Length"])
        yield at, end + 4 - at, fields, data[begin:end]
        at = end + 4


def _write(folder: str, frame_bytes: int, level: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        files, name = filesystem(folder)
        path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        out = None
        packer = zstandard.ZstdCompressor(level=level)
        sizes: list[tuple[int, int]] = []
        frame: list[bytes] = []
        held = 0
        index: list[tuple] = []

        def close_frame() -> None:
            nonlocal held, frame, out
            if frame:
                if out is None:
                    out = files.open_output_stream(f"{name}/{path.rsplit('/', 1)[1]}", compression=None)
                packed = packer.compress(b"".join(frame))
                out.write(packed)
                sizes.append((len(packed), held))
                frame, held = [], 0

        for batch in batches:
            for row in batch.to_pylist():
                record = _record(row, (row["html"] or "").encode())
                index.append((row["page_id"], row["record_id"], path, len(sizes), held, len(record)))
                frame.append(record)
                held += len(record)
                if held >= frame_bytes:
                    close_frame()
        close_frame()
        if out is not None:
            out.write(seek_table(sizes))
            out.close()
            columns = ["page_id", "record_id", "path", "frame", "at", "size"]
            kinds = {"frame": "int32", "at": "int32", "size": "int32"}
            found = pd.DataFrame(index, columns=columns).astype(kinds).astype({"page_id": "Int64"})
            yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    return run


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    frame_bytes: int = 1 << 20,
    level: int = 3,
) -> Stored:
    """Write one record for each row below `folder`, which must exist; the stored index has a row for each.

    Of equal payloads of at least `least_bytes` the one with the smallest id is a response and the
    others revisit it. A null payload is an empty one; a null id is larger than any other, and of rows
    with equal ids one is the response. A null url is left out of the record. Other columns are not
    read. An empty table makes no archive and an empty index.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).alias("bytes"),
    )
    kept = store(rows, "pages")
    key = ["digest", "bytes"]
    first = F.min(F.struct(F.coalesce("page_id", F.lit(_LARGEST)).alias("id"), F.struct("page_id", "row").alias("of")))
    groups = (
        kept.rows.filter(F.col("bytes") >= least_bytes)
        .groupBy(*key)
        .agg(F.count("*").alias("n"), first.alias("first"))
        .filter("n > 1")
        .select(*key, "first.of")
    )
    copies = store(groups, "payloads")

    def name(page_id, row):
        return F.concat(F.lit(_URN), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), row.cast("string"))

    typed = kept.rows.join(copies.rows, key, "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        name(F.col("page_id"), F.col("row")).alias("record_id"),
        F.when(F.col("of.row") != F.col("row"), name(F.col("of.page_id"), F.col("of.row"))).alias("refers_to"),
    )
    index = store(typed.mapInArrow(_write(folder, frame_bytes, level), INDEX), "archive-index")
    kept.drop()
    copies.drop()
    return index


_READ = (
    "page_id bigint, record_id string, record_type string, refers_to bigint, url string, "
    "payload_bytes bigint, payload_digest string, payload binary"
)


def _page_of(identifier: str) -> int | None:
    number = identifier.strip("<>")[len(_URN) :].split(":")[0]
    return int(number) if number else None


def _row(fields: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]),
        "record_id": fields["WARC-Record-ID"].strip("<>"),
        "record_type": fields["WARC-Type"],
        "refers_to": None if response else _page_of(fields["WARC-Refers-To"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "payload": payload if response else None,
    }


def _read(with_payload: bool):
    kinds = pa.schema(
        [
            ("page_id", pa.int64()),
            ("record_id", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload", pa.binary()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, opened = None, None
        for batch in batches:
            for unit in batch.to_pylist():
                if unit["path"] != opened:
                    if archive:
                        archive.close()
                    archive, opened = Archive(unit["path"]), unit["path"]
                places = set(unit["places"]) if unit["places"] else None
                rows = []
                for at, _, fields, block in parse_records(archive.frame(unit["frame"])):
                    if places is None or at in places:
                        rows.append(_row(fields, block))
                        if not with_payload:
                            rows[-1]["payload"] = None
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)
        if archive:
            archive.close()

    return run


def read_archives(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives named in an index, read frame by frame; digests are checked."""
    frames = index.select("path", "frame").distinct().withColumn("places", F.lit(None).cast("array<int>"))
    return frames.sortWithinPartitions("path", "frame").mapInArrow(_read(with_payload), _READ)


def read_records(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records whose `record_id` is in `wanted`: only their frames are read."""
    found = index.join(wanted.select("record_id"), "record_id", "left_semi")
    frames = found.groupBy("path", "frame").agg(F.collect_set("at").alias("places"))
    return frames.sortWithinPartitions("path", "frame").mapInArrow(_read(True), _READ)


def new_folder(spark: SparkSession) -> str:
    """A new shared folder for archives."""
    folder = work_dir(spark, "archives")
    files, name = filesystem(folder)
    files.create_dir(name)
    return folder
