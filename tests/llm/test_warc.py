import base64
import hashlib

import zstandard

from tidelog.llm import warc
from tidelog.llm.storage import filesystem

ROWS = [
    (5, "http://a.example/x y", "<p>same</p>"),
    (3, None, "<p>same</p>"),
    (3, "http://b.example/é", "<p>same</p>"),
    (7, "http://c.example", None),
    (8, "http://d.example/\r\nX: y", ""),
    (None, "http://e.example", "<p>ünï 😀\r\n\r\n</p>"),
    (9, "http://f.example", "x" * 300_000),
    (10, "http://g.example", "<p>ünï 😀\r\n\r\n</p>"),
]
SCHEMA = "page_id bigint, url string, html string, path string, frame int, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", 3, "d") for r in rows], SCHEMA)


def test_round_trip(spark):
    index = warc.write_archives(pages(spark, ROWS), warc.new_folder(spark), frame_bytes=1000)
    got = warc.read_archives(index.rows).collect()
    assert len(got) == len(ROWS) == index.rows.count()
    payloads = sorted(r["payload"] for r in got if r["record_type"] == "response")
    assert [bytes(p) for p in payloads] == sorted({(h or "").encode() for _, _, h in ROWS})
    for r in got:
        if r["record_type"] == "response":
            assert r["payload_bytes"] == len(r["payload"])
            assert r["payload_digest"] == base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
    short = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in got), key=repr)
    assert short == sorted(
        [
            (3, "response", None),
            (3, "revisit", 3),
            (5, "revisit", 3),
            (7, "response", None),
            (8, "revisit", 7),
            (None, "revisit", 10),
            (9, "response", None),
            (10, "response", None),
        ],
        key=repr,
    )


def test_one_record_by_its_identifier(spark):
    index = warc.write_archives(pages(spark, ROWS), warc.new_folder(spark), frame_bytes=1000).rows
    wanted = index.filter("page_id = 9").select("record_id")
    (record,) = warc.read_records(index, wanted).collect()
    assert record["page_id"] == 9 and len(record["payload"]) == 300_000
    place = index.filter("page_id = 9").first()
    frame = warc.Archive(place["path"]).frame(place["frame"])
    assert frame[place["at"] : place["at"] + place["size"]].startswith(b"WARC/1.1\r\nWARC-Type: response")


def test_bundle_is_plain_zstandard_with_a_seek_table(spark):
    index = warc.write_archives(pages(spark, ROWS), warc.new_folder(spark), frame_bytes=1000).rows
    for (path,) in index.select("path").distinct().collect():
        files, name = filesystem(path)
        data = files.open_input_file(name).read()
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        archive = warc.Archive(path)
        assert whole == b"".join(archive.frame(n) for n in range(len(archive.frames)))


def test_smallest_payloads_are_not_revisited(spark):
    index = warc.write_archives(pages(spark, ROWS), warc.new_folder(spark), least_bytes=1)
    empty = [r["record_type"] for r in warc.read_archives(index.rows).collect() if not r["payload_bytes"]]
    assert empty == ["response", "response"]


def test_no_rows(spark):
    index = warc.write_archives(pages(spark, []), warc.new_folder(spark))
    assert index.rows.count() == 0 and warc.read_archives(index.rows).collect() == []
