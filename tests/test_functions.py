import json

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog.functions import scalars as s
from tidelog.functions.chunks import fixed_chunks, recursive_chunks, split_text
from tidelog.functions.encode import ENCODED_TEXTS, embed, hashed_words
from tidelog.operators.columns import flatten_field, nested_field
from tidelog.operators.documents import chunk_rows, ingest
from tidelog.operators.validate import check_records, reject_counts, split_records
from tidelog.operators.vectors import cosine_top_k


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_iso_timestamps_and_dates(spark):
    df = texts(
        spark,
        "2025-05-08T15:09:40.271017",
        "2023-02-10T23:54:34-05:00",
        "2023-02-10T03:54:34Z",
        "bad",
        None,
        "2023-13-45T03:54:34Z",
        "2023-02-10",
        "2023",
        "12:30:00",
    )
    assert column(df, F.unix_millis(s.iso_timestamp("t"))) == [
        1746716980271,
        1676091274000,
        1676001274000,
        None,
        None,
        None,
        1675987200000,
        None,
        None,
    ]
    assert column(df, F.unix_micros(s.iso_timestamp("t", millis=False)))[0] == 1746716980271017
    days = ["2025-05-08", "2023-02-10", "2023-02-10", None, None, None, "2023-02-10", None, None]
    assert column(df, s.iso_date("t")) == days


def test_iso_forms(spark):
    """What the standard library reads, to the microsecond, and nothing that it does not read."""
    from datetime import UTC, datetime

    values = [
        "2025-05-08T15:09:40.271017123Z",
        "2025-05-08T15:09:40,2",
        "2025-05-08T15",
        "2025-05-08T15+02",
        "20250508T150940Z",
        "20250508T1509",
        "20250508",
        "2025-05-08 150940.123456789-0330",
        "2025-05-08T15:09:40.1234567+05:30",
        "2025-05-08T15:0940",
        "2025-0508T15",
        "2025-05-08T",
        "2025-05-08T15:09:61",
    ]

    def micros(text):
        try:
            moment = datetime.fromisoformat(text)
        except ValueError:
            return None
        moment = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
        return round((moment - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds() * 10**6)

    got = column(texts(spark, *values), F.unix_micros(s.iso_timestamp("t", millis=False)))
    assert dict(zip(values, got, strict=True)) == {v: micros(v) for v in values}
    days = column(texts(spark, *values), s.iso_date("t"))
    assert days == [None if micros(v) is None else "2025-05-08" for v in values]


def test_unreadable_messages(spark):
    from pyspark.errors import PySparkException

    from tidelog.sources.messages import decode_json

    rows_in = [('{"a": 1, "b": "x"}',), ("junk",), (None,), ('{"a": "no number"}',), ('{"b": "y", "c": 3}',), ("",)]
    messages = spark.createDataFrame(rows_in, "value string")
    assert rows(decode_json(messages, "a int, b string")) == [(1, "x"), (None, "y")]
    assert decode_json(messages, "a int, b string", bad="keep").count() == len(rows_in)
    with pytest.raises(PySparkException, match="unreadable message"):
        decode_json(messages, "a int, b string", bad="fail").collect()
    with pytest.raises(ValueError, match="bad must be"):
        decode_json(messages, "a int, b string", bad="skip")


def test_pages_fetched_twice_or_never(spark):
    from tidelog.operators.documents import load_text, without_page

    books = spark.createDataFrame([("A", "u1"), ("B", "u2"), ("C", "u3")], "title string, link string")
    pages = spark.createDataFrame([(1, "u1", "old"), (5, "u1", "new"), (2, "u2", "two")], "page_id int, url string, html string")
    assert rows(load_text(books, pages).select("title", "text")) == [("A", "new"), ("B", "two")]
    assert rows(without_page(books, pages)) == [("C", "u3")]


def test_the_fetch_of_a_book(spark):
    from tidelog.operators.documents import load_text

    books = spark.createDataFrame([(1, "u1"), (5, "u1"), (2, None), (7, "u1")], "id int, link string")
    pages = spark.createDataFrame([(1, "u1", "old"), (5, "u1", "new"), (2, None, "two")], "page_id int, url string, html string")
    got = load_text(books, pages, fetch=("id", "page_id"))
    assert rows(got) == [(1, "u1", "old"), (2, None, "two"), (5, "u1", "new")]


@pytest.mark.parametrize("name", ["v1_load_text", "v4_ingest", "v4_ingest_recursive_chunks"])
def test_books_of_one_link(spark, tmp_path, name):
    """A link that was fetched twice gives each of its books the text of its own fetch."""
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    html = "<html><title>{}</title><body><p>" + "word {} " * 400 + "</p></body></html>"
    data = [(n, f"http://h/{n // 2}", html.format(*[n] * 401)) for n in range(5)]
    pages = spark.createDataFrame(data, "page_id bigint, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    frame = queries()[name](spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = connection.execute(f"SELECT {', '.join(frame.columns)} FROM ({oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(want, key=repr)


def test_neighbours_with_text_ids(spark):
    collection = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("c", [0.0, 1.0])], "_id string, embedding array<double>")
    queries = spark.createDataFrame([(n, [1.0, 0.1]) for n in range(3)], "query_id int, vector array<double>")
    for block in (1, 10):
        near = cosine_top_k(collection, queries, 2, "_id", queries_per_block=block)
        assert rows(near.select("query_id", "neighbour_id")) == [(n, i) for n in range(3) for i in "ab"]


def test_utc_millis(spark):
    assert column(texts(spark, "2023-02-10T03:54:34Z", None), s.utc_millis("t")) == [1676001274000, None]


def test_json_value(spark):
    df = texts(spark, '{"a": {"b": "x"}, "n": 1.5, "t": true, "s": "[1]", "z": null}', "not json", None)
    assert column(df, s.json_value("t", "$.a.b")) == ["x", None, None]
    assert column(df, s.json_value("t", "$.a")) == [None, None, None]
    assert column(df, s.json_value("t", "$.n")) == ["1.5", None, None]
    assert column(df, s.json_value("t", "$.t")) == ["true", None, None]
    assert column(df, s.json_value("t", "$.s")) == ["[1]", None, None]
    assert column(df, s.json_value("t", "$.z")) == [None, None, None]
    assert column(df, s.json_value("t", "$.none")) == [None, None, None]


def test_small_functions(spark):
    df = texts(spark, "/v1/test?a=1&b=2")
    assert column(df, s.document_id(F.lit("org1"), F.lit("2025-05-20"), "t")) == [
        "org1_2025-05-20__v1_test_a=1_b=2"
    ]
    start = F.lit("2025-05-20 10:00:00").cast("timestamp_ntz")
    assert column(df, s.window_document_id(F.lit("o"), start, F.lit("/u"))) == ["o_2025-05-20_10-00-00__u"]
    smallest = spark.createDataFrame([(0, -(2**63)), (1, -7), (2, 13)], "i int, n bigint")
    assert column(smallest, s.abs_mod("n", 10)) == [8, 7, 3]
    assert column(smallest, s.lookup(F.col("i"), ["zero", "one"])) == ["zero", "one", None]
    assert column(smallest, s.lookup(F.col("i") - 1, ["zero", "one"])) == [None, "zero", "one"]
    assert column(texts(spark, "a\n\n\nb\nc"), s.collapse_blank_lines("t")) == ["a\nb\nc"]
    assert column(texts(spark, " a b c \x1c d"), s.words("t")) == [["a", "b", "c", "d"]]
    assert column(df, s.message(F.lit("m"))) == ["Message: m"]
    page = "<html><script>var t='</p>';</script><!-- x --><p>A &amp; B</p><p>C</p></html>"
    assert column(texts(spark, page), s.page_text("t")) == ["A & B\nC\n"]


def record(**changes):
    full = {
        "EdgeEndTimestamp": "2023-02-10T03:54:34Z",
        "ClientRequestURI": "/u",
        "EdgeResponseStatus": 200,
        "ResponseHeaders": {"x-org-uid": "o"},
    }
    full.update(changes)
    return json.dumps({k: v for k, v in full.items() if v is not None})


def test_validation(spark):
    lines = [
        record(),
        record(EdgeResponseStatus=True),
        record(ClientRequestURI=None),
        record(EdgeResponseStatus="200"),
        record(ResponseHeaders="x"),
        record(ResponseHeaders={}),
        record(ResponseHeaders={"x-org-uid": 5}),
        record(EdgeResponseStatus=1.5),
        "[1]",
        "nothing",
        None,
    ]
    df = texts(spark, *lines).withColumnRenamed("t", "value")
    assert column(check_records(df), "reject_reason") == [
        None,
        None,
        "ClientRequestURI",
        "EdgeResponseStatus",
        "ResponseHeaders",
        "x-org-uid",
        "x-org-uid",
        "EdgeResponseStatus",
        "record",
        "record",
        "record",
    ]
    good, bad = split_records(df)
    assert good.count() == 2 and bad.count() == 9
    assert dict(rows(reject_counts(df)))["ok"] == 2


def test_nested_field_default(spark):
    df = spark.createDataFrame([(1, ("a",)), (2, (None,)), (3, None)], "i int, h struct<`x-y`: string>")
    assert column(df, nested_field("h", "x-y", "")) == ["a", "", ""]
    assert column(flatten_field(df, "h", "x-y", "xy"), "xy") == ["a", "", ""]


LONG = "\n\n".join(
    "\n".join(" ".join(f"w{p}{line}{w}" for w in range(40)) for line in range(12)) for p in range(6)
)


@pytest.mark.parametrize("size,overlap", [(300, 50), (2048, 256), (64, 0)])
def test_recursive_chunks(size, overlap):
    text = LONG + "\n\n" + "x" * 5000 + "\n\nend"
    chunks = split_text(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    # every word is kept, in order; the long one in pieces
    position = 0
    for word in LONG.split():
        while word not in chunks[position].split():
            position += 1
    assert sum(c.count("x") for c in chunks) >= 5000
    assert chunks[-1].endswith("end")


def test_recursive_chunks_of_short_texts():
    assert split_text("") == []
    assert split_text("  \n ") == []
    assert split_text("short") == ["short"]
    assert split_text("aa bb cc", 5, 2) == ["aa bb", "bb cc"]
    assert split_text("aa bb cc", 5, 0) == ["aa bb", "cc"]
    assert split_text("abcdef", 4, 2) == ["abcd", "cdef"]


def test_chunk_columns(spark):
    df = texts(spark, "abcdefghij", "", None, "ab")
    assert column(df, fixed_chunks("t", 4, 1)) == [["abcd", "defg", "ghij", "j"], None, None, ["ab"]]
    assert rows(chunk_rows(df, fixed_chunks("t", 4, 1), "t"))[0] == (0, 0, "abcd")
    assert column(df, recursive_chunks(4, 0)("t")) == [["abcd", "efgh", "ij"], [], None, ["ab"]]


def test_encoders_get_few_texts_at_a_time(spark):
    def counting():
        return lambda texts: np.array([[float(len(texts)), float(text[1:])] for text in texts])

    df = spark.range(3000).select("id", F.when(F.col("id") % 7 != 0, F.concat(F.lit("t"), "id")).alias("t"))
    rows = df.coalesce(1).select("id", embed(counting)("t").alias("v")).collect()
    assert [r.id for r in rows] == list(range(3000))
    assert all((r.v is None) if r.id % 7 == 0 else r.v[1] == r.id for r in rows)
    assert max(r.v[0] for r in rows if r.v) <= ENCODED_TEXTS


def test_embedding(spark):
    df = texts(spark, "one two", None, "", "One  two")
    got = column(df, embed()("t"))
    assert got[1] is None and len(got[0]) == 384
    assert np.linalg.norm(got[0]) == pytest.approx(1) and not any(got[2])
    assert got[0] == got[3] and got[0] == hashed_words()(["two one"])[0].tolist()


def test_no_text_with_words_has_an_empty_vector(spark):
    import zlib

    def place(word):
        code = zlib.crc32(word.encode())
        return code % 384, code & 0x80000000

    seen = {}
    for word in map("w{}".format, range(10_000)):
        at, sign = place(word)
        other = seen.get((at, sign ^ 0x80000000))
        if other:
            break
        seen[at, sign] = word
    assert other  # the two cancel out
    # white space beyond blanks, tabs and line ends is part of a word
    df = texts(spark, f"{word} {other}", "\x0b", " \t\r\n", f"{word} {other} more")
    norms = [np.linalg.norm(v) for v in column(df, embed()("t"))]
    assert norms == pytest.approx([1, 1, 0, 1])


def test_ingest(spark):
    books = spark.createDataFrame([(1, "T", "http://a"), (2, "U", "http://gone")], "id int, title string, link string")
    pages = spark.createDataFrame([("http://a", "<p>one</p><p>two</p>")], "url string, html string")
    (row,) = ingest(books, pages).collect()
    assert (row["title"], row["source"], row["chunk"]) == ("T", "http://a", "one\ntwo\n")
    assert row["_id"] == ingest(books, pages).first()["_id"] and row["ts"] is not None


@pytest.mark.parametrize("per_block", [1_000, 3])
def test_cosine_top_k(spark, per_block):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(200, 8))
    vectors[10] = vectors[20]  # equal similarities
    vectors[30] = 0
    queries = rng.normal(size=(7, 8))
    collection = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id int, vector array<double>")
    got = cosine_top_k(collection.repartition(3), asked, 4, queries_per_block=per_block)
    want = []
    for q, query in enumerate(queries):
        scores = {
            i: float(v @ query / np.linalg.norm(v) / np.linalg.norm(query)) for i, v in enumerate(vectors) if v.any()
        }
        for i in sorted(scores, key=lambda i: (-round(scores[i], 12), i))[:4]:
            want.append((q, i, round(scores[i], 4)))
    assert rows(got) == sorted(want, key=repr)


def test_centroids_of_ragged_vectors_and_missing_values(spark):
    from tidelog.operators.vectors import label_centroids

    data = [("a", [1.0, 2.0]), ("a", [3.0, None, 5.0]), (None, [4.0]), ("b", None), ("c", []), ("a", [5.0, 4.0])]
    df = spark.createDataFrame(data, "label string, embedding array<float>").repartition(3)
    got = {r["query_id"]: list(r["vector"]) for r in label_centroids(df).collect()}
    assert got == {"a": [3.0, 3.0, 5.0], None: [4.0]}


def test_the_collection_is_not_shuffled_for_many_queries(spark):
    """What a job for a block of queries writes to shuffles is at most k rows per query and task."""
    import numpy as np

    draw = np.random.default_rng(1)
    data = [(n, draw.normal(size=8).tolist()) for n in range(500)]
    collection = spark.createDataFrame(data, "vec_id bigint, embedding array<double>").repartition(4)
    asked = collection.limit(90).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    many = cosine_top_k(collection, asked, 3, queries_per_block=20)
    assert rows(many) == rows(cosine_top_k(collection, asked, 3))
    assert "embedding" not in many._jdf.queryExecution().executedPlan().toString()
