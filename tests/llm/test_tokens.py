import struct
import zlib

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import odd_texts
from tidelog.llm import tokens
from tidelog.session import work_dir

PATH = tokens.default_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def test_encoder_gives_the_ids_of_the_library(tokenizer, spark):
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    texts += [t or "" for _, t in odd_texts()]
    texts += ["", " ", "  a", "a  ", "a \n b", "\n", "a  b", "a  b", "it's 're x", "<|endoftext|> x", "a\x1f b"]
    encoder = tokens.Encoder(PATH)
    for _ in range(2):  # from the library, then as kept
        got = encoder.encode(texts)
        for text, ids in zip(texts, got, strict=True):
            assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_batches_of_long_texts_are_bounded_in_bytes(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 9000, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 100) AS text")
    path = work_dir(spark, "tokens")
    tokens.write_tokens(docs, path, shards=1)
    got = docs.mapInArrow(sizes, "n bigint, size bigint").collect()
    assert sum(r["n"] for r in got) == 9000 and max(r["size"] for r in got) < 5_000_000
    assert tokens.checksums(tokens.read_tokens(spark, path)).count() == 9000


def test_files_hold_all_tokens_in_order(odd, spark, tokenizer):
    path = work_dir(spark, "tokens")
    tokens.write_tokens(odd, path, shards=3)
    got = tokens.read_tokens(spark, path).orderBy("start").collect()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        assert r["ids"][-1] == 0
        at += r["n_tokens"]
    want = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in odd_texts()]
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == sorted(want, key=repr)
    sums = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in tokens.checksums(tokens.read_tokens(spark, path)).collect()}
    for r in got:
        assert sums[r["doc_id"], r["start"]] == zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"]))


def test_lookup_by_id(odd, spark):
    path = work_dir(spark, "tokens")
    tokens.write_tokens(odd, path)
    found = tokens.lookup(spark, path, [4, 12])
    assert sorted(r["doc_id"] for r in found.collect()) == [4, 12]
    assert "doc_id" in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]


def test_no_rows(nothing, spark):
    path = work_dir(spark, "tokens")
    tokens.write_tokens(nothing, path)
    assert tokens.read_tokens(spark, path).collect() == []


def test_doubled_white_space_is_that_of_python():
    """Every character that Python takes as white space, twice, beside another one and alone."""
    import re
    import sys

    import pyarrow as pa
    import pyarrow.compute as pc

    from tidelog.llm.tokens import _DOUBLED, Encoder, default_tokenizer

    blanks = [chr(n) for n in range(sys.maxunicode + 1) if chr(n).isspace()]
    texts = [x for b in blanks for x in (f"a{b}{b}b", f"a {b}b", f"a{b}b", f"{b}a{b}")] + ["", "a\u200b\u200bb", "a\u180e\u180eb"]
    found = pc.match_substring_regex(pa.array(texts), _DOUBLED).to_pylist()
    assert found == [bool(re.search(r"\s\s", t)) for t in texts]
    encoder = Encoder(default_tokenizer())
    assert encoder.encode(texts) == encoder._direct(texts) and encoder.encode([]) == []


def test_each_piece_is_taken_apart_once_and_new_words_go_together(monkeypatch):
    """Words with marks after them were taken apart at each occurrence, and new words encoded one by one."""
    calls = {"_piece": 0, "_one": 0, "_direct": 0}
    encoder = tokens.Encoder(PATH)
    for name in calls:
        whole = getattr(encoder, name)

        def counted(x, name=name, whole=whole):
            calls[name] += 1
            return whole(x)

        monkeypatch.setattr(encoder, name, counted)
    texts = [f"Some words, and some marks. Number {n}x: caf\u00e9, word{chr(97 + n % 26)}.\nLine;" for n in range(400)]
    texts += ["", ",", "a,b 1,2 it's, (x) don't!", "\n", "a,\nb", "\nx, y", "x  y", "caf\u00e9 \u00c0. \u0120a b", " x", "x "]
    got = encoder.encode(texts)
    assert sum(calls.values()) < 1500  # 3,274 before; 400 numbers are 400 pieces
    assert got == encoder._direct(texts)
    assert encoder.encode(texts[::-1]) == got[::-1]
    assert encoder.encode([texts[0]] * 3) == got[:1] * 3 and encoder.encode(["a  b", "", "c  d"]) == encoder._direct(["a  b", "", "c  d"])
    sliced = pa.array(["out of, sight", *texts]).slice(1)
    ids, sizes = encoder.ids(sliced, b"\7\0\0\0")
    assert ids.tobytes() == b"".join(x + b"\7\0\0\0" for x in got) and sizes.tolist() == [len(x) // 4 + 1 for x in got]


def test_random_texts_have_the_ids_of_the_library():
    import random

    chance = random.Random(5)
    parts = ["a", "Word", "the", " ", " ", " ", "\n", ",", ".", "'s", "'", "1", "42", "\t", "\u00e9", "\u0120", "\u4e2d", "\U0001f600", "\u00a0", "-", "(", "\x00", "\r"]
    texts = ["".join(chance.choices(parts, k=chance.randrange(12))) for _ in range(5000)]
    encoder = tokens.Encoder(PATH)
    for _ in range(2):
        assert encoder.encode(texts) == encoder._direct(texts)
