import zlib
from collections import Counter
from math import exp, log, log10

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.brute import words
from tests.llm.conftest import frame, odd_texts, prose
from tidelog.llm import lattice
from tidelog.llm.tokens import default_tokenizer

PATH = default_tokenizer()


def all_ways(text, table):
    """Sum over all segmentations, by trying each."""
    if not text:
        return 1.0
    return sum(p * all_ways(text[len(s) :], table) for s, p in table.items() if text.startswith(s))


def test_marginals_are_sums_over_all_segmentations():
    table = {b" ": 0.1, b"a": 0.2, b"b": 0.1, b"ab": 0.15, b" a": 0.05, b"aba": 0.3, b"ba": 0.1}
    pieces = lattice.Pieces.of(list(table), np.log(list(table.values())))
    cases = [b"a", b"ab", b"abab", b"ababa", b"bbba", b"a", b"abaaba", b"c"]
    for word, value in zip(cases, pieces.words(cases), strict=True):
        want = all_ways(b" " + word, table)
        assert exp(value) == pytest.approx(want, rel=1e-9, abs=0)


def test_vocabulary_has_every_byte():
    strings = lattice.vocabulary(PATH)
    assert {bytes([b]) for b in range(256)} <= set(strings)
    assert strings[50256] == b"" and len(strings) == 50257
    assert abs(lattice.prior(len(strings)).sum() - 1) < 1e-9


def expected(rows):
    """Everything in plain Python, word by word."""
    tokenizer = Tokenizer.from_file(PATH)
    train = Counter()
    ends = 0
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    for i, text in rows:
        if not held[i]:
            train.update(words(text))
            ends += 1
    n, v = sum(train.values()) + ends, len(train) + (ends > 0)
    strings = lattice.vocabulary(PATH)
    counts = np.zeros(len(strings))
    for word, c in train.items():
        for x in tokenizer.encode(" " + word, add_special_tokens=False).ids:
            counts[x] += c
    before = np.where([len(s) > 0 for s in strings], lattice.prior(len(strings)), 0)
    p = (counts + lattice.PRIOR * before / before.sum()) / (counts.sum() + ends + 1 + lattice.PRIOR)
    table = {s: log(x) for s, x in zip(strings, p, strict=True) if s}
    end = log((ends + 1) / (counts.sum() + ends + 1 + lattice.PRIOR))

    def marginal(word):
        text = b" " + word.encode()
        forward = [0.0] + [float("-inf")] * len(text)
        for b in range(1, len(text) + 1):
            for a in range(b):
                if text[a:b] in table:
                    forward[b] = np.logaddexp(forward[b], forward[a] + table[text[a:b]])
        return forward[-1]

    out = []
    for i, text in rows:
        w = words(text)
        known = sum(train[x] > 0 for x in w) + (ends > 0)
        base = sum(log10((train[x] + 1) / (n + v + 1)) for x in w) + log10((ends + 1) / (n + v + 1))
        out.append((i, held[i], len(w) + 1, known, n, base, (sum(map(marginal, w)) + end) / log(10)))
    return out


@pytest.mark.parametrize("most_head", [0, 5, 300_000])
def test_scores(spark, most_head):
    rows = [r for r in odd_texts() if r[0] != 8] + [
        (200 + n, prose(n % 9, 12).title() if n % 2 else prose(n % 9, 12)) for n in range(30)
    ]
    got = sorted((tuple(r) for r in lattice.lattice_scores(frame(spark, rows), most_head=most_head).collect()), key=repr)
    want = sorted(expected(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_no_rows_and_no_training_rows(spark, nothing):
    assert lattice.lattice_scores(nothing).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = lattice.lattice_scores(frame(spark, [(held, "a b")])).collect()
    assert row["held_out"] and row["train_tokens"] == 0 and row["n_known"] == 0 and row["score"] < 0


def test_batches_of_long_texts_are_bounded_in_bytes(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 9000, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 100) AS text")
    assert lattice.lattice_scores(docs, tokenizer=PATH).count() == 9000
    got = docs.mapInArrow(sizes, "n bigint, size bigint").collect()
    assert sum(r["n"] for r in got) == 9000 and max(r["size"] for r in got) < 5_000_000


def test_a_worker_reads_the_tokenizer_once(monkeypatch):
    """The library keeps tens of megabytes of each tokenizer that was used, also when it is dropped."""
    import sys

    import pyarrow as pa
    import tokenizers

    made = []

    class Counted:
        @staticmethod
        def from_file(path):
            made.append(path)
            return Tokenizer.from_file(path)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    monkeypatch.setitem(sys.__dict__, "_tidelog_encoders", {})
    words = pa.RecordBatch.from_arrays([pa.array(["some", "words", "<|endoftext|>"]), pa.array([2, 3, 1])], names=["word", "train"])
    tasks = [list(lattice._cut(PATH, 50257)([words])) for _ in range(5)]
    want = Counter()
    for word, n in [("some", 2), ("words", 3)]:
        want.update({i: n for i in Tokenizer.from_file(PATH).encode(" " + word).ids})
    (got,) = tasks[0]
    counts = dict(zip(got["piece"].to_pylist(), got["n"].to_pylist(), strict=True))
    assert len(made) == 1 and all(t == tasks[0] for t in tasks)
    assert {i: counts[i] for i in want} == want and 50256 not in counts
