import hashlib
import random

import pytest

from tests.llm.brute import without_repeats as brute
from tests.llm.conftest import frame, odd_texts, prose
from tidelog.llm.repeated import without_repeats


def check(rows, got, n):
    want = [
        (i, a, b, hashlib.sha256(" ".join(k).encode()).hexdigest(), " ".join(k))
        for (i, _), (a, b, k) in zip(rows, brute([t for _, t in rows], n), strict=True)
    ]
    found = [tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("n, shard", [(35, 4_000_000), (3, 500), (1, 100)])
def test_odd_texts(odd, n, shard):
    check(odd_texts(), without_repeats(odd, window=n, shard_chars=shard).collect(), n)


def test_passages_shared_in_parts(spark):
    """Passages that other texts hold as a whole, in part, twice, or with a changed word."""
    pick = random.Random(5)
    stock = [prose(100 + n, 60).split() for n in range(4)]
    rows = []
    for i in range(30):
        text = []
        for _ in range(pick.randint(1, 4)):
            text += prose(1000 + pick.randint(0, 10**6), pick.randint(0, 20)).split()
            passage = list(pick.choice(stock))
            a, b = sorted(pick.sample(range(61), 2))
            if pick.random() < 0.3:
                passage[pick.randrange(60)] = "changed"
            text += passage[a:b]
        rows.append((i, "\n".join(text)))
    check(rows, without_repeats(frame(spark, rows), window=12).collect(), 12)


def test_few_words_many_repeats(spark):
    rows = [(i, " ".join(random.Random(i).choices("ab", k=25))) for i in range(12)]
    check(rows, without_repeats(frame(spark, rows), window=6).collect(), 6)


def test_without_texts(odd):
    """The same counts and digests, from the texts that hold a passage alone."""
    plain = without_repeats(odd, with_text=False)
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    got = sorted((tuple(r) for r in plain.select(*columns).collect()), key=repr)
    want = sorted((tuple(r) for r in without_repeats(odd).select(*columns).collect()), key=repr)
    assert got == want and any(r[2] for r in got)
    assert {r[0] for r in plain.select("kept").distinct().collect()} == {None}


def test_no_rows(nothing):
    assert without_repeats(nothing).collect() == []
    assert without_repeats(nothing, with_text=False).collect() == []
