import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.brute import shingle_set
from tests.llm.conftest import frame, odd_texts, prose
from tidelog.llm import scaled
from tidelog.llm.minhash import shingle_sets


def made(text):
    return scaled.sketch(next(shingle_sets(pa.array([text or ""]))))


def expected(rows):
    """Rows in their order, each beside the next; equal ids as the operator puts them is left open."""
    out = []
    for n, (i, text) in enumerate(rows):
        text, after = text or "", rows[(n + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed, following = made(text), made(edited), made(after)
        out.append(
            (
                i,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                scaled.encode(own),
                scaled.encode(changed),
                scaled.likeness(own, changed),
                scaled.likeness(own, following),
            )
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_every_document_meets_its_next(spark, ranges):
    rows = [(i, t) for i, (_, t) in enumerate(odd_texts())]
    random.Random(ranges).shuffle(rows)
    got = scaled.scaled_fingerprints(frame(spark, rows).repartition(5), ranges).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(sorted(rows, key=lambda r: -r[0]))


@pytest.mark.parametrize("ranges", [1, 3, 9])
def test_repeated_rows_and_rows_without_id(spark, ranges):
    """A third of the rows are one row; each gives a row of its own."""
    rows = [(i, prose(i, 40)) for i in range(20)] + [(7, prose(7, 40))] * 9 + [(None, "no id"), (None, "no id")]
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = scaled.scaled_fingerprints(frame(spark, rows).repartition(4), ranges).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(ordered)


def test_equal_ids_with_several_texts(odd):
    """Whatever the number of ranges, the same rows."""
    got = [sorted(map(tuple, scaled.scaled_fingerprints(odd, n).collect()), key=repr) for n in (1, 4, 16)]
    assert got[0] == got[1] == got[2] and len(got[0]) == len(odd_texts())


def test_an_only_document_and_none(spark, nothing):
    text = prose(1, 30)
    assert [tuple(r) for r in scaled.scaled_fingerprints(frame(spark, [(3, text)])).collect()] == expected([(3, text)])
    assert scaled.scaled_fingerprints(nothing).collect() == []


def test_sketch_holds_every_hash_below_the_fraction():
    for n in (0, 1, 4, 5, 36, 37, 200, 5_000):
        hashes = np.unique(next(shingle_sets(pa.array([prose(n, n)]))) >> np.uint64(16))
        bound, kept = made(prose(n, n))
        assert len(hashes) == len(shingle_set(prose(n, n)))
        assert kept.tolist() == [h for h in hashes.tolist() if h < bound]
        assert bound >= scaled.ALL // 16 and len(kept) >= min(len(hashes), scaled.FLOOR)
        again = scaled.decode(scaled.encode((bound, kept)))
        assert again[0] == bound and again[1].tolist() == kept.tolist()


def test_containment_of_very_unequal_texts():
    """Estimates beside the sets themselves."""
    words = prose(5, 20_000).split()
    misses = []
    for n in (100, 300, 1_000, 4_000):
        part = [*words[500 : 500 + n], *prose(6, n).split()]
        a, b = shingle_set(" ".join(part)), shingle_set(" ".join(words))
        misses.append(abs(scaled.containment(made(" ".join(part)), made(" ".join(words))) - len(a & b) / len(a)))
    assert max(misses) < 0.2 and misses[-1] < 0.06
    assert scaled.containment(made(" ".join(words)), made(" ".join(words[:2_000]))) == pytest.approx(0.1, abs=0.03)


def test_merged_sketches_are_those_of_the_texts_together():
    a, b = prose(1, 900), prose(2, 50)
    bound, hashes = scaled.merge(made(a), made(b))
    both = next(shingle_sets(pa.array([a]))).tolist() + next(shingle_sets(pa.array([b]))).tolist()
    assert hashes.tolist() == sorted({h >> 16 for h in both if h >> 16 < bound})
