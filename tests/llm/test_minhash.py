import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import components as brute
from tests.llm.conftest import frame, odd_texts, prose
from tidelog.llm import minhash
from tidelog.llm.components import components


def check(rows, got):
    groups, sizes = brute([t for _, t in rows])
    want = []
    for (i, _), group, size in zip(rows, groups, sizes, strict=True):
        known = [rows[n][0] for n in group if rows[n][0] is not None]
        want.append((i, size, min(known) if known else None))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(r["kept"] for r in got) == len({tuple(g) for g in groups})


def test_odd_texts(odd):
    check(odd_texts(), minhash.near_groups(odd).collect())


def family(seed, members, words=120, changed=3):
    """Copies of one text with some words changed, each in other places."""
    base = prose(seed, words).split()
    pick = random.Random(seed)
    out = [" ".join(base)]
    for m in range(members):
        copy = list(base)
        for at in pick.sample(range(words), pick.randint(0, changed)):
            copy[at] = f"new{m}x{at}"
        out.append(" ".join(copy))
    return out


def test_families_of_near_copies(spark):
    """Links that only some members have: similarities lie on both sides of the border."""
    texts = [t for n in range(6) for t in family(n, 12)] + [prose(99 + n, 30) for n in range(5)]
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts))
    check(rows, minhash.near_groups(frame(spark, rows)).collect())


def test_no_rows(nothing):
    assert minhash.near_groups(nothing).collect() == []


def test_own_numbers(spark):
    rows = [(1, prose(1, 20)), (2, prose(1, 20)), (3, "x y")]
    docs = frame(spark, rows).withColumn("mine", F.col("doc_id") * 10)
    got = minhash.near_groups(docs, number_col="mine").collect()
    assert sorted((r["row"], r["component_id"], r["kept"]) for r in got) == [(10, 1, True), (20, 1, False), (30, 3, True)]


def test_every_bin_fills_and_agreement_follows_similarity():
    few = list(minhash.shingle_sets(pa.array(["a b c d e f", "x"])))
    full = minhash.sketches(few)
    assert (full != minhash._EMPTY).all()
    draw = np.random.default_rng(3)
    for share in (0.5, 0.75, 0.9):
        common = draw.integers(0, 2**63, int(2000 * share), dtype=np.uint64)
        sets = [np.unique(np.concatenate([common, draw.integers(0, 2**63, 2000 - len(common), dtype=np.uint64)])) for _ in range(2)]
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        a, b = minhash.sketches(sets)
        assert abs((a == b).mean() - true) < 5 * (true * (1 - true) / minhash.COORDINATES) ** 0.5


@pytest.mark.parametrize("links", [[], [(2, 1)], [(n, n + 1) for n in range(20)] + [(30, 31), (31, 33), (40, 33), (5, 5)]])
def test_components(spark, links):
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).rows.collect())
    if not links:
        assert got == {}
    elif len(links) == 1:
        assert got == {2: 1}
    else:
        assert got == {**{n: 0 for n in range(1, 21)}, 31: 30, 33: 30, 40: 30}


def around_a_template(count, words=120, run=6):
    """Texts that share most words with one template: most pairs have a similarity of about 0.4, none is linked."""
    base = prose(4000, words).split()
    pick = random.Random(11)
    out = []
    for m in range(count):
        text = list(base)
        first = pick.randrange(words)
        for at in range(run):
            text[(first + at) % words] = f"own{m}x{at}"
            text[(first + words // 2 + at) % words] = f"own{m}y{at}"
        for at in pick.sample(range(words), 2):
            text[at] = f"own{m}z{at}"
        out.append(" ".join(text))
    return out


def test_weak_resemblance_does_not_compare_all_pairs():
    """20,000 texts around one template: pairs that meet in a bucket, each as often as they do."""
    count = 20_000
    sets = list(minhash.shingle_sets(pa.array(around_a_template(count))))
    draw = np.random.default_rng(1).integers(0, count, (3000, 2))
    like = [len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) for a, b in draw if a != b]
    assert 0.35 < np.mean(like) < 0.5
    keys = np.concatenate([minhash.band_keys(minhash.sketches(sets[n : n + 1000])) for n in range(0, count, 1000)])
    _, sizes = np.unique(keys.ravel(), return_counts=True)
    met, pairs = (sizes * (sizes - 1) // 2).sum(), count * (count - 1) / 2
    expected = minhash.BANDS * np.mean(np.array(like) ** minhash.ROWS)
    assert met / pairs < 0.4 and met / pairs < 1.5 * expected


def test_texts_around_a_template(spark):
    rows = list(enumerate(around_a_template(150)))
    check(rows, minhash.near_groups(frame(spark, rows)).collect())


@pytest.mark.parametrize("block", [2, 1024])
def test_large_buckets_are_cut_into_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = [t for n in range(3) for t in family(50 + n, 14, changed=5)]
    rows = list(enumerate(texts))
    check(rows, minhash.near_groups(frame(spark, rows)).collect())


def test_links_between_sets_of_all_sizes():
    draw = np.random.default_rng(8)
    sets = [np.unique(draw.integers(0, 60, draw.integers(1, 50)).astype(np.uint64)) for _ in range(80)]
    some, others = sets[:30], sets[30:]
    of_some, of_others = np.arange(30), np.arange(100, 150)
    for percent in (30, 60, 75, 100):
        want = {
            (n, m)
            for n, x in enumerate(some)
            for m, y in enumerate(others)
            if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))
        }
        assert set(minhash.links_between(some, of_some, others, of_others, percent)) == want
