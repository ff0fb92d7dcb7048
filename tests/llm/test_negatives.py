import math
import random

import numpy as np
import pytest

from tidelog.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, row bigint, id bigint, score double, anchor boolean"


def table(spark, rows):
    """Vectors with columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, 1, 2, 0.5, True) for r in rows], SCHEMA)


def plain(rows):
    """The same by comparing every anchor with every row."""
    usable = []
    for n, (i, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        usable.append((n, i, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for n, i, label, vector in usable:
        if i is None or i % 50:
            continue
        met = [
            (-min(max(sum(a * b for a, b in zip(vector, v)), -(2**63) + 1), 2**63 - 1), j is None, j or 0, m, l)
            for m, j, l, v in usable
            if m != n
        ]
        met.sort()
        for ps, no_id, j, _, _ in [x for x in met if x[4] == label][:5]:
            inside = [x for x in met if x[4] != label and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:3]
            out += [(i, None if no_id else j, r, None if x[1] else x[2], -ps, -x[0]) for r, x in enumerate(inside, 1)]
    return sorted(out, key=repr)


def got(spark, rows, **options):
    found = negatives.hard_negatives(table(spark, rows).repartition(3), **options).collect()
    return sorted((tuple(r) for r in found), key=repr)


def vectors(seed, n, labels=4, size=6):
    pick = random.Random(seed)
    return [(i, [pick.gauss(0.1, 0.4) for _ in range(size)], pick.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("block", [30, 1 << 20])
def test_beside_all_pairs(spark, block):
    rows = vectors(1, 420)
    want = plain(rows)
    assert len(want) > 50 and got(spark, rows, block_values=block) == want


def test_ties_repeated_rows_and_a_hot_vector(spark):
    """A third of the rows are one vector; scores are few whole numbers, so most are equal."""
    pick = random.Random(2)
    rows = [(i, [pick.choice([0.0, 0.5, 1.0]) for _ in range(3)], pick.randrange(2)) for i in range(200)]
    rows += [(1000 + i, [0.5, 1.0, 0.5], i % 3) for i in range(100)]
    rows += [rows[50], rows[50], rows[51], rows[100]]
    want = plain(rows)
    assert len(want) > 40 and got(spark, rows) == want


def test_odd_rows(spark):
    rows = vectors(3, 120) + [
        (200, None, 1),
        (250, [0.1, None, 0.3], 1),
        (300, [float("nan")] * 6, 1),
        (350, [float("inf")] * 6, 1),
        (400, [0.2] * 6, None),
        (450, [], 1),
        (500, [0.5] * 3, 2),
        (550, [0.5] * 9, 2),
        (None, [0.5] * 6, 2),
        (None, [0.4] * 6, 1),
        (600, [0.0] * 6, 3),
        (650, [-0.5] * 6, 3),
    ]
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("scale", [1.0, 300.0, 1e6, 1e9, 1e18])
def test_scores_of_any_size_are_exact(spark, scale):
    rows = [(i, [x * scale for x in v], label) for i, v, label in vectors(4, 60, labels=2)]
    assert got(spark, rows) == plain(rows)


def test_no_rows_no_anchors_no_positives(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert got(spark, [(50, [1.0], 1), (2, [1.0], 2)]) == []
    assert got(spark, [(50, None, 1)]) == []
