import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame, odd_texts, prose
from tidelog.llm import quality

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit_quality(quality.training_rows(docs, labels))
    scored = quality.score_quality(docs.select("doc_id", "text"), model).join(labels, "doc_id").toPandas()
    held = scored[[zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]]
    assert len(held) > 50
    assert ((held["score"] >= 0.3) == (held["quality"] == 1)).mean() > 0.95
    assert (scored[scored["quality"] == 1]["score"] >= 0.3).mean() > 0.99


def test_odd_texts_and_labels(spark, odd):
    labels = [(i, q) for i, q in [(4, 1), (4, 1), (7, 0), (8, 1), (1, 0), (None, 1), (9, None), (11, 0), (500, 1)]]
    labels = spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id bigint, quality int, toxic int")
    rows = quality.training_rows(odd, labels, folds=1000, held=-1)
    assert sorted(r["doc_id"] for r in rows.collect()) == [1, 4, 7, 8, 11]
    model = quality.fit_quality(rows)
    got = quality.score_quality(odd, model).collect()
    assert len(got) == len(odd_texts()) and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1


@pytest.mark.parametrize("labels, share", [([], 0.5), ([(4, 1)], 1.0), ([(4, 0), (5, 0)], 0.0)])
def test_fewer_than_two_classes(spark, odd, labels, share):
    labels = spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id bigint, quality int, toxic int")
    model = quality.fit_quality(quality.training_rows(odd, labels, folds=1000, held=-1))
    scores = {round(r["score"], 3) for r in quality.score_quality(odd, model).collect()}
    assert scores == {share}


def test_no_rows(nothing, odd, spark):
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit_quality(quality.training_rows(odd, labels, folds=1000, held=-1))
    assert quality.score_quality(nothing, model).collect() == []


def test_dual_coordinate_descent_reaches_the_optimum():
    """The primal and the dual objective meet."""
    draw = np.random.default_rng(1)
    rows = [np.unique(draw.integers(0, 40, 8)).astype(np.int32) for _ in range(60)]
    signs = np.array([1.0 if 3 in r or 5 in r else -1.0 for r in rows])
    scale = draw.normal(size=40) + 2
    w, b = quality.dual_coordinate_descent(rows, signs, scale, cost=0.5, rounds=3000)
    x = np.zeros((60, 41))
    for n, r in enumerate(rows):
        x[n, r] = scale[r] / np.linalg.norm(scale[r])
        x[n, 40] = 1
    full = np.append(w, b)
    primal = 0.5 * full @ full + 0.5 * np.maximum(0, 1 - signs * (x @ full)).sum()
    for _ in range(200):
        other = full + draw.normal(size=41) * 0.05
        assert primal <= 0.5 * other @ other + 0.5 * np.maximum(0, 1 - signs * (x @ other)).sum() + 1e-3


def test_shapes():
    texts = pa.array(["Ab12! cD  x", " Zz99! y", "éa bb"])
    words = quality.words_of(texts)
    marks = quality.shape_marks(words).tolist()
    assert marks[0] == marks[3] and marks[2] == marks[4] == marks[5] == marks[6] != marks[1]


def test_fold(spark):
    got = frame(spark, [(7, "x"), (None, "y")]).select(F.col("doc_id"), quality.fold("doc_id", 5).alias("f")).collect()
    assert {r["doc_id"]: r["f"] for r in got} == {7: zlib.crc32(b"7") % 5, None: None}
    assert prose(1, 2)


def test_packed_places_come_back():
    draw = np.random.default_rng(3)
    rows = [np.unique(draw.integers(0, quality.PLACES, n)).astype(np.int32) for n in (0, 1, 5, 0, 900, 2)]
    rows += [np.array(x, dtype=np.int32) for x in ([0], [65534], [65535], [65536], [0, 65535, 131070, 327679], [])]
    for part in (rows, rows[:1], []):
        got = [x.tolist() for x in quality.places_of(quality.packed(part))]
        assert got == [x.tolist() for x in part]
