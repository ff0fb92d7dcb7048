import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame, odd_texts
from tidelog.llm import mixing
from tidelog.llm.storage import store

DIR = "/root/testdata/sf0.01"


def plain_fit(p, tokens, goal, budget, steps=200_000):
    """Projected gradient without momentum, run very long."""
    rate = np.ones(len(p))
    gram = (p * tokens[:, None]).T @ p / budget
    length = 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(steps):
        miss = (rate * tokens) @ p / budget - goal
        if np.abs(miss).max() < 1e-9:
            break
        rate = np.maximum(0, rate - length * (p @ miss))
    return rate


def fitted(spark, p, tokens, targets, budget=1.0):
    rows = [(n, int(t), [float(x) for x in q]) for n, (t, q) in enumerate(zip(tokens, p, strict=True))]
    kept = store(spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, posterior array<double>"), "test")
    steps, totals = mixing.fit_rates(kept, targets, budget)
    rates = mixing.with_rates(kept, steps, len(targets)).orderBy("doc_id").toPandas()["rate"].to_numpy()
    return rates, totals


def test_totals_match_targets_and_rates_are_not_negative(spark):
    draw = np.random.default_rng(2)
    p = draw.dirichlet([0.4, 0.4, 0.4], 200)
    tokens = draw.integers(1, 500, 200)
    for targets in ([0.5, 0.3, 0.2], [0.05, 0.15, 0.8]):
        rates, totals = fitted(spark, p, tokens, targets)
        assert (rates >= 0).all()
        want = plain_fit(p, tokens, np.array(targets), tokens.sum())
        assert np.allclose(totals / tokens.sum(), (want * tokens) @ p / tokens.sum(), atol=1e-3)
        assert np.allclose((rates * tokens) @ p, totals)


def test_a_target_out_of_reach_is_met_as_closely_as_can_be(spark):
    p = np.array([[0.9, 0.1], [0.6, 0.4]])
    tokens = np.array([100, 100])
    rates, totals = fitted(spark, p, tokens, [0.1, 0.9])
    want = plain_fit(p, tokens, np.array([0.1, 0.9]), 200)
    assert rates[0] == 0 and np.allclose(totals, (want * tokens) @ p, rtol=0.01)


@pytest.mark.parametrize("supply", [(0.97, 0.02, 0.01), (0.995, 0.003, 0.002), (0.998, 0.001, 0.001)])
def test_targets_of_rare_domains_are_met(spark, supply):
    draw = np.random.default_rng(4)
    of = np.repeat([0, 1, 2], np.round(np.array(supply) * 2000).astype(int))
    p = np.where(np.arange(3) == of[:, None], 0.998, 0.001)
    tokens = draw.integers(1, 500, len(of))
    for targets, budget in ([0.9, 0.07, 0.03], 1.0), ([0.98, 0.005, 0.015], 1.1):
        rates, totals = fitted(spark, p, tokens, targets, budget)
        assert (rates >= 0).all() and np.allclose((rates * tokens) @ p, totals)
        assert np.allclose(totals / (budget * tokens.sum()), targets, rtol=0.001)


def test_a_missed_target_is_said(spark):
    p = np.array([[0.9, 0.1], [0.6, 0.4]])
    with pytest.warns(UserWarning, match="missed by"):
        fitted(spark, p, np.array([100, 100]), [0.1, 0.9])


def test_tables(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{n}.parquet") for n in ("documents", "labels"))
    rates, totals = mixing.mixed_rates(docs, labels)
    rows = rates.join(labels, "doc_id").toPandas()
    whole = sum(totals.values())
    for domain, share in mixing.TARGETS.items():
        assert abs(totals[domain] / whole - share) < 0.005
    clean = rows[(rows["quality"] == 1) & (rows["toxic"] == 0)]
    assert (clean["posterior"].map(lambda p: p[0]) > 0.5).mean() > 0.97
    low = rows[(rows["quality"] == 0) & (rows["toxic"] == 0)]
    assert (low["posterior"].map(lambda p: p[1]) > 0.5).mean() > 0.8


def test_odd_texts_and_labels(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(4, 1, 0), (4, 1, 0), (7, 0, 0), (12, 1, 1), (None, 1, 1), (8, None, 0), (1, 0, None)],
        "doc_id bigint, quality int, toxic int",
    )
    rates, totals = mixing.mixed_rates(odd, labels)
    got = rates.collect()
    assert len(got) == len(odd_texts()) and all(r["rate"] >= 0 and abs(sum(r["posterior"]) - 1) < 1e-9 for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mixed_rates(nothing, labels)[0].collect() == []
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {tuple(r["posterior"]) for r in mixing.mixed_rates(odd, none)[0].collect()} == {(1 / 3,) * 3}


def test_copies_are_the_rate_on_average(spark):
    rows = spark.range(20_000).select("id", F.lit(1.3).alias("rate"))
    total, least, most = rows.select(mixing.copies("rate", "id").alias("n")).agg(F.avg("n"), F.min("n"), F.max("n")).first()
    assert abs(total - 1.3) < 0.02 and (least, most) == (1, 2)
    assert frame(spark, [(1, "x")]).select(F.lit(0.0).alias("rate"), "doc_id").select(mixing.copies("rate", "doc_id")).first()[0] == 0
