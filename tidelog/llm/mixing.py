"""Document rates that bring a corpus to target weights of its domains.

A classifier fitted on a labelled table gives each document a posterior over the domains. A rate of at
least 0 for each document is then sought such that the expected tokens of each domain, the sum over
documents of rate x tokens x posterior, are the target's share of a token budget. The squared miss is
lowered by projected gradient steps with momentum, from rate 1 for all. The domains' misses are first
scaled by the inverse of the sums of products of posteriors, so that rare domains come as fast as others;
where that does not reach the targets, unscaled steps go to the least squared miss. Steps go on until
each target is met, or no step helps any more; then a warning names what is missed.

The gradient of a document is a product of its posterior and one number for each domain. So a step
sends the driver those few sums, and a task works out a document's rate again from its posterior and
the numbers of the steps so far; nothing has to be kept between steps.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidelog.llm.quality import place_counts, places_of, with_indicators
from tidelog.llm.storage import Stored, store

#: steps go on while so many of them halve the squared miss at least
STEPS = 60
#: share of each target that may be missed
TOLERANCE = 1e-6
#: a text counts as at most so many independent indicators
EVIDENCE = 30.0


class DomainModel:
    """Naive Bayes over indicators: log probability of each place in each domain, and the prior."""

    def __init__(self, domains: Sequence[str], table: np.ndarray, prior: np.ndarray, evidence: float = EVIDENCE):
        self.domains, self.table, self.prior, self.evidence = list(domains), table, prior, evidence

    def posteriors(self, rows: Iterable[np.ndarray]) -> np.ndarray:
        """One row of probabilities for each text; without indicators the prior."""
        out = []
        for places in rows:
            logs = self.prior.copy()
            if len(places):
                logs = logs + self.table[:, places].sum(axis=1) * min(1.0, self.evidence / len(places))
            p = np.exp(logs - logs.max())
            out.append(p / p.sum())
        return np.array(out).reshape(-1, len(self.domains))


def fit_domains(rows: DataFrame, domains: Sequence[str], smoothing: float = 0.5) -> DomainModel:
    """Fit on (places, domain); rows with a null or another domain are left out.

    The counts are taken over all rows. A domain without rows has the prior of half a row.
    """
    known = rows.filter(F.col("domain").isin(list(domains)))
    kept = store(known.select("domain", "places"), "domains")
    found = kept.rows.groupBy("domain").agg(F.count("*").alias("n")).collect()
    table = place_counts(kept.rows, "domain", list(domains)) + smoothing
    kept.drop()
    number = {name: n for n, name in enumerate(domains)}
    table = np.log(table) - np.log(table.sum(axis=1, keepdims=True))
    prior = np.full(len(domains), 0.5)
    for row in found:
        prior[number[row["domain"]]] += row["n"]
    return DomainModel(domains, table.astype(np.float32), np.log(prior / prior.sum()))


def with_posteriors(rows: DataFrame, model: DomainModel) -> DataFrame:
    """Rows with `n_tokens` and `places`; instead of the places they get `posterior`, an array in the order of the domains.

    A column of that name is replaced.
    """
    others = [c for c in rows.columns if c not in ("places", "posterior")]
    schema = rows.select(*others).schema.add("posterior", ArrayType(DoubleType()))
    k = len(model.domains)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.posteriors(places_of(batch.column(len(others)))).ravel()
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * k
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(others)], pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))],
                names=[f.name for f in schema],
            )

    return rows.select(*others, "places").mapInArrow(run, schema)


def replayed(posterior: np.ndarray, steps: Sequence[Sequence[float]]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the given steps, and the point at which the next gradient is taken, which momentum carries on.

    Each step holds what a posterior is multiplied with, and at the end its momentum.
    """
    rate = point = np.ones(len(posterior))
    for *step, momentum in steps:
        new = np.maximum(0.0, point - posterior @ np.asarray(step))
        point = new + momentum * (new - rate)
        rate = new
    return rate, point


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, k)


def _totals(kept: Stored, steps: list[list[float]], k: int) -> np.ndarray:
    """Expected tokens of each domain after some steps: under the rates, and where the next gradient is taken.

    And at the end of both rows the tokens times the square of what the last step moved a rate by.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, k + 1))
        for batch in batches:
            p = _matrix(batch.column(1), k)
            n = np.asarray(batch.column(0), dtype=float)
            rate, point = replayed(p, steps)
            total[:, :k] += np.stack([rate, point]) * n @ p
            total[:, k] += n @ (rate - replayed(p, steps[:-1])[1]) ** 2
        yield pa.RecordBatch.from_arrays([pa.array(total.ravel()), pa.array(np.arange(total.size))], names=["total", "at"])

    sums = kept.rows.select("n_tokens", "posterior").mapInArrow(run, "total double, at bigint")
    found = sums.groupBy("at").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(2 * k + 2)
    for row in found:
        out[row["at"]] = row["total"]
    return out.reshape(2, k + 1)


def fit_rates(
    kept: Stored, targets: Sequence[float], budget: float = 1.0, steps: int = STEPS, tolerance: float = TOLERANCE
) -> tuple[list[list[float]], np.ndarray]:
    """(the steps to replay, expected tokens of each domain at the end).

    `budget` is the tokens aimed at for each token there is. The objective is half the squared miss of the
    domains' shares, scaled by the inverse of the sums of products of posteriors, for which a step's length
    is 1; then without the scale, for which it is the inverse of the largest curvature. Momentum starts anew
    when a step did not lower it. Each ends when every target is met up to the tolerance, a share of it, or when a
    step moves no rate any more, or `steps` steps have not halved the objective; if the targets are not met
    in the end, a warning gives the misses.
    """
    k = len(targets)
    goal = np.asarray(targets, dtype=float) / sum(targets)
    products = [
        F.sum(F.col("n_tokens") * F.col("posterior")[i] * F.col("posterior")[j]).alias(f"p{i}_{j}")
        for i in range(k)
        for j in range(k)
    ]
    row = kept.rows.agg(F.sum("n_tokens").alias("n"), *products).first()
    tokens = float(row["n"] or 0)
    budget *= tokens
    history: list[list[float]] = []
    if not budget:
        return history, np.zeros(k)
    gram = np.array([[row[f"p{i}_{j}"] for j in range(k)] for i in range(k)]) / budget
    plain = np.eye(k) / max(float(np.linalg.eigvalsh(gram)[-1]), 1e-12)
    allowed = tolerance * np.where(goal > 0, goal, 1.0)
    totals = _totals(kept, history, k)
    for scale in (np.linalg.pinv(gram, rcond=1e-9, hermitian=True), plain):
        totals[1] = totals[0]
        if history:
            history[-1][-1] = 0.0
        squares: list[float] = []
        speed = 1.0
        while True:
            miss, ahead = totals[:, :k] / budget - goal
            if (np.abs(miss) <= allowed).all():
                return history, totals[0, :k]
            squares.append(float(miss @ scale @ miss))
            still = len(squares) > 1 and totals[0, k] <= tokens * (1e-3 * tolerance) ** 2
            if still or len(squares) > steps and squares[-1] > squares[-1 - steps] / 2:
                break
            if len(squares) > 1 and squares[-1] >= squares[-2]:
                speed = 1.0
            faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
            history.append([*(scale @ ahead).tolist(), float((speed - 1) / faster)])
            speed = faster
            totals = _totals(kept, history, k)
    missed = ", ".join(f"{100 * m:+.4f} of {100 * g:.4f}" for m, g in zip(miss, goal, strict=True))
    warnings.warn(f"no rates were found that meet the targets; missed by, in % of the tokens: {missed}", stacklevel=2)
    return history, totals[0, :k]


def with_rates(kept: Stored, steps: list[list[float]], k: int) -> DataFrame:
    """The stored rows with `rate`."""
    rows = kept.rows
    schema = rows.select("*").schema.add("rate", DoubleType())
    at = rows.columns.index("posterior")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rates = pa.array(replayed(_matrix(batch.column(at), k), steps)[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, rates], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def copies(rate: str, *key: str) -> Column:
    """A whole number of copies that is `rate` on average: the fraction is decided by a hash of the key."""
    chance = F.pmod(F.xxhash64(*key, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(F.col(rate) + chance).cast("int")


def domain_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """The domain a row of the label table speaks for; null if a label is missing."""
    q, t = F.col(quality), F.col(toxic)
    return F.when(q.isNull() | t.isNull(), None).when(t == 1, "toxic").when(q == 1, "clean").otherwise("low")


#: shares of tokens aimed at
TARGETS = {"clean": 0.90, "low": 0.07, "toxic": 0.03}


def mixed_rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] | None = None,
    others: Sequence[str] = (),
    budget: float = 1.0,
) -> tuple[DataFrame, dict[str, float]]:
    """(doc_id, n_tokens, posterior, rate) and the expected tokens of each domain.

    Every row of `docs` gets a row, repeated rows the same rate. Labels that are repeated for an id
    count once. `others` are columns of `docs` to carry along; the rest is not read. `budget` is the
    tokens aimed at for each token there is. A null text has no tokens, and rates the prior's way.
    Without rows there are no rates; columns of other names that this works with are replaced, not read.
    """
    targets = targets or TARGETS
    domains = list(targets)
    label = labels.filter("doc_id is not null").groupBy("doc_id")
    label = label.agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    # the texts are read once, in place; labels meet the indicators
    counted = store(with_indicators(docs.select(*dict.fromkeys(["doc_id", *others, "text"])), count=True), "indicators")
    known = counted.rows.select("doc_id", "places").join(label.select("doc_id", domain_of().alias("domain")), "doc_id")
    model = fit_domains(known, domains)
    kept = store(with_posteriors(counted.rows, model), "posteriors")
    counted.drop()
    steps, totals = fit_rates(kept, [targets[d] for d in domains], budget)
    return with_rates(kept, steps, len(domains)), dict(zip(domains, totals.tolist(), strict=True))
