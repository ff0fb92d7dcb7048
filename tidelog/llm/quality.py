"""Quality of documents: a linear classifier on n-gram indicators scaled by naive Bayes ratios.

Indicators: words and word shapes (letters, digits and marks of a word, runs of the same kind as one),
shapes also in pairs, hashed into a fixed number of places. Each is scaled by the logarithm of how much
more often it occurs in documents of class 1 than of class 0. Those counts are taken over all labelled
rows by Spark. On the scaled vectors, brought to length 1, a linear hinge-loss model is fitted by dual
coordinate descent, and a logistic curve turns its margin into a score between 0 and 1.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from tidelog.llm.storage import store
from tidelog.llm.words import Words, mixed, pieces, words_of

SHAPE_PLACES = 1 << 16
WORD_PLACES = 1 << 18
PLACES = SHAPE_PLACES + WORD_PLACES
#: labelled rows that the linear model is fitted on at most; the counts take all
MOST_FITTED = 10_000

_MARK = 65535

_KIND = np.arange(256, dtype=np.uint8)
_KIND[ord("a") : ord("z") + 1] = ord("a")
_KIND[ord("A") : ord("Z") + 1] = ord("A")
_KIND[ord("0") : ord("9") + 1] = ord("0")
_KIND[128:] = ord("a")


def shape_marks(words: Words) -> np.ndarray:
    """A fingerprint of each word's shape."""
    if len(words.start) == 0:
        return np.zeros(0, dtype=np.uint64)
    kind = _KIND[words.data].astype(np.uint64)
    keep = np.ones(len(kind), dtype=bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[words.start] = True
    at = np.flatnonzero(keep)
    begin, end = np.searchsorted(at, words.start), np.searchsorted(at, words.end)
    inside = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at)))) if begin[0] == 0 else None
    if inside is None:  # blanks before the first word
        whole = np.concatenate([[0], begin])
        inside = np.arange(len(at)) - np.repeat(whole, np.diff(np.append(whole, len(at))))
    value = mixed(kind[at] + np.uint64(256) * inside.astype(np.uint64))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(value)])
    return mixed(sums[end] - sums[begin], 5)


def counted_indicators(texts: pa.Array) -> Iterator[tuple[np.ndarray, int]]:
    """For each text the sorted distinct places of its n-grams, and its number of words."""
    for low, high in pieces(texts):
        words = words_of(texts.slice(low, high - low), lower=True)
        shape = shape_marks(words)
        single = (mixed(shape, 1) % np.uint64(SHAPE_PLACES)).astype(np.int32)
        pair = mixed(shape[:-1] * np.uint64(3) + shape[1:], 2) if len(shape) else shape
        pair = (pair % np.uint64(SHAPE_PLACES)).astype(np.int32)
        word = (mixed(words.mark, 3) % np.uint64(WORD_PLACES)).astype(np.int32) + SHAPE_PLACES
        for n in range(high - low):
            a, b = words.first[n], words.first[n + 1]
            yield np.unique(np.concatenate([single[a:b], pair[a : max(a, b - 1)], word[a:b]])), int(b - a)


def indicators(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted distinct places of its n-grams."""
    return (places for places, _ in counted_indicators(texts))


def packed(rows: list[np.ndarray]) -> pa.Array:
    """Sorted places as 16-bit gaps, which take half the room of the places and less when compressed.

    A gap of 65535 or more is as many marks of that value as fit, and the rest.
    """
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, dtype=np.int64)
    gaps = np.diff(flat, prepend=0)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1][sizes > 0]
    gaps[first] = flat[first]
    marks, rest = np.divmod(gaps, _MARK)
    at = np.cumsum(marks + 1) - 1
    units = np.full(int(at[-1]) + 1 if len(at) else 0, _MARK, dtype="<u2")
    units[at] = rest
    ends = np.concatenate([[0], at + 1])[np.concatenate([[0], np.cumsum(sizes)])] * 2
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(units.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(rows), buffers)


def places_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of a column of packed places."""
    for row in column:
        units = np.frombuffer(row.as_buffer(), dtype="<u2")
        yield np.cumsum(units, dtype=np.int64)[units != _MARK].astype(np.int32)


def place_counts(rows: DataFrame, column: str, classes: Sequence) -> np.ndarray:
    """How many rows of each class (down) have each place (across); each task counts its own first."""
    k = len(classes)
    names = ["place", *(f"n{c}" for c in range(k))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((k, PLACES), dtype=np.int64)
        number = {name: c for c, name in enumerate(classes)}
        for batch in batches:
            found: list[list] = [[] for _ in classes]
            for name, places in zip(batch.column(0).to_pylist(), places_of(batch.column(1)), strict=True):
                found[number[name]].append(places)
            for c, lists in enumerate(found):
                if lists:
                    table[c] += np.bincount(np.concatenate(lists), minlength=PLACES)
        used = np.flatnonzero(table.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(n) for n in table[:, used])], names=names)

    parts = rows.select(column, "places").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
    # PLACES rows at most
    counted = parts.groupBy("place").agg(*[F.sum(n).alias(n) for n in names[1:]]).toArrow()
    table = np.zeros((k, PLACES), dtype=np.int64)
    for c, n in enumerate(names[1:]):
        table[c, np.asarray(counted["place"])] = np.asarray(counted[n])
    return table


def with_indicators(rows: DataFrame, text_col: str = "text", count: bool = False) -> DataFrame:
    """The rows with `places` (packed) instead of the text, and with `count` also `n_tokens`, the number of words.

    What needs the texts of documents that are known by id only is joined to these rows: they are short, and so
    no text is shuffled. Columns with these names are replaced.
    """
    made = ["places", *(["n_tokens"] if count else [])]
    others = [c for c in rows.columns if c != text_col and c not in made]
    schema = rows.select(*others).schema.add("places", BinaryType())
    schema = schema.add("n_tokens", LongType()) if count else schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(counted_indicators(batch.column(len(others))))
            columns = [packed([p for p, _ in found])]
            if count:
                columns.append(pa.array([n for _, n in found], type=pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *columns], names=[f.name for f in schema])

    return rows.select(*others, text_col).mapInArrow(run, schema)


def dual_coordinate_descent(
    rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray, cost: float = 1.0, rounds: int = 12
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model on the scaled indicators of each row, at length 1.

    One multiplier for each row, between 0 and `cost`, is set to its best value while the others stay
    (Hsieh et al. 2008). The bias is one more indicator that all rows have.
    """
    weights, bias = np.zeros(len(scale)), 0.0
    values = []
    for places in rows:
        value = scale[places]
        values.append(value / max(1e-12, float(np.sqrt(value @ value))))
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(rounds):
        most = 0.0
        for n in order.permutation(len(rows)):
            places, value, sign = rows[n], values[n], signs[n]
            gradient = sign * (weights[places] @ value + bias) - 1
            own = 2.0 if len(places) else 1.0
            new = min(max(alpha[n] - gradient / own, 0.0), cost)
            step = (new - alpha[n]) * sign
            if step:
                weights[places] += step * value
                bias += step
                most = max(most, abs(step))
                alpha[n] = new
        if most < 1e-3:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of class 1 by margin (Newton steps, a little regularised)."""
    slope, offset = 1.0, 0.0
    positive, negative = labels.sum(), len(labels) - labels.sum()
    goal = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        weight = p * (1 - p) + 1e-9
        gradient = np.array([((p - goal) * margins).sum() + 1e-3 * slope, (p - goal).sum()])
        cross = (weight * margins).sum()
        hessian = np.array([[(weight * margins**2).sum() + 1e-3, cross], [cross, weight.sum()]])
        step = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(offset)


@dataclass
class QualityModel:
    """Weights on unscaled indicators; the scale is needed for the length of a row."""

    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, rows: Iterable[np.ndarray]) -> np.ndarray:
        out = []
        for places in rows:
            value = self.scale[places]
            length = max(1e-12, float(np.sqrt(value @ value)))
            out.append(float(self.weights[places] @ value) / length + self.bias)
        return np.array(out)

    def scores(self, rows: Iterable[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(rows) + self.offset, -30, 30)))


def fit_quality(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
    places_col: str | None = None,
    most_fitted: int = MOST_FITTED,
    smoothing: float = 1.0,
    cost: float = 1.0,
) -> QualityModel:
    """Fit on labelled rows; those with a null or another label than 0 and 1 are left out.

    `places_col` names a column of `with_indicators` that is taken instead of the text.
    Counts are taken over all rows. The linear model takes the `most_fitted` rows that come first in
    the order of a hash of their id: four fifths for the weights and one for the logistic curve.
    Without rows of both classes every text scores their share of class 1 (one half without any row).
    """
    labelled = rows.filter(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"),
        F.col(label_col).cast("int").alias("label"),
        F.col(places_col).alias("places") if places_col else F.col(text_col).alias("text"),
    )
    kept = store(labelled if places_col else with_indicators(labelled), "labelled")
    classes = {r["label"]: r["n"] for r in kept.rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        share = float(max(classes)) if classes else 0.5
        flat = np.zeros(PLACES)
        p = min(max(share, 1e-6), 1 - 1e-6)
        kept.drop()
        return QualityModel(flat, flat, 0.0, 1.0, float(np.log(p / (1 - p))))
    zeros, ones = place_counts(kept.rows, "label", [0, 1]) + smoothing
    scale = np.log(ones / ones.sum()) - np.log(zeros / zeros.sum())
    order = [F.xxhash64(F.col("id").cast("string")), F.col("id")]
    chosen = kept.rows.select("id").distinct().orderBy(*order).limit(most_fitted)
    sample = kept.rows.join(F.broadcast(chosen), "id").select("id", "label", "places")
    # an id that is repeated may have many rows
    sample = sample.orderBy(*order, F.xxhash64("label", "places")).limit(most_fitted).toArrow()
    kept.drop()
    # an order that does not depend on how the rows came in
    found = sample["id"].to_numpy()
    taken = np.lexsort((found, pd.util.hash_array(found)))[:most_fitted]
    labels = sample["label"].to_numpy()[taken]
    every = list(places_of(sample["places"]))
    places = [every[n] for n in taken]
    held = np.arange(len(places)) % 5 == 4
    if len(set(labels[~held])) < 2 or len(set(labels[held])) < 2:
        held = np.zeros(len(places), dtype=bool)
    fitted = np.flatnonzero(~held)
    weights, bias = dual_coordinate_descent(
        [places[n] for n in fitted], np.where(labels[fitted] == 1, 1.0, -1.0), scale, cost
    )
    model = QualityModel(scale, weights, bias, 1.0, 0.0)
    curve = np.flatnonzero(held) if held.any() else fitted
    model.slope, model.offset = logistic_curve(model.margins([places[n] for n in curve]), labels[curve])
    return model


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    text_col: str = "text",
    score_col: str = "score",
    keep_text: bool = False,
    places_col: str | None = None,
) -> DataFrame:
    """The rows with a score for the whole text, which is left out unless `keep_text`.

    A null text scores as an empty one. A column with the name of the score is replaced. With
    `places_col`, a column of `with_indicators`, that stands for the text.
    """
    text_col = places_col or text_col
    others = [c for c in docs.columns if c not in (text_col, score_col)]
    sent = [*others, text_col]
    schema = docs.select(*(sent if keep_text else others)).schema.add(score_col, "double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(others))
            scores = pa.array(model.scores((places_of if places_col else indicators)(column)), type=pa.float64())
            kept = batch.columns if keep_text else batch.columns[: len(others)]
            yield pa.RecordBatch.from_arrays([*kept, scores], names=[f.name for f in schema])

    return docs.select(*sent).mapInArrow(run, schema)


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, column: str = "text") -> DataFrame:
    """(doc_id, text or another column, label) of labelled documents outside the held-out fold; labels repeated for an id count once."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
    known = known.agg(F.max("quality").alias("label")).filter(fold("doc_id", folds) != held)
    return docs.select("doc_id", column).join(known, "doc_id")


def learned(docs: DataFrame, labels: DataFrame) -> tuple[QualityModel, DataFrame]:
    """(the model learned from the labelled documents, doc_id and indicators of every row of `docs`).

    The texts are read once, in place; labels meet the indicators.
    """
    known = store(with_indicators(docs.select("doc_id", "text")), "indicators").rows
    return fit_quality(training_rows(known, labels, column="places"), places_col="places"), known
