"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams: words and pairs of words, and the shapes of words (runs of small letters, capitals
and digits as one sign each, other signs as they are; a word equal to the one before has a shape of its own) with
their pairs and triples, hashed to ``BITS`` bits. Each indicator is scaled by the log of its count ratio between the
classes, rows are scaled to length one, and a linear model is fitted by dual coordinate descent on the hinge loss.
A logistic curve over the margins turns them into scores.

The model is fitted in one task, on at most ``SAMPLE`` rows at any size: one row of each of at most so many labelled
ids, chosen by a hash (of an id's rows the one of the last text in code-point order); every document is scored over its
whole text. Null text is empty; a text without words gets the score of the
bias. Rows of ``labels`` without a label are left out; several labels of one id count as their largest. Without rows
of both classes every score is the share of label 1 (0.5 without any row).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm import words
from pulsegrid.sources.scratch import cut

BITS = 18
#: Labelled rows the model is fitted on, at most.
SAMPLE = 8192
PASSES = 20
ALPHA = 1.0
COST = 1.0

#: Feature numbers of all texts, and each text's bounds among them.
Features = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

#: Classes of bytes in a word's shape: letters 1, capitals 2, digits 3, other signs by themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[[*range(97, 123), *range(128, 256)]] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_AGAIN = np.uint64(0x5DEECE66D5DEECE6)


def _grams(values: np.ndarray, text: np.ndarray, width: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    n = max(0, len(values) - width + 1)
    h = words.mix(words.rolling(values, width, 0xD6E8FEB86659FD93), salt) >> np.uint64(64 - BITS)
    inside = text[:n] == text[width - 1 :][:n]
    return h[inside], text[:n][inside]


def distinct(found: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature and text numbers as each text's features once, in order, and the bounds of the ``n`` texts."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    both = np.concatenate([t.astype(np.uint64) << np.uint64(BITS) | h for h, t in found])
    both.sort()
    both = both[np.r_[True, both[1:] != both[:-1]][: len(both)]]
    where = np.searchsorted(both, np.arange(n + 1, dtype=np.uint64) << np.uint64(BITS))
    return (both & np.uint64((1 << BITS) - 1)).astype(np.int64), where


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts one after the other, each once per text in order, and each text's bounds."""
    found = []
    data, bounds = words.raw(texts)
    starts, ends, text = words.split(data, bounds)
    if len(starts):
        own = words.range_hashes(data, starts, ends)
        sign = _CLASS[data]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] += 1
        np.subtract.at(inside, ends, 1)
        keep = np.cumsum(inside[:-1]).astype(bool)
        new = np.r_[True, sign[1:] != sign[:-1]]
        new[starts] = True
        keep &= new
        upto = np.r_[0, np.cumsum(keep)]
        shape = words.range_hashes(sign[keep], upto[starts], upto[ends])
        again = np.r_[False, (own[1:] == own[:-1]) & (text[1:] == text[:-1])]
        shape[again] = _AGAIN
        found = [_grams(own, text, 1, 1), _grams(own, text, 2, 2), _grams(shape, text, 1, 3), _grams(shape, text, 2, 4), _grams(shape, text, 3, 5)]
    return distinct(found, len(texts))


def dual_descent(rows: list[np.ndarray], ratio: np.ndarray, norm: np.ndarray, y: np.ndarray, cost: np.ndarray, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights times ratios, and bias, of a linear model with hinge loss.

    A row has the value ``ratio / norm`` in each of its features, so it has length one; the bias is a feature more.
    Weights are kept times the ratios: a row's product with them is a sum, and no row's values are held.
    """
    scaled, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(y))
    squared = ratio**2
    random = np.random.default_rng(seed)
    for _ in range(PASSES):
        worst = 0.0
        for i in random.permutation(len(y)):
            own = rows[i]
            slope = y[i] * (scaled[own].sum() / norm[i] + bias) - 1.0
            new = min(max(alpha[i] - slope / 2, 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                worst = max(worst, 2 * abs(new - alpha[i]))
                alpha[i] = new
                scaled[own] += squared[own] * (step / norm[i])
                bias += step
        if worst < 1e-2:
            break
    return scaled, bias


def _curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the margins, by Newton steps on smoothed labels."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    aim = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.c_[margin, np.ones(len(margin))]
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (aim - p) - 1e-3 * (b - [1.0, 0.0]))
        b = b + np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return float(b[0]), float(b[1])


def fit(rows: list[np.ndarray], label: np.ndarray) -> dict[str, np.ndarray]:
    """Weights times ratios, squared ratios, bias and curve."""
    size = 1 << BITS
    y = np.where(label == 1, 1.0, -1.0)
    if len(set(label.tolist())) < 2:
        share = float(np.mean(label == 1)) if len(label) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return {"scaled": np.zeros(size), "squared": np.zeros(size), "tail": np.array([0.0, 0.0, np.log(share / (1 - share))])}
    count = {1.0: np.full(size, ALPHA), -1.0: np.full(size, ALPHA)}
    for own, side in zip(rows, y, strict=True):
        count[side][own] += 1
    # Per row of the class, so that a class of many rows doesn't tip the ratios.
    ratio = np.log(count[1.0] / ((y > 0).sum() + 2 * ALPHA)) - np.log(count[-1.0] / ((y < 0).sum() + 2 * ALPHA))
    squared = ratio**2
    norm = np.array([max(float(np.sqrt(squared[own].sum())), 1e-12) for own in rows])
    cost = np.where(y > 0, COST * len(y) / (2 * (y > 0).sum()), COST * len(y) / (2 * (y < 0).sum()))
    scaled, bias = dual_descent(rows, ratio, norm, y, cost)
    margin = np.array([scaled[own].sum() for own in rows]) / norm + bias
    return {"scaled": scaled, "squared": squared, "tail": np.array([bias, *_curve(margin, y)])}


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, label = [], []
    for batch in batches:
        for own, y in zip(batch.column("own"), batch.column("label").to_pylist(), strict=True):
            rows.append(own.values.to_numpy())
            label.append(y)
    model = fit(rows, np.array(label, int))
    yield pa.RecordBatch.from_arrays([pa.array(list(model)), pa.array([v.astype("<f8").tobytes() for v in model.values()], pa.binary())], names=["name", "numbers"])


def _own(batches: Iterator[pa.RecordBatch], of: Features) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = words.texts_of(batch, "text")
        for lo, hi in words.groups(texts):
            found, where = of(texts[lo:hi])
            lists = pa.ListArray.from_arrays(pa.array(where.astype(np.int32)), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, batch.column("label")[lo:hi], batch.column("place")[lo:hi]], names=["own", "label", "place"])


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, of: Features = features) -> dict[str, np.ndarray]:
    """The model of ``label_col``, from at most ``sample`` rows."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).cast("int").alias("label"))
    known = known.withColumn("place", F.xxhash64("label_id")).orderBy("place", "label_id").limit(sample)
    # At most ``sample`` ids and labels; repeated rows of an id meet as one in each task.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("id") == F.col("label_id"))
    rows = rows.groupBy("label_id", "label", "place").agg(F.max("text").alias("text")).select("text", "label", "place")
    own = cut(rows.mapInArrow(lambda b: _own(b, of), "own array<int>, label int, place long"), "features")
    # The order of the rows decides the order of the descent's steps: reruns agree.
    model = own.coalesce(1).sortWithinPartitions("place").mapInArrow(_fit_rows, "name string, numbers binary").collect()
    return {r.name: np.frombuffer(r.numbers, "<f8") for r in model}


def _scored(batches: Iterator[pa.RecordBatch], model: dict[str, np.ndarray], text_col: str, of: Features) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    scaled, squared = model["scaled"], model["squared"]
    bias, slope, offset = model["tail"]
    for batch in batches:
        texts = words.texts_of(batch, text_col)
        made = [np.zeros(0)]
        for lo, hi in words.groups(texts):
            found, where = of(texts[lo:hi])
            sums = [np.r_[0.0, np.cumsum(x[found])] for x in (scaled, squared)]
            dot, norm = (s[where[1:]] - s[where[:-1]] for s in sums)
            margin = dot / np.sqrt(np.maximum(norm, 1e-24)) + bias
            made.append(1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30))))
        yield batch, np.concatenate(made)


def score(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", of: Features = features) -> DataFrame:
    """``id_col`` and ``score``, one row per row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # three arrays of 2**BITS numbers at most
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, made in _scored(batches, held.value, "text", of):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made)], names=["id", "score"])

    return rows.mapInArrow(scores, f"id {id_type}, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: dict[str, np.ndarray], threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their columns as they are."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, made in _scored(batches, held.value, text_col, features):
            yield batch.filter(pa.array(made >= threshold))

    return docs.mapInArrow(kept, docs.schema)


def held_out(id_col: Column) -> Column:
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))
