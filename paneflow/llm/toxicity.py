"""Toxicity by ordinal regression: severity grades from sparse text features.

Grades come from the labels: 0 for not toxic, 1 for toxic, 2 for toxic and of low quality. The
model is a cumulative link: P(grade >= k) = sigmoid(score - threshold_k), one score for all grades
and thresholds in order. The score is a weighted sum over the whole words that a document has, as
hashed features, none of them negative; a form of a toxic word that the labels do not hold has no weight. It is fitted on at most ``TRAIN_ROWS`` labelled documents, those of least hash, by proximal
gradient descent: the ``SELECTED`` features that are most surely more frequent in toxic documents, with an L1
penalty. Every document is then scored, whole.

Cases: a null text or one without words has the score 0, which the thresholds turn into the
severity of a document without signs; without labels of both kinds every severity is 0; of
several labels of an id the highest grade counts; a null label is 0; repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import Words, chunks, mixed, words_of

#: Hashed features; labelled documents and features used for the fit.
FEATURES, TRAIN_ROWS, SELECTED = 1 << 20, 20_000, 512
#: A feature must occur in so many of the documents used for the fit.
LEAST_ROWS = 4
GRADES, PENALTY, STEPS = 3, 0.00001, 1500
#: Standard errors by which a feature must be more frequent in toxic than in other documents. Of the many
#: rare words some differ by four or five by chance.
SIGNAL = 5.0


class Model(NamedTuple):
    weights: np.ndarray  # by feature
    thresholds: np.ndarray  # GRADES - 1, ascending


def features_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(doc, feature): the features that each document has."""
    f = (words.hashes % np.uint64(FEATURES)).astype(np.int64)
    key = np.unique(words.doc * FEATURES + f)
    return key // FEATURES, key % FEATURES


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def one_of_each(rows: list[np.ndarray]) -> np.ndarray:
    """Places of documents without their near copies, whose own words would look like signs.

    Copies agree in the least hashes, in two orders, of features that under a twentieth of all have.
    """
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    rare = np.bincount(flat, minlength=FEATURES) <= max(1, len(rows) // 20)
    keys = np.full((len(rows), 2), np.arange(len(rows))[:, None] - len(rows), np.int64)
    for k, row in enumerate(rows):
        own = row[rare[row]].astype(np.uint64)
        if len(own):
            keys[k] = [(mixed(own * np.uint64(2) + np.uint64(seed)) >> np.uint64(1)).min() for seed in (0, 1)]
    return np.sort(np.unique(keys, axis=0, return_index=True)[1])


def fit(rows: list[np.ndarray], grades: np.ndarray) -> Model:
    """A model of documents, each as its features, and their grades."""
    kept = one_of_each(rows)
    rows, grades = [rows[k] for k in kept], grades[kept]
    toxic = grades > 0
    none = Model(np.zeros(FEATURES, np.float32), np.full(GRADES - 1, np.inf))
    if not toxic.any() or toxic.all():
        return none
    lengths = np.array([len(r) for r in rows])
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), lengths)
    every = np.bincount(flat, minlength=FEATURES)
    within = np.bincount(flat[toxic[owner]], minlength=FEATURES)
    n, m = len(rows), int(toxic.sum())
    rate = every / n
    spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-9) * (1 / m + 1 / max(1, n - m)))
    signal = (within / m - (every - within) / max(1, n - m)) / spread
    signal[every < LEAST_ROWS] = 0
    chosen = np.sort(np.argsort(-signal, kind="stable")[:SELECTED])
    chosen = chosen[signal[chosen] >= SIGNAL]
    place = np.full(FEATURES, -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((n, len(chosen)), np.float32)
    known = place[flat] >= 0
    x[owner[known], place[flat[known]]] = 1
    reach = np.stack([grades >= k for k in range(1, GRADES)], 1).astype(np.float32)
    # odds of each grade or more to start from
    thresholds = -np.log((reach.sum(0) + 0.5) / (n - reach.sum(0) + 0.5))
    # toxic documents weigh as much as the others: missing one is as bad as a false alarm in that share
    balance = np.where(toxic, n / (2 * m), n / (2 * (n - m)))[:, None].astype(np.float32)
    w, ahead, momentum = np.zeros(len(chosen)), np.zeros(len(chosen)), 1.0
    step = 4.0 / max(1.0, float((x**2).sum(1).mean()) * (GRADES - 1))
    for _ in range(STEPS):
        p = _sigmoid((x @ ahead.astype(np.float32))[:, None] - thresholds)
        miss = (p - reach) * balance  # the thresholds share the weights
        new = ahead - step * (x.T @ miss.sum(1).astype(np.float32)) / n
        new = np.maximum(new - step * PENALTY, 0)  # signs of toxicity only
        thresholds = np.maximum.accumulate(thresholds + step * miss.mean(0))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
    weights = np.zeros(FEATURES, np.float32)
    weights[chosen] = w
    return Model(weights, thresholds)


def scores(model: Model, words: Words, n_docs: int) -> np.ndarray:
    weight = model.weights[(words.hashes % np.uint64(FEATURES)).astype(np.int64)]
    known = np.nonzero(weight)[0]
    doc, f = features_of(Words(words.hashes[known], words.doc[known], words.ends))
    return np.bincount(doc, model.weights[f], n_docs)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, flat, offsets in chunks(batch.column(1)):
            doc, f = features_of(words_of(flat, offsets))
            cut = np.searchsorted(doc, np.arange(last - first + 1))
            rows = [f[a:b].astype("<i4").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(rows, pa.binary())], ["grade", "features"])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """The model of the ``rows`` labelled documents of least hash."""
    toxic, good = F.coalesce(F.col("toxic"), F.lit(0)), F.coalesce(F.col("quality"), F.lit(1))
    grade = F.when(toxic > 0, F.when(good > 0, 1).otherwise(2)).otherwise(0)
    graded = labels.select(F.col("doc_id").cast("long").alias("id"), grade.alias("grade")).filter("id is not null").groupBy("id").agg(F.max("grade").alias("grade"))
    sample = graded.orderBy(F.xxhash64("id"), "id").limit(rows)
    # at most ``rows`` pairs of numbers
    pairs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    found = pairs.select("grade", "text").mapInArrow(_features, "grade int, features binary").toPandas()
    return fit([np.frombuffer(x, "<i4").astype(np.int64) for x in found["features"]], found["grade"].to_numpy(np.int64))


def _scorer(held):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for first, last, flat, offsets in chunks(batch.column(1)):
                s = scores(model, words_of(flat, offsets), last - first)
                p = _sigmoid(s[:, None] - model.thresholds) * np.isfinite(model.thresholds)
                columns = [p[:, k] for k in range(GRADES - 1)] + [p.sum(1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *map(pa.array, columns), pa.array((p >= 0.5).sum(1), pa.int32()), pa.array(p[:, 0] >= 0.5)],
                    ["doc_id", "p_toxic", "p_severe", "severity", "grade", "toxic"],
                )

    return score


def graded(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, p_toxic, p_severe, severity (expected grade), grade, toxic."""
    # the table of weights has a fixed size
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text, rows))
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return whole.mapInArrow(_scorer(held), "doc_id long, p_toxic double, p_severe double, severity double, grade int, toxic boolean")
