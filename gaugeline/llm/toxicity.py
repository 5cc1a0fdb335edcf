"""Severity of toxic language by cumulative-link ordinal regression.

Features are the words of a text and their first 4 and 5 bytes (insults are inflected), hashed into
buckets, each with weight 1 + log(count), scaled to length one. One weight vector serves all ordered thresholds: P(grade > k) = logistic(x.w - b_k).
The result is the expected severity, the sum over k of P(grade > k).

Grades come from the labels: a clean document has grade 0; a toxic one has grade 1, 2 or 3 by
terciles of how much of its text consists of words that the labels show to be toxic.

Defined cases: a null or empty text has no features and the severity that the thresholds alone
give, but is never flagged. With no labelled rows, or only one class, every severity is 0 and
nothing is flagged. Labels that are null count as missing; of several labels of one document the
largest holds. Repeated documents each get a result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import appended

BUCKETS = 1 << 18
#: Labelled rows of each class that the fit reads at most, taken by the smallest hash of the id.
FIT_ROWS = 4000
GRADES = 3
#: Sizes of the stems, in bytes.
STEMS = (4, 5)
FLAG_AT = 0.5
#: Characters removed at the edges of a word, so that "word," and "word" are one feature.
EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text, in order of bucket."""
    counts: Counter = Counter()
    for word, n in Counter((text or b"").lower().split()).items():
        word = word.strip(EDGES)
        if word:
            counts[zlib.crc32(word) & (BUCKETS - 1)] += n
            for size in STEMS:
                if len(word) > size:
                    counts[zlib.crc32(word[:size], size) & (BUCKETS - 1)] += n
    if not counts:
        return np.zeros(0, np.int64), np.zeros(0)
    keys = np.fromiter(counts.keys(), np.int64, len(counts))
    weights = 1.0 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    order = np.argsort(keys)
    weights = weights[order]
    return keys[order], weights / np.sqrt(weights @ weights)


@dataclass
class Model:
    weights: np.ndarray
    cuts: np.ndarray

    def passing(self, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        if len(self.cuts) == 0:
            return np.zeros(0)
        return 1.0 / (1.0 + np.exp(self.cuts - self.weights[keys] @ values))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _odds(rows: np.ndarray, keys: np.ndarray, toxic: np.ndarray, prior: float) -> np.ndarray:
    """Log ratio of the shares of toxic and of clean texts that have a word."""
    bad, clean = (np.bincount(keys[mask[rows]], minlength=BUCKETS) for mask in (toxic, ~toxic))
    return np.log((bad + prior) / (toxic.sum() + 2 * prior)) - np.log(
        (clean + prior) / ((~toxic).sum() + 2 * prior)
    )


def _grades(rows: np.ndarray, keys: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grade of each text from its label and the weight of words typical of toxic texts."""
    bad = np.bincount(keys[toxic[rows]], minlength=BUCKETS)
    typical = (_odds(rows, keys, toxic, 0.5) > 2.0) & (bad >= max(3, 0.01 * toxic.sum()))
    size = np.bincount(rows, minlength=len(toxic))
    share = np.bincount(rows, weights=typical[keys], minlength=len(toxic)) / np.maximum(size, 1)
    edges = np.quantile(share[toxic], np.arange(1, GRADES) / GRADES)
    return np.where(toxic, 1 + np.searchsorted(edges, share, side="left"), 0)


def fit_arrays(
    rows: np.ndarray,
    keys: np.ndarray,
    values: np.ndarray,
    grades: np.ndarray,
    weight: np.ndarray,
    steps: int = 300,
    rate: float = 0.3,
    decay: float = 1e-5,
) -> Model:
    """Gradient steps (Adam) on the mean log loss of the cumulative logits.

    Grade g has probability s(b_g) - s(b_(g-1)) with s(b) = logistic(b - x.w); thresholds are kept
    in order by steps that are exponentials.
    """
    levels = int(grades.max())
    used, local = np.unique(keys, return_inverse=True)
    w = np.zeros(len(used))
    base, gaps = np.array([2.0]), np.zeros(max(levels - 1, 0))
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (w, base, gaps)]
    weight = weight / weight.sum()
    at = np.arange(len(grades))
    for step in range(1, steps + 1):
        cuts = base[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(rows, weights=w[local] * values, minlength=len(grades))
        below = np.column_stack(
            [np.zeros(len(grades)), _sigmoid(cuts[None, :] - score[:, None]), np.ones(len(grades))]
        )
        upper, lower = below[at, grades + 1], below[at, grades]
        prob = np.maximum(upper - lower, 1e-12)
        slope_up, slope_low = upper * (1 - upper) / prob, lower * (1 - lower) / prob
        by_score = weight * (slope_up - slope_low)
        by_cut = np.zeros(levels + 2)
        np.add.at(by_cut, grades + 1, -weight * slope_up)
        np.add.at(by_cut, grades, weight * slope_low)
        by_cut = by_cut[1 : levels + 1]
        grad_w = np.bincount(local, weights=by_score[rows] * values, minlength=len(used)) + decay * w
        after = np.cumsum(by_cut[::-1])[::-1]
        grads = (grad_w, np.array([after[0]]), after[1:] * np.exp(gaps))
        for param, grad, (m, v) in zip((w, base, gaps), grads, state):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            ahead = m / (1 - 0.9**step)
            param -= rate * ahead / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    weights = np.zeros(BUCKETS)
    weights[used] = w
    cuts = base[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    return Model(weights, cuts)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    toxic: str = "toxic",
    rows_per_class: int = FIT_ROWS,
) -> Model:
    """Fit on all features of at most `rows_per_class` labelled documents of each class. Classes weigh as much as
    their share among all labels, so thresholds fit the whole table."""
    marked = (
        labels.select(F.col(doc_id).alias("id"), F.col(toxic).alias("toxic"))
        .dropna()
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    shares = {bool(r["toxic"]): r["n"] for r in marked.groupBy(
        (F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return Model(np.zeros(BUCKETS), np.zeros(0))
    chosen = None
    for side in ("toxic > 0", "toxic <= 0"):
        part = marked.filter(side).orderBy(F.xxhash64("id"), "id").limit(rows_per_class)
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 * rows_per_class narrow rows
    read = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), "id"
    )

    def sparse(batches):
        for batch in batches:
            made = [features(t) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id").cast(pa.int64()),
                    "toxic": pa.array([int(x > 0) for x in batch.column("toxic").to_pylist()], pa.int32()),
                    "keys": [k.astype(np.int32).tobytes() for k, _ in made],
                    "vals": [v.astype(np.float32).tobytes() for _, v in made],
                }
            )

    got = (
        read.withColumn("id", F.col("id").cast("long"))
        .mapInArrow(sparse, "id long, toxic int, keys binary, vals binary")
        .toArrow()
        .sort_by([("id", "ascending"), ("keys", "ascending")])
    )
    bad = np.array(got.column("toxic").to_pylist(), bool)
    if len(bad) == 0 or bad.all() or not bad.any():
        return Model(np.zeros(BUCKETS), np.zeros(0))
    keys = [np.frombuffer(k, np.int32) for k in got.column("keys").to_pylist()]
    values = [np.frombuffer(v, np.float32) for v in got.column("vals").to_pylist()]
    rows = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    keys, values = np.concatenate(keys).astype(np.int64), np.concatenate(values).astype(np.float64)
    weight = np.where(bad, shares[True] / bad.sum(), shares[False] / (~bad).sum())
    # Words weigh by how much more toxic texts use them (Wang and Manning, 2012), which keeps few
    # labels from being fitted by chance words.
    odds = _odds(rows, keys, bad, 1.0)
    model = fit_arrays(rows, keys, values * odds[keys], _grades(rows, keys, bad), weight)
    return Model(model.weights * odds, model.cuts)


def score(
    docs: DataFrame, model: Model, text: str = "text", flag_at: float = FLAG_AT
) -> DataFrame:
    """`docs` with `severity` (expected grade, 0 to GRADES), `p_toxic` (that the grade is above 0),
    `grade` (the most likely one) and `is_toxic` (p_toxic of `flag_at` or more)."""
    names, schema = appended(
        docs, {"severity": "double", "p_toxic": "double", "grade": "int", "is_toxic": "boolean"}
    )
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            severity, p_toxic, grade, flag = [], [], [], []
            for value in batch.column(at).cast(pa.large_binary()).to_pylist():
                keys, values = features(value)
                over = model.passing(keys, values)
                chances = -np.diff(np.concatenate([[1.0], over, [0.0]]))
                severity.append(float(over.sum()))
                p_toxic.append(float(over[0]) if len(over) else 0.0)
                grade.append(int(chances.argmax()))
                flag.append(len(keys) > 0 and p_toxic[-1] >= flag_at)
            made = [
                pa.array(severity, pa.float64()),
                pa.array(p_toxic, pa.float64()),
                pa.array(grade, pa.int32()),
                pa.array(flag, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], names=[*batch.schema.names, *names]
            )

    return docs.mapInArrow(run, schema)
