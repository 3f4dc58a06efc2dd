"""Quality classifier: cumulative-link (proportional odds) regression on graded ratings.

A text is a set of hashed word features plus a few hashed shape features
(bands of distinct words, signs, capitals and length). One weight vector is
shared by all grades; ordered thresholds cut its score into the grades, with
P(grade <= k) = sigmoid(threshold_k - score). That gives a document's expected
grade and the tail probability of the best grade, by which it is selected.

Grades come from the labels: 0 for poor quality, 1 for fair text that is toxic,
2 for good text that isn't. Training reads a bounded sample of the labelled
rows: SAMPLE rows at most, drawn by hashes; the driver holds their feature
numbers only. Scoring reads each text once and shuffles nothing.

A null or empty text has shape features only. A label without both ratings is
not learned from; repeated labels and copies of a text count once. With no labels,
or only one grade among them, every document is selected with that grade (the
best, if there is none). Other columns are kept or ignored as each function says.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import Memo
from tessera.llm.common import map_texts

GRADES, BUCKETS = 3, 1 << 18
SAMPLE = 8000
#: Evidence, in standard deviations, that a feature must have; held-out rows choose among these.
SCREENS, FOLDS = (5.0, 4.0, 3.5, 3.0, 2.5), 4
#: Weights have a normal prior of this precision.
STEPS, SEARCH_STEPS, RATE, PENALTY = 300, 100, 0.1, 0.1
#: Tail probability of the best grade from which a document is selected.
SELECT_FROM = 0.7
RATED = T.StructType([T.StructField("grade", T.IntegerType()), T.StructField("features", T.ArrayType(T.IntegerType()))])
SCORED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("expected_grade", T.DoubleType()), T.StructField("p_best", T.DoubleType()),
    T.StructField("p_above_worst", T.DoubleType()), T.StructField("selected", T.BooleanType()),
])
_PARTS = re.compile(r"\w+|[^\w\s]+")


def bucket(name: str) -> int:
    return xxhash.xxh32_intdigest(name.encode()) % BUCKETS


class Features:
    """Distinct feature numbers of a text; the numbers of a word are worked out once."""

    def __init__(self):
        self.words = Memo(lambda w: tuple({bucket(p) for p in _PARTS.findall(w.lower())}), weigh=lambda found: 56 + 40 * len(found))

    def __call__(self, text: str) -> np.ndarray:
        words = text.split()
        distinct = set(words)
        n = max(1, len(words))
        signs = sum(map(text.count, "#*$%&|<>!"))
        shapes = {
            f" distinct {10 * len(distinct) // n}", f" signs {min(5, 5 * signs // n)}", f" length {len(words).bit_length()}",
            f" capitals {5 * sum(map(str.isupper, distinct)) // max(1, len(distinct))}",
        }
        found = set(chain.from_iterable(map(self.words.__getitem__, distinct)))
        found.update(map(bucket, shapes))
        return np.fromiter(found, dtype=np.int32, count=len(found))


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray
    only: int | None = None  # the one grade there was to learn


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Rows(NamedTuple):
    """Rated rows as flat arrays: the grade of each row, and (feature, row) of each feature that a row has."""

    grades: np.ndarray
    flat: np.ndarray
    owner: np.ndarray

    def of(self, chosen: np.ndarray) -> Rows:
        place = np.cumsum(chosen) - 1
        held = chosen[self.owner]
        return Rows(self.grades[chosen], self.flat[held], place[self.owner[held]])


def scores(weights: np.ndarray, rows: Rows) -> np.ndarray:
    return np.bincount(rows.owner, weights[rows.flat], minlength=len(rows.grades))


def edge_probabilities(score: np.ndarray, cuts: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(grade <= own) and P(grade < own) of each row."""
    edges = np.concatenate(([-np.inf], cuts, [np.inf]))
    upper, lower = sigmoid(edges[grades + 1] - score), sigmoid(edges[grades] - score)
    upper[grades == GRADES - 1], lower[grades == 0] = 1.0, 0.0
    return upper, lower


def loss(model: Model, rows: Rows) -> float:
    """Mean negative log-likelihood."""
    upper, lower = edge_probabilities(scores(model.weights, rows), model.thresholds, rows.grades)
    return float(-np.log(np.maximum(upper - lower, 1e-9)).mean())


def evidence(rows: Rows) -> np.ndarray:
    """Each feature's score statistic at zero weights, in standard deviations of chance."""
    grades = rows.grades
    at = np.concatenate(([0.0], np.cumsum(np.bincount(grades, minlength=GRADES)) / len(grades)))
    residual = 1 - at[grades] - at[grades + 1]  # the likelihood's slope in the score, for each row
    residual = residual - residual.mean()
    n = np.bincount(rows.flat, minlength=BUCKETS)
    total = np.bincount(rows.flat, residual[rows.owner], minlength=BUCKETS)
    return np.abs(total) / np.sqrt(np.maximum(residual.var() * n * (1 - n / len(grades)), 1e-9))


def learn(rows: Rows, told: np.ndarray, steps: int = STEPS) -> Model:
    """Full-batch Adam on the penalised likelihood, over the features told (a truth value for each bucket)."""
    grades, n = rows.grades, len(rows.grades)
    told = told[rows.flat]
    used, flat = np.unique(rows.flat[told], return_inverse=True)
    own = Rows(grades, flat, rows.owner[told])
    # thresholds as a first one and log gaps keep their order
    share = np.clip(np.array([(grades <= k).mean() for k in range(GRADES - 1)]), 0.01, 0.99)
    start = np.log(share / (1 - share))
    theta = np.concatenate(([start[0]], np.log(np.maximum(np.diff(start), 0.1)), np.zeros(len(used))))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        gaps = np.exp(theta[1 : GRADES - 1])
        cuts = theta[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        weights = theta[GRADES - 1 :]
        upper, lower = edge_probabilities(scores(weights, own), cuts, grades)
        p = np.maximum(upper - lower, 1e-9)
        d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
        d_score = (d_upper - d_lower) / n
        d_cuts = np.array([(d_lower[grades == k + 1].sum() - d_upper[grades == k].sum()) / n for k in range(GRADES - 1)])
        d_gaps = np.array([d_cuts[k:].sum() for k in range(1, GRADES - 1)]) * gaps
        gradient = np.concatenate(([d_cuts.sum()], d_gaps, np.bincount(flat, d_score[own.owner], minlength=len(used)) + PENALTY / n * weights))
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        rate = RATE * max(0.02, 1 - step / steps)
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[used] = theta[GRADES - 1 :]
    return Model(weights, theta[0] + np.concatenate(([0.0], np.cumsum(np.exp(theta[1 : GRADES - 1])))))


def best_screen(rows: Rows) -> float:
    """The screen whose models give the least loss on rows that they didn't see, each FOLDS-th row in turn."""
    fold, losses = np.arange(len(rows.grades)) % FOLDS, dict.fromkeys(SCREENS, 0.0)
    for k in range(FOLDS):  # one after the other: the driver holds one fold's copy of the rows
        seen, held = rows.of(fold != k), rows.of(fold == k)
        if len(seen.grades) and len(held.grades):
            strength = evidence(seen)
            for s in SCREENS:
                losses[s] += loss(learn(seen, strength > s, SEARCH_STEPS), held) * len(held.grades)
    return min(SCREENS, key=losses.get)


def fit(rated: list[tuple[int, np.ndarray]]) -> Model:
    """The model of rated texts (grade, features), from zero weights: the same rows in one order give the same model.

    Copies of a text teach once. Which features count is settled by their
    evidence: without a screen a sample smaller than its vocabulary is learned
    by heart from words that say nothing, and one screen for all sizes would
    leave a small sample without any. So the screen is the one of SCREENS that
    does best on held-out rows.
    """
    rated = list({(g, f.tobytes()): (g, f) for g, f in rated}.values())
    grades = np.array([g for g, _ in rated], dtype=np.int64)
    if len(set(grades.tolist())) < 2:
        return Model(np.zeros(BUCKETS), np.zeros(GRADES - 1), int(grades[0]) if len(grades) else GRADES - 1)
    flat = np.concatenate([f for _, f in rated]).astype(np.int64)
    rows = Rows(grades, flat, np.repeat(np.arange(len(rated)), [len(f) for _, f in rated]))
    return learn(rows, evidence(rows) > best_screen(rows))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from documents (doc_id, text) and labels (doc_id, quality, toxic).

    About sample labelled ids are drawn by a hash; of the rows that join them,
    repeated ids and all, those with the sample least hashes are taken.
    """
    grade = F.when(F.col("quality") < 1, 0).when(F.col("toxic") > 0, 1).otherwise(2).cast("int")
    rated = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))
    share = min(1.0, sample / max(1, rated.agg(F.approx_count_distinct("doc_id", 0.02)).first()[0]))
    drawn = rated.filter(F.pmod(F.xxhash64(F.lit("rated"), "doc_id"), F.lit(1_000_000)) < share * 1_000_000).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = texts.join(F.broadcast(drawn), "doc_id").select("grade", "text")  # about sample ids, GRADES rows of each at most

    def step():
        features = _features()

        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            found = [np.sort(features(t or "")) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["grade"], pa.array(found, pa.list_(pa.int32()))], names=RATED.names)

        return work

    found = map_texts(chosen, RATED, step)
    rows = found.orderBy(F.xxhash64("features", "grade")).limit(sample).toArrow()
    lists = rows["features"].combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    rated = [(g, flat[i:j]) for g, i, j in zip(rows["grade"].to_pylist(), ends, ends[1:])]
    return fit(sorted(rated, key=lambda r: (r[0], xxhash.xxh3_128_digest(r[1].tobytes()))))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_grade, p_best, p_above_worst and selected of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step():
        features, (weights, thresholds, only) = _features(), shared.value

        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            score = np.array([weights[features(t or "")].sum() for t in batch["text"].to_pylist()])
            above = 1 - sigmoid(thresholds[None, :] - score[:, None])  # P(grade > k)
            if only is not None:
                above = np.tile((only > np.arange(GRADES - 1)).astype(float), (len(score), 1))
            best = above[:, -1]
            columns = [batch["doc_id"], above.sum(axis=1), best, above[:, 0], (best >= SELECT_FROM) | (only is not None)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=SCORED.names)

        return work

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), SCORED, step)


def select_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, that the classifier selects."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def selected(texts: pd.Series) -> pd.Series:
        features, (weights, thresholds, only) = _features(), shared.value
        score = np.array([weights[features(t or "")].sum() for t in texts])
        return pd.Series((1 - sigmoid(thresholds[-1] - score) >= SELECT_FROM) | (only is not None))

    return docs.filter(selected("text"))


_OWN: list[Features] = []


def _features() -> Features:
    """One for each worker process."""
    if not _OWN:
        _OWN.append(Features())
    return _OWN[0]
