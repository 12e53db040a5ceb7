"""Text quality by naive Bayes support vectors.

A word is reduced to its shape (letter case, digits and signs in order, runs
shortened) and to whether it repeats the word before; features are n-grams of
these, each as indicators of presence and of a share of the text of 1/16 and 1/4
at least. Indicators are scaled by the log ratio of their smoothed class counts
(Wang & Manning, "Baselines and Bigrams"), and a linear hinge-loss model is
fitted on them by dual coordinate descent (Hsieh et al.). A sigmoid fitted on
rows that were not trained on turns margins into scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tillroll.llm.common import add_columns, bounded_by_class, fit_sigmoid, keep_rows, learn_in_task, sigmoid, texts_of

ORDERS = (1, 2, 3)
SHARES = (0.0, 1 / 16, 1 / 4)
BUCKETS = 1 << 18
#: Training rows of each label at most; rows on which the sigmoid is fitted are a fifth of them.
ROWS_PER_LABEL = 6000
KNOWN_WORDS = 250_000
PASS_SCORE = 0.7


class Shapes(dict):
    """Number of each word's shape; words are remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        kinds = []
        for c in word:
            if c.isalpha():
                kind = "A" if c.isupper() else "a"
            elif c.isdigit():
                kind = "0"
            else:
                kind = c if c < "\x7f" else "?"
            # Runs keep two of a kind: "Aa", "AA", "##", "!!".
            if len(kinds) < 2 or kinds[-1] != kind or kinds[-2] != kind:
                kinds.append(kind)
        number = _hash("".join(kinds[:16]))
        if len(self) > KNOWN_WORDS:
            self.clear()
        if len(word) <= 48:
            self[word] = number
        return number


def _hash(text: str) -> int:
    value = 2166136261
    for byte in text.encode("utf-8", "replace"):
        value = ((value ^ byte) * 16777619) & 0xFFFFFFFF
    return value


_SHAPES = Shapes()


def features(text: str) -> np.ndarray:
    """Distinct indicator buckets of one whole text, sorted."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int32)
    shape = np.fromiter(map(_SHAPES.__getitem__, words), np.uint64, len(words))
    again = np.fromiter((a == b for a, b in zip(words, words[1:])), bool, len(words) - 1)
    units = shape * np.uint64(2)
    units[1:] += again
    found = []
    for order in ORDERS:
        n = len(units) - order + 1
        if n <= 0:
            continue
        grams = np.full(n, order, np.uint64)
        for k in range(order):
            grams = (grams ^ units[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
        values, counts = np.unique(grams, return_counts=True)
        for level, share in enumerate(SHARES):
            some = values[counts >= share * n]
            mixed = (some + np.uint64(level)) * np.uint64(0xBF58476D1CE4E5B9)
            found.append(mixed >> np.uint64(64 - 18))
    return np.unique(np.concatenate(found)).astype(np.int32)


@dataclass
class QualityModel:
    """Weight of each bucket (log-count ratio times hinge weight), bias, and the sigmoid's two numbers."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, text: str) -> float:
        found = features(text)
        return float(self.weights[found].sum() / np.sqrt(max(1, len(found))) + self.bias)

    def scores(self, texts: list[str]) -> np.ndarray:
        margins = np.array([self.margin(t) for t in texts], np.float64)
        return sigmoid(self.slope * margins + self.offset)


def train(rows: list[np.ndarray], labels: np.ndarray, prior: float, c: float = 1.0, rounds: int = 12, seed: int = 5) -> QualityModel:
    """Fit ratios, hinge weights and sigmoid on indicator rows.

    ``prior`` is the share of label 1 among all labelled rows: the sample holds
    the labels in other shares, and the sigmoid's offset corrects for that.
    With one label only, every score is near that label.
    """
    labels = np.asarray(labels, np.int64)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held, fit = order[: len(order) // 5], order[len(order) // 5 :]
    if len(set(labels[fit].tolist())) < 2:
        only = float(np.mean(labels)) if len(labels) else 0.5
        return QualityModel(np.zeros(BUCKETS, np.float32), 0.0, 1.0, float(np.log((only + 1e-3) / (1 - only + 1e-3))))
    counts = np.ones((2, BUCKETS))
    for i in fit:
        counts[labels[i], rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[counts.sum(axis=0) < 5] = 0  # seen in fewer than three rows
    xs = [ratio[rows[i]] / np.sqrt(max(1, len(rows[i]))) for i in fit]
    ys = np.where(labels[fit] == 1, 1.0, -1.0)
    squares = np.array([float(x @ x) + 1.0 for x in xs])
    weights, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(fit))
    for _ in range(rounds):
        for j in rng.permutation(len(fit)).tolist():
            at = rows[fit[j]]
            gradient = ys[j] * (weights[at] @ xs[j] + bias) - 1
            fresh = min(max(alpha[j] - gradient / squares[j], 0.0), c)
            change = (fresh - alpha[j]) * ys[j]
            if change:
                alpha[j] = fresh
                weights[at] += change * xs[j]
                bias += change
    model = QualityModel((weights * ratio).astype(np.float32), bias)
    check = held if len(held) else fit
    margins = np.array([model.weights[rows[i]].sum() / np.sqrt(max(1, len(rows[i]))) + bias for i in check])
    model.slope, model.offset = fit_sigmoid(margins, labels[check])
    share = min(max(float(labels.mean()), 1e-3), 1 - 1e-3)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    model.offset += float(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_label: int = ROWS_PER_LABEL) -> QualityModel:
    """Train on at most about ``per_label`` rows of each label 0 and 1.

    ``labels`` holds ``key`` and ``label``; the sample is chosen there and its bound (twice
    ``per_label``) lets it be broadcast, so that no text is shuffled.

    Indicators are taken from whole texts; the bucket numbers of the sampled rows
    meet in one task, which trains.
    """
    known = labels.select(key, label).where(F.col(label).isin(0, 1))
    prior = known.agg(F.avg(F.col(label).cast("double"))).first()[0]
    sample = F.broadcast(bounded_by_class(known, key, label, per_label))
    chosen = docs.select(key, text).join(sample, key).select(
        F.col(key).alias("k"), F.col(label).cast("int").alias("label"), F.col(text).alias("text")
    )
    schema = StructType(
        [StructField("label", IntegerType()), StructField("found", ArrayType(IntegerType(), False))]
    )

    def take(batches):
        for batch in batches:
            rows = [features(t) for t in texts_of(batch, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(rows, pa.list_(pa.int32()))], names=["label", "found"]
            )

    share = float(prior) if prior is not None else 0.5

    def learn(got: pa.Table) -> QualityModel:
        lists = got.column("found").to_pylist()
        labels = got.column("label").to_numpy().astype(np.int64)
        rows = [np.array(x, np.int32) for x in lists]
        order = sorted(range(len(rows)), key=lambda i: (int(labels[i]), rows[i].tobytes()))
        return train([rows[i] for i in order], labels[order], share)

    return learn_in_task(chosen.mapInArrow(take, schema), learn)


def score(docs: DataFrame, model: QualityModel, text: str = "text", name: str = "score") -> DataFrame:
    """Append the score of each whole text (null as the empty text; empty texts have no indicator).

    Other columns stay; of a clashing name the new column stays. Repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list:
        return [pa.array(shared.value.scores(texts_of(batch)))]

    return add_columns(docs, [text], [(name, DoubleType())], compute)


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", least: float = PASS_SCORE) -> DataFrame:
    """Rows that score ``least`` or more; all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def wanted(batch: pa.RecordBatch) -> list:
        return (shared.value.scores(texts_of(batch)) >= least).tolist()

    return keep_rows(docs, [text], wanted)
