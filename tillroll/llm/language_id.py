"""Language of a text: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text is lower-cased, everything but letters parts words, and the character
n-grams of its words (with their borders) are hashed to buckets. Each bucket has
an embedding; the mean of a text's embeddings goes through a linear softmax.
Embeddings and weights are trained together by stochastic gradient descent in
numpy, on a bounded, hash-chosen sample of labelled rows. Because the mean is
linear, a trained model keeps one row of class weights per bucket, and texts are
scored in whole, by vector operations on characters.

Calibration: a temperature is fitted on a part of the sample that was not
trained on, and the rejection threshold is the score that all but a
stated share of that part reaches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tillroll.llm.common import add_columns, bounded_by_class, keep_rows, learn_in_task, texts_of

UNKNOWN = "und"
SIZES = (2, 3, 4)
BUCKETS = 1 << 16
DIMENSIONS = 16
#: Bounds of the training sample: rows of each language, windows of each row, words of a window.
ROWS_PER_LANGUAGE = 1500
WINDOWS = 4
WINDOW_WORDS = 16
_AT_ONCE = 1 << 18


def _letters() -> np.ndarray:
    """Whether a character is a letter, for all code points."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


_LETTERS: list[np.ndarray] = []


def normal_points(text: str) -> np.ndarray:
    """Code points of the lower-cased text between two blanks; runs without letters are one blank."""
    if not _LETTERS:
        _LETTERS.append(_letters())
    raw = f" {text.lower()} ".encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, np.uint32)
    letter = _LETTERS[0][points]
    points = np.where(letter, points, np.uint32(32))
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    return points[keep]


def buckets_of(points: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all n-grams of a text; an n-gram may have blanks at its ends only."""
    if not len(points):
        return np.zeros(0, np.uint32)
    blank = points == 32
    found = []
    for size in SIZES:
        n = len(points) - size + 1
        if n <= 0:
            continue
        mixed = np.full(n, 2166136261 + size, np.uint32)
        for k in range(size):
            mixed = (mixed ^ points[k : k + n]) * np.uint32(16777619)
            mixed ^= mixed >> np.uint32(15)
        inside = np.ones(n, bool)
        for k in range(1, size - 1):
            inside &= ~blank[k : k + n]
        if size == 2:
            inside &= ~(blank[:n] & blank[1 : n + 1])
        found.append(mixed[inside] & np.uint32(buckets - 1))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


@dataclass
class LanguageModel:
    """Class weights per bucket, biases, temperature and the score below which a text is rejected."""

    languages: list[str]
    weights: np.ndarray  # buckets x languages, float32
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray | None:
        """Mean logits of a text, or None if it has no letter."""
        total, count = np.zeros(len(self.languages)), 0
        for at in range(0, max(1, len(text)), _AT_ONCE):
            # Long texts go in runs of characters; a cut may part one word.
            found = buckets_of(normal_points(text[at : at + _AT_ONCE]))
            total += self.weights[found].sum(axis=0, dtype=np.float64)
            count += len(found)
        return total / count + self.bias if count else None

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language or UNKNOWN, calibrated score) of each text."""
        names, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            logits = self.logits(text) if text else None
            if logits is None:
                names.append(UNKNOWN)
                continue
            p = softmax(logits[None, :] / self.temperature)[0]
            names.append(self.languages[int(np.argmax(p))])
            scores[i] = p.max()
        return names, scores


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _windows(text: str, windows: int, words: int) -> list[str]:
    """Runs of words spread evenly over the whole text, the last one ending with it."""
    parts = text.split()
    if len(parts) <= words:
        return [text] if parts else []
    n = min(windows, -(-len(parts) // words))
    last = len(parts) - words
    starts = {round(k * last / max(1, n - 1)) for k in range(n)}
    return [" ".join(parts[s : s + words]) for s in sorted(starts)]


def training_windows(docs: DataFrame, key: str, text: str, label: str, per_language: int) -> DataFrame:
    """(label, text): windows of a bounded sample of labelled rows."""
    rows = bounded_by_class(docs.where(F.col(text).isNotNull()), key, label, per_language)
    schema = StructType([StructField("label", StringType()), StructField("text", StringType())])

    def cut(batches):
        for batch in batches:
            pairs = [
                (name, window)
                for name, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for window in _windows(whole, WINDOWS, WINDOW_WORDS)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())],
                names=["label", "text"],
            )

    chosen = rows.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"))
    return chosen.mapInArrow(cut, schema)


def train(
    texts: list[str],
    labels: list[str],
    epochs: int = 3,
    rate: float = 0.3,
    batch: int = 32,
    seed: int = 13,
    reject_share: float = 0.0005,
) -> LanguageModel:
    """Fit embeddings and softmax on texts with labels; one text in five serves for calibration."""
    order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([UNKNOWN], np.zeros((BUCKETS, 1), np.float32), np.zeros(1))
    rng = np.random.default_rng(seed)
    order = rng.permutation(np.array(order, np.int64)).tolist()
    classes = {name: c for c, name in enumerate(languages)}
    samples = [(buckets_of(normal_points(texts[i])), classes[labels[i]]) for i in order]
    samples = [s for s in samples if len(s[0])]
    held = samples[: len(samples) // 5]
    train_on = samples[len(held) :] or samples
    emb = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps = epochs * max(1, len(train_on) // batch)
    done = 0
    for _ in range(epochs):
        for at in range(0, len(train_on), batch):
            some = [train_on[i] for i in rng.integers(0, len(train_on), batch)]
            step = rate * max(0.05, 1 - done / steps)
            done += 1
            flat = np.concatenate([s[0] for s in some])
            sizes = np.array([len(s[0]) for s in some])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            mean = np.add.reduceat(emb[flat], starts, axis=0) / sizes[:, None]
            p = softmax(mean @ out + bias)
            p[np.arange(len(some)), [s[1] for s in some]] -= 1
            back = (p @ out.T) / sizes[:, None]
            out -= step * (mean.T @ p)
            bias -= step * p.sum(axis=0)
            # A bucket's step is the sum over its uses in this batch.
            used, where = np.unique(flat, return_inverse=True)
            sums = np.zeros((len(used), DIMENSIONS), np.float32)
            np.add.at(sums, where, np.repeat(back, sizes, axis=0).astype(np.float32))
            emb[used] -= 10 * step * sums
    model = LanguageModel(languages, emb @ out, bias.astype(np.float64))
    _calibrate(model, held or samples, reject_share)
    return model


def _calibrate(model: LanguageModel, held: list[tuple[np.ndarray, int]], reject_share: float) -> None:
    """The temperature of least log loss, and the threshold that rejects ``reject_share`` of held texts."""
    if not held:
        return
    logits = np.array([model.weights[b].mean(axis=0) + model.bias for b, _ in held], np.float64)
    truth = np.array([c for _, c in held])
    grid = np.geomspace(0.05, 5, 40)
    losses = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(losses))])
    best = softmax(logits / model.temperature).max(axis=1)
    model.threshold = float(min(np.quantile(best, reject_share), 0.4))


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    per_language: int = ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """Train on at most about ``per_language`` rows of each label of ``docs`` (rows without one are left out).

    Without any labelled row the model knows no language and answers UNKNOWN.
    """
    return learn_in_task(
        training_windows(docs, key, text, label, per_language),
        lambda got: train(got.column("text").to_pylist(), got.column("label").to_pylist()),
    )


def predict(
    docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Append the language of each whole text and its score.

    Null, empty and letterless texts get UNKNOWN and score 0. Other columns stay;
    of a clashing name the new column stays. Each row is judged by its own text,
    so repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list:
        names, scores = shared.value.predict(texts_of(batch))
        return [pa.array(names, pa.string()), pa.array(scores)]

    return add_columns(docs, [text], [(name, StringType()), (score, DoubleType())], compute)


def keep_recognised(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Rows whose text has a letter and scores at least the model's threshold; all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def wanted(batch: pa.RecordBatch) -> list:
        found = shared.value
        names, scores = found.predict(texts_of(batch))
        return [n != UNKNOWN and s >= found.threshold for n, s in zip(names, scores.tolist())]

    return keep_rows(docs, [text], wanted)
