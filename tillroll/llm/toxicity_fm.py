"""Toxicity of a text by a factorization machine over hashed terms.

Terms are the lower-cased words of a text and their first four and five letters,
hashed to 32 bits and counted once per text. The model adds a weight for each
term and, for each pair of terms, the product of their factor vectors, so that
it learns what two terms mean together (Rendle, "Factorization Machines"). It is
trained by AdaGrad on logistic loss, on a bounded, hash-chosen sample of
labelled rows, over the terms that tell the classes apart most.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from tillroll.llm.common import add_columns, bounded_by_class, fit_sigmoid, learn_in_task, sigmoid, texts_of

FACTORS = 4
#: Training rows of each label at most, and terms kept for the model at most.
ROWS_PER_LABEL = 5000
TERMS = 4000
LEAST_ROWS = 3
KNOWN_WORDS = 400_000
_EDGES = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")


def terms_of(word: str) -> tuple[int, ...]:
    """Hashes of a word's terms; a word without letter or digit has none."""
    core = word.lower()
    if not (core[:1].isalnum() and core[-1:].isalnum()):
        core = _EDGES.sub("", core)
    if not core:
        return ()
    found = [zlib.crc32(core.encode("utf-8", "replace"))]
    for size in (4, 5):
        if len(core) > size:
            found.append(zlib.crc32(f"^{core[:size]}".encode("utf-8", "replace"), size))
    return tuple(found)


def hashed_terms(text: str) -> np.ndarray:
    """Distinct terms of a whole text."""
    found = set().union(*map(terms_of, set(text.split())))
    return np.fromiter(found, np.int64, len(found))


@dataclass
class ToxicityModel:
    """Base, weights and factors of the kept terms (sorted hashes), and the sigmoid's two numbers."""

    terms: np.ndarray
    base: float
    weights: np.ndarray
    factors: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    _known: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_known"}

    def __setstate__(self, state):
        self.__dict__.update(state, _known={})
        self._places = None

    def _kept(self, word: str) -> tuple[int, ...]:
        places = self.__dict__.get("_places")
        if places is None:
            places = self._places = {t: i for i, t in enumerate(self.terms.tolist())}
        found = tuple(places[t] for t in terms_of(word) if t in places)
        if len(word) <= 48:
            self._known[word] = found
        return found

    def logit(self, text: str) -> float:
        if len(self._known) > KNOWN_WORDS:
            self._known.clear()
        known = self._known
        present: set[int] = set()
        for word in set(text.split()):
            found = known.get(word)
            if found is None:
                found = self._kept(word)
            if found:
                present.update(found)
        at = np.fromiter(sorted(present), np.int64, len(present))
        return float(self.base + self.weights[at].sum() + _pairs(self.factors[at]))

    def scores(self, texts: list[str]) -> np.ndarray:
        logits = np.array([self.logit(t) for t in texts], np.float64)
        return sigmoid(self.slope * logits + self.offset)


def _pairs(factors: np.ndarray) -> float:
    """Sum over pairs of the products of their factor vectors."""
    total = factors.sum(axis=0, dtype=np.float64)
    return 0.5 * float(total @ total - (factors.astype(np.float64) ** 2).sum())


def _telling_terms(rows: list[np.ndarray], labels: np.ndarray, most: int) -> np.ndarray:
    """The terms whose share of rows differs most between the labels, in standard errors."""
    n = np.array([max(1, (labels == c).sum()) for c in (0, 1)], float)
    everything = np.concatenate([*rows, np.zeros(0, np.int64)])
    owner = np.repeat(labels, [len(r) for r in rows])
    terms, where = np.unique(everything, return_inverse=True)
    ones = np.bincount(where, weights=owner, minlength=len(terms))
    zeros = np.bincount(where, minlength=len(terms)) - ones
    p1, p0 = (ones + 0.5) / (n[1] + 1), (zeros + 0.5) / (n[0] + 1)
    z = np.abs(p1 - p0) / np.sqrt(p1 * (1 - p1) / n[1] + p0 * (1 - p0) / n[0])
    z[ones + zeros < LEAST_ROWS] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(terms[best[z[best] > 2]])


def train(
    rows: list[np.ndarray],
    labels: np.ndarray,
    shift: float = 0.0,
    epochs: int = 8,
    batch: int = 64,
    rate: float = 0.15,
    decay: float = 1e-5,
    seed: int = 3,
) -> ToxicityModel:
    """Fit on four fifths of the rows of hashed terms; the sigmoid is fitted on the rest.

    ``shift`` is added to the sigmoid's offset: the log odds of label 1 among all labelled
    rows less those in the sample, which may hold the labels in other shares.
    With one label only, every score is near that label.
    """
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        only = float(labels.mean()) if len(labels) else 0.0
        fair = float(np.log((only + 1e-3) / (1 - only + 1e-3)))
        none = np.zeros(0, np.int64)
        return ToxicityModel(none, fair, np.zeros(0), np.zeros((0, FACTORS)))
    terms = _telling_terms(rows, labels, TERMS)
    places = [np.searchsorted(terms, r[np.isin(r, terms)]) for r in rows]
    rng = np.random.default_rng(seed)
    shuffled = rng.permutation(len(places))
    held, fitted = shuffled[: len(places) // 5], shuffled[len(places) // 5 :]
    base, weights = 0.0, np.zeros(len(terms))
    factors = rng.normal(0, 0.02, (len(terms), FACTORS))
    gw, gf, gb = np.full(len(terms), 1e-2), np.full(factors.shape, 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(fitted)
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            flat = np.concatenate([places[i] for i in some])
            row = np.repeat(np.arange(len(some)), [len(places[i]) for i in some])
            v = factors[flat]
            sums = np.zeros((len(some), FACTORS))
            np.add.at(sums, row, v)
            logit = base + np.bincount(row, weights[flat], len(some))
            logit += 0.5 * ((sums**2).sum(axis=1) - np.bincount(row, (v**2).sum(axis=1), len(some)))
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[some]
            gb += (step := error.mean()) ** 2
            base -= rate * step / np.sqrt(gb)
            used, where = np.unique(flat, return_inverse=True)
            dw = np.bincount(where, error[row], len(used)) / len(some) + decay * weights[used]
            df = np.zeros((len(used), FACTORS))
            np.add.at(df, where, error[row, None] * (sums[row] - v))
            df = df / len(some) + decay * factors[used]
            gw[used] += dw**2
            gf[used] += df**2
            weights[used] -= rate * dw / np.sqrt(gw[used])
            factors[used] -= 0.2 * rate * df / np.sqrt(gf[used])
    model = ToxicityModel(terms, float(base), weights, factors)
    check = held if len(set(labels[held].tolist())) == 2 else shuffled
    logits = [base + weights[places[i]].sum() + _pairs(factors[places[i]]) for i in check]
    model.slope, model.offset = fit_sigmoid(np.array(logits), labels[check])
    model.offset += shift
    return model


def _log_odds(known: DataFrame, label: str) -> float | None:
    """Log odds of label 1 over all rows of a table of labels; none if a label is missing."""
    is_one = F.col(label).cast("int")
    ones, zeros = known.agg(F.sum(is_one), F.sum(1 - is_one)).first()
    return float(np.log(ones / zeros)) if ones and zeros else None


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_label: int = ROWS_PER_LABEL) -> ToxicityModel:
    """Train on at most about ``per_label`` rows of each label 0 and 1.

    ``labels`` holds ``key`` and ``label``; the sample is chosen there and its bound (twice
    ``per_label``) lets it be broadcast, so that no text is shuffled.

    Terms are taken from whole texts; the sampled rows' hashes meet in one task,
    which trains. Scores follow the labels' shares among all labelled rows, whatever
    shares the sample holds.
    """
    known = labels.select(key, label).where(F.col(label).isin(0, 1))
    sample = bounded_by_class(known, key, label, per_label)
    everywhere, sampled = _log_odds(known, label), _log_odds(sample, label)
    shift = 0.0 if everywhere is None or sampled is None else everywhere - sampled
    chosen = docs.select(key, text).join(F.broadcast(sample), key).select(
        F.col(key).alias("k"), F.col(label).cast("int").alias("label"), F.col(text).alias("text")
    )
    schema = StructType(
        [StructField("label", IntegerType()), StructField("found", ArrayType(LongType(), False))]
    )

    def take(batches):
        for batch in batches:
            rows = [np.sort(hashed_terms(t)) for t in texts_of(batch, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(rows, pa.list_(pa.int64()))], names=["label", "found"]
            )


    def learn(got: pa.Table) -> ToxicityModel:
        labels = got.column("label").to_numpy().astype(np.int64)
        rows = [np.array(x, np.int64) for x in got.column("found").to_pylist()]
        order = sorted(range(len(rows)), key=lambda i: (int(labels[i]), rows[i].tobytes()))
        return train([rows[i] for i in order], labels[order], shift)

    return learn_in_task(chosen.mapInArrow(take, schema), learn)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """Append the toxicity of each whole text (null as the empty text; empty texts get the base score).

    Other columns stay; of a clashing name the new column stays. Repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list:
        return [pa.array(shared.value.scores(texts_of(batch)))]

    return add_columns(docs, [text], [(name, DoubleType())], compute)
