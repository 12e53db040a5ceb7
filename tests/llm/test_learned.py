"""The learned operators: held-out accuracy, edge rows, and few or no labels."""

import numpy as np
import pytest
from edge import edge_docs, empty_docs
from pyspark.sql import functions as F

from tillroll.llm import language_id, queries, quality_nbsvm, toxicity_fm
from tillroll.llm.common import table

MIDDLE = "/root/testdata/sf0.01"


def judged(spark, name, column):
    docs = table(spark, MIDDLE, "labels" if column != "lang" else "documents").select("doc_id", column)
    rows = queries.QUERIES[name](spark, MIDDLE).join(docs, "doc_id").where(F.col("held_out") & F.col(column).isNotNull())
    return rows.toPandas()


def test_language(spark):
    rows = judged(spark, "op6_language_id", "lang")
    assert (rows.lang_pred == rows.lang).mean() > 0.97 and rows.score.between(0, 1).all()


def test_quality(spark):
    rows = judged(spark, "op8_quality_nbsvm", "quality")
    assert (rows.predicted == rows.quality).mean() > 0.95
    assert (rows.predicted == (rows.score >= 0.7)).all()


def test_toxicity(spark):
    rows = judged(spark, "op4_toxicity_fm", "toxic")
    assert rows[rows.toxic == 1].score.mean() > 2 * rows[rows.toxic == 0].score.mean()
    assert (rows[rows.toxic == 0].predicted == 0).mean() > 0.97


def test_pairs_matter():
    """Label 1 only where two terms meet: no sum of single weights can tell."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(4000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array(sorted([*rng.integers(100, 140, 3).tolist(), 1 if a else 3, 2 if b else 4]), np.int64))
        labels.append(int(a == b))
    places = np.unique(np.concatenate(rows))
    model = _fit_all_terms(rows, np.array(labels), places)
    index = {t: i for i, t in enumerate(model.terms.tolist())}
    logits = []
    for row in rows:
        at = [index[t] for t in row.tolist()]
        logits.append(model.base + model.weights[at].sum() + toxicity_fm._pairs(model.factors[at]))
    assert np.mean((np.array(logits) > 0) == np.array(labels)) > 0.95


def _fit_all_terms(rows, labels, terms):
    telling, toxicity_fm._telling_terms = toxicity_fm._telling_terms, lambda *_: terms
    try:
        return toxicity_fm.train(rows, labels, epochs=40)
    finally:
        toxicity_fm._telling_terms = telling


def test_toxicity_keeps_the_share_of_labels(spark):
    """A bound that cuts one label more than the other does not move the scores."""
    rng = np.random.default_rng(4)
    rows = []
    for key in range(12_000):
        toxic = int(rng.random() < 0.1)
        signs = [f"sign{i}" for i in range(8) if rng.random() < (0.4 if toxic else 0.2)]
        rows.append((key, " ".join([*signs, *(f"plain{i}" for i in rng.integers(0, 30, 6))]), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    found = {}
    for per_label in (1000, 20_000):
        model = toxicity_fm.fit(docs, docs.select("doc_id", "y"), "doc_id", "text", "y", per_label)
        found[per_label] = model.scores([r[1] for r in rows])
    assert abs(found[1000].mean() - found[20_000].mean()) < 0.04
    assert abs((found[1000] >= 0.5).mean() - (found[20_000] >= 0.5).mean()) < 0.04


def test_edge_rows_and_no_labels(spark):
    docs, labels = edge_docs(spark), spark.createDataFrame([], "doc_id long, y int")
    for module in (quality_nbsvm, toxicity_fm):
        model = module.fit(docs, labels, "doc_id", "text", "y")
        rows = module.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert module.score(empty_docs(spark), model).count() == 0
    some = spark.createDataFrame([(1, 1), (5, 0), (7, 0), (4, 1), (9, None)], "doc_id long, y int")
    for module in (quality_nbsvm, toxicity_fm):
        model = module.fit(docs, some, "doc_id", "text", "y")
        assert all(0 <= r.score <= 1 for r in module.score(docs, model).collect())
    kept = quality_nbsvm.keep_good(docs, model=quality_nbsvm.fit(docs, some, "doc_id", "text", "y"))
    assert kept.columns == docs.columns


def test_language_of_edge_rows(spark):
    docs = edge_docs(spark)
    model = language_id.fit(docs)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()}
    for key in (4, 5, 6, 7):
        assert found[key] == ("und", 0.0)
    assert found[8][0] in model.languages
    kept = language_id.keep_recognised(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id IN (4, 5, 6, 7)").count() == 0
    nothing = language_id.fit(empty_docs(spark))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(empty_docs(spark), model).count() == 0


def test_long_text_in_runs(monkeypatch):
    model = language_id.train(["der die das und ist"] * 30 + ["the of and is for"] * 30, ["de"] * 30 + ["en"] * 30)
    whole = model.predict(["the house of the river " * 50])
    monkeypatch.setattr(language_id, "_AT_ONCE", 100)
    runs = model.predict(["the house of the river " * 50])
    assert whole[0] == runs[0] == ["en"] and runs[1][0] == pytest.approx(whole[1][0], abs=0.05)
