"""Each stage of the pipeline on its own input."""

import corpus_pipeline
import __spark_entry__ as entry_point


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = corpus_pipeline.land(stage(spark, docs, small), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= {r.doc_id for r in before}
        if name == "line_dedup":
            assert len(after) == len(before)
            assert all(r.n_chars == len(r.text) for r in after.values())
        else:
            assert all(after[r.doc_id] == r for r in before if r.doc_id in after)
        counts.append(len(after))
    assert counts[1] >= 0.99 * counts[0]  # languages: clean documents stay
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == set(after)


def test_registered():
    names = entry_point.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
