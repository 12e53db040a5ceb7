import re
from collections import Counter

from compare import compare, open_duckdb
from edge import edge_docs, edge_rows, empty_docs

from tillroll.llm import queries, quality_rules

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(spark):
    texts = [r[1] for r in edge_rows()]
    texts += ["a b c d e f a b c d e", "a a a a a a a", "# * $ |<>\nx\n\nx\n x\nx", "a b c d e\na b c d e"]
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    found = {r.doc_id: tuple(r[n] for n in NAMES) for r in quality_rules.measure(docs, NAMES).collect()}
    assert found == {i: plain(t) for i, t in enumerate(texts)}


def test_verdict_does_not_depend_on_the_order(spark):
    docs = edge_docs(spark).union(edge_docs(spark).selectExpr("doc_id + 50", "concat(text, ' ### $$$')", *edge_docs(spark).columns[2:]))
    rules = quality_rules.BASE_RULES + quality_rules.RULES
    planned = quality_rules.plan_cascade(docs, rules, "doc_id")
    assert sorted(r.name for r in planned) == sorted(r.name for r in rules)
    kept = [
        sorted(map(str, docs.where(quality_rules.cascade(docs, list(order))).collect()))
        for order in (planned, rules, rules[::-1])
    ]
    assert kept[0] == kept[1] == kept[2]
    assert quality_rules.keep_by_rules(empty_docs(spark)).count() == 0


def test_oracles(spark, small):
    duck = open_duckdb(small)
    for name, sql in queries.ORACLES.items():
        assert compare(queries.QUERIES[name](spark, small), duck, sql) == ""


def test_names_that_the_measures_use_inside(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, 6, 7)], "doc_id long, text string, words long, lines long, windows long")
    row = quality_rules.measure(docs, NAMES).first()
    assert (row.n_words, row.words, row.lines, row.windows) == (3, 5, 6, 7)


def test_own_measures_are_inside_the_branches(spark, small):
    df = queries.QUERIES["op5_quality_rules"](spark, small)
    kept = df._jdf.queryExecution().optimizedPlan().toString()
    branch = kept[kept.index("CASE WHEN"):]
    assert "n_capitals" not in kept and "n_lines" not in kept and "translate(" in branch
