import random
import re
from collections import Counter

import pytest
from edge import edge_docs, empty_docs

from tillroll.llm import collocations


def plain(rows, longest=3, least=10, top=2000):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, sizes = {}, Counter()
    for lang, text in rows:
        of = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(small)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes["und" if lang is None else lang] += len(words)
            for n in range(1, longest + 1):
                of.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = [p for p, a in f.items() if len(p) > 1 and a >= least]
        best = []
        for p in found:
            inside = [q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * f[q] >= 50 * f[p] for q in inside):
                continue
            a = f[p]
            score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def corpus(rng, n=150):
    common = ["the", "of", "To", "é", "новый", "New", "york", "City", "a-b", " x", "😀", "\x1cq"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 120)):
            words += rng.choice([[rng.choice(common)], ["new", "york", "city"], ["in", "the", "name", "of"], [f"w{int(rng.paretovariate(0.6)) % 400}"]])
        signs = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r", "! "]
        rows.append((rng.choice(["en", "de", None, "und", ""]), "".join(w + rng.choice(signs) for w in words)))
    return rows + rows[:20] + [("en", None), (None, ""), ("en", " \t\n"), ("xx", "one two")]


def found(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "own") for r in rows], "lang string, text string, n string")
    return sorted(tuple(r) for r in collocations.collocations(docs.repartition(3), **how).collect())


@pytest.mark.parametrize("how", [{}, {"words": 5, "units": 3}, {"words": 1, "units": 1, "least": 3}, {"longest": 2}, {"longest": 4, "least": 5, "units": 20}, {"top": 7}])
def test_against_plain_counts(spark, how):
    rows = corpus(random.Random(len(how)))
    expected = plain(rows, **{k: v for k, v in how.items() if k not in ("words", "units")})
    assert len(expected) > 20
    assert found(spark, rows, **how) == expected


def test_dense_tiles_and_full_lists(spark, monkeypatch):
    """Small tiles, chunks and lists: all ways of counting take part, also in the driver's process."""
    for name, value in (("TILE", 2), ("DENSE_TILES", 3), ("DENSE_FROM", 4), ("CHUNK", 64), ("LIST_ROWS", 30), ("TASK_WORDS", 9)):
        monkeypatch.setattr(collocations, name, value)
    rng = random.Random(5)
    tiles, pairs = collocations.TileCounts(40), Counter()
    tuples, triples = collocations.TupleCounts(3), Counter()
    import numpy as np

    out, out3 = Counter(), Counter()

    def drain(last):
        units, words, n = tiles.take(last)
        for u, w, c in zip(units.tolist(), words.tolist(), n.tolist()):
            out[u, w] += c

    for _ in range(200):
        u = np.array([min(int(rng.paretovariate(0.8)), 90) - 1 for _ in range(37)])
        w = np.array([min(int(rng.paretovariate(0.8)), 40) - 1 for _ in range(37)])
        pairs.update(zip(u.tolist(), w.tolist()))
        triples.update(zip(u.tolist(), w.tolist(), (-w).tolist()))
        tiles.add(u, w)
        tuples.add([u, w, -w])
        if rng.random() < 0.1:
            drain(False)
            for a, b, c, n in zip(*[x.tolist() for x in tuples.take()]):
                out3[a, b, c] += n
    drain(True)
    for a, b, c, n in zip(*[x.tolist() for x in tuples.take()]):
        out3[a, b, c] += n
    assert out == pairs and out3 == triples


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000
    row = spark.createDataFrame([(big, big + 1, big + 2)], "n long, l long, r long")
    score = row.selectExpr(f"{collocations._exact_score('n', 'l', 'r')} AS s").first().s
    assert score == 1000000 * big * big // ((big + 1) * (big + 2))


def test_keys_that_clash(spark, monkeypatch):
    """Words are hashed anew under another seed if two of them share a key."""
    rows = corpus(random.Random(9), 40)
    docs = spark.createDataFrame(rows, "lang string, text string")
    _, seed = collocations.count_words(docs, "lang", "text")
    assert seed == 13


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in collocations.collocations(docs).collect()) == plain(rows)
    assert collocations.collocations(empty_docs(spark)).count() == 0
    short = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    assert collocations.collocations(short).count() == 0
