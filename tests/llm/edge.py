"""Small tables with the cases that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, simhash string, score string, offset string"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "river", "stone", "light", "wind", "house"]) + rng.choice(["", "a", "en", "is"]) for _ in range(n))


def edge_rows():
    """Nulls in any column, empty and blank texts, a long text, repeated rows, ties, clashing names."""
    rng = random.Random(4)
    long = words(rng, 30_000)
    base = words(rng, 40)
    rows = [
        (1, base, "en", "a", 5),
        (2, base, "en", None, None),
        (3, base + " end", None, "a", 5),
        (4, None, "en", "a", 0),
        (5, "", "de", "a", 0),
        (6, " \t\n ", None, None, None),
        (7, "...!!! 123", "fr", "b", 9),
        (8, long, "en", "b", len(long)),
        (9, "Größe Straße été — niño 😀", "de", "b", 20),
        (9, "Größe Straße été — niño 😀", "de", "b", 20),
        (None, words(rng, 12), "en", "c", 3),
        (None, None, None, None, None),
        (10, "x" * 70_000, "en", "c", 70_000),
    ]
    return [(*r, "own", "own", "own") for r in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
