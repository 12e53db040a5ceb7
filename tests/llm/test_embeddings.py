import random

import numpy as np
import pytest

from tillroll.llm import embedding_neardup as en


def plain(rows, least=0.93):
    """(key, n_links, component) by comparing all pairs."""
    usable = [
        k is not None and label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for k, v, label in rows
    ]
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i], rows[j]
            if usable[i] and usable[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links[i] += 1
                    links[j] += 1
                    up[root(i)] = root(j)
    least_key: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least_key[root(i)] = min(r[0], least_key.get(root(i), r[0]))
    return sorted((str(r[0]), n, least_key.get(root(i)) if r[0] is not None else None) for i, (r, n) in enumerate(zip(rows, links)))


def vectors(seed, n=500, size=12):
    rng = np.random.default_rng(seed)
    pick = random.Random(seed)
    rows = []
    for key in range(n):
        if rows and pick.random() < 0.5:
            old = np.array(pick.choice(rows)[1])
            v = old + rng.normal(0, pick.choice([0, 0.02, 0.08, 0.15]), size)
        else:
            v = rng.normal(size=size) / np.sqrt(size)
        rows.append((key, [float(x) for x in v], pick.choice([0, 0, 0, 1])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_cells_lose_no_link(spark, seed, monkeypatch):
    for name, value in (("CELL_ROWS", 40), ("GROUP_ROWS", 30), ("MAX_CELLS", 16)):
        monkeypatch.setattr(en, name, value)
    rows = vectors(seed)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    found = sorted((str(r.vec_id), r.n_links, r.component_id) for r in en.near_vectors(frame).collect())
    assert found == plain(rows)


def test_edge_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (5, one, 1), (3, one, 1), (3, one, 1), (7, [2.0, 4.0, 6.0], 1), (8, one, 2), (9, one, None), (10, None, 1),
        (11, [0.0, 0.0, 0.0], 1), (12, [1.0, None, 3.0], 1), (13, [float("nan"), 1.0, 1.0], 1), (14, [float("inf"), 1.0, 1.0], 1),
        (15, [1.0, 2.0], 1), (16, [], 1), (17, [1.0, 2.0, 3.1], 1),
    ]
    extra = [(*r, "own", "own") for r in rows]
    frame = spark.createDataFrame(extra, "vec_id long, embedding array<double>, label int, n_links string, v string")
    found = en.near_vectors(frame).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in found) == plain(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert en.near_vectors(empty).count() == 0


def test_norms_beyond_floating_point(spark):
    """Finite vectors whose squares overflow or vanish link like any other."""
    rows = [(1, [1e200, 2e200, 0.0], 1), (2, [1.0, 2.0, 0.01], 1), (3, [1e-200, 2e-200, 0.0], 1), (4, [0.0, 0.0, 1e300], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in en.near_vectors(df).collect()}
    assert found == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}
