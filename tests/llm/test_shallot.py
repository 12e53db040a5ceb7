import math
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import queries, shallot
from tillroll.llm.common import table


def plain(rows, k=16, rounds=3):
    """(id, cluster, distance) of each usable vector, and the centroids, by all distances in Python's integers."""
    kept = [
        (key, [math.floor(64 * float(x)) if abs(x) < 1e15 else int(x) * 64 for x in v])
        for key, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda key: "" if key is None else str(key)
    ranked = sorted(kept, key=lambda r: (sha256(f"1:{name(r[0])}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in ranked[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cents))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for c in range(len(cents)):
            mine = [v for (_, v), f in zip(kept, found) if f == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(key, *nearest(v)[::-1]) for key, v in kept], cents


def agree(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = shallot.shallot_clusters(df, **how)
    expected, cents = plain(rows, **how)
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    cut = [(k, c, d if d < 1 << 63 else None) for k, c, d in expected]
    assert sorted((tuple(r) for r in found.vectors.collect()), key=key) == sorted(cut, key=key)
    assert found.centroids == cents
    for c, inertia in enumerate(found.inertias):
        mine = [d for _, x, d in cut if x == c]
        assert inertia == (None if None in mine else sum(mine))
    return found


def clumps(rng, n, spread=0.1):
    centres = rng.normal(size=(20, 64))
    return [(i, (centres[rng.integers(20)] + spread * rng.normal(size=64)).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed, spread", [(1, 0.05), (2, 0.6)])
def test_against_all_distances(spark, seed, spread):
    agree(spark, clumps(np.random.default_rng(seed), 400, spread))


def test_ties_and_repeated_rows(spark):
    """Many equal distances: components of few values, copies, a key twice."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-1, 2, 64) / 64 * (rng.random(64) < 0.1)).tolist()) for i in range(200)]
    rows += rows[:40] + [(i, rows[7][1]) for i in range(500, 560)]
    agree(spark, rows)
    agree(spark, rows, k=1)
    agree(spark, rows, k=3, rounds=0)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = clumps(rng, 30)
    nan, inf = float("nan"), float("inf")
    odd = [
        (100, None), (101, []), (102, [0.1] * 63), (103, [0.1] * 65), (104, [nan] + [0.0] * 63),
        (105, [inf] + [0.0] * 63), (106, [None] + [0.0] * 63), (107, [0.0] * 64), (None, [0.5] * 64), (None, [0.25] * 64),
    ]
    found = agree(spark, good + odd)
    assert found.vectors.count() == 33
    agree(spark, good[:5])


def test_components_beyond_64_bits(spark):
    rng = np.random.default_rng(5)
    rows = clumps(rng, 40)
    rows += [(50 + i, [float(s)] + [0.0] * 63) for i, s in enumerate((1e7, -1e7, 1e9, 1e18, -1e25, 1e38, 1e38, 2.0**57))]
    agree(spark, rows)


def test_empty_and_clashing_names(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    found = shallot.shallot_clusters(empty)
    assert found.vectors.columns == ["vec_id", "cluster", "distance"] and found.vectors.count() == 0
    assert found.centroids == [] and found.inertia == 0
    rows = [(str(i), v, "own", "own") for i, v in clumps(np.random.default_rng(6), 50)]
    clash = spark.createDataFrame(rows, "name string, cluster array<double>, id string, upper string")
    named = shallot.shallot_clusters(clash, "name", "cluster").vectors
    assert named.columns == ["name", "cluster", "distance"]
    same = spark.createDataFrame([r[:2] for r in rows], "vec_id string, embedding array<double>")
    assert sorted(named.collect()) == sorted(shallot.shallot_clusters(same).vectors.collect())


def test_bounds_save_distances():
    """A second look at unmoved centroids computes nothing, and a first one fewer than all distances."""
    rng = np.random.default_rng(7)
    x = np.floor(64 * np.array([v for _, v in clumps(rng, 2000)])).astype(np.int64)
    cents = shallot.Centroids(x[:16].tolist())
    state = np.zeros(2000, np.int32), np.ones(2000, np.int32), np.full(2000, np.inf), np.zeros(2000)
    first = shallot.shallot_step(x, cents, *state)
    assert first < 2000 * 16
    assert shallot.shallot_step(x, cents, *state) < 100
    apart = ((x[:, None] - cents.exact[None]) ** 2).sum(2)
    assert (state[0] == apart.argmin(1)).all()
    assert (state[2] ** 2 >= apart.min(1)).all()
    assert (state[3] ** 2 <= np.partition(apart, 1, 1)[:, 1]).all()


def test_query(spark, small):
    rows = [(r.vec_id, r.embedding) for r in table(spark, small, "embeddings").collect()]
    expected, cents = plain(rows)
    found = queries.QUERIES["op11_shallot_clusters"](spark, small)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found.collect()) == sorted(expected)
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("s"), F.max("cluster_inertia").alias("i"), F.max("inertia").alias("t"), F.max("centroid_sha256").alias("h"))
    for r in sums.collect():
        assert r.s == r.i and r.t == sum(d for *_, d in expected)
        assert r.h == sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest()
