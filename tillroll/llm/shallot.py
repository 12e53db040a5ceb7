"""Exact k-means over integer vectors by Shallot search.

Each vector keeps its centroid, its second-nearest centroid, an upper bound of the
distance to the first and a lower bound of the distance to all others. When
centroids move, the bounds move by as much; a vector whose bounds still exclude
every other centroid is not looked at. Otherwise the scan starts from the closer
of the two remembered centroids: the others are taken in rising distance from it,
and the ball that can hold a nearer or second-nearest one shrinks with each find
(Borgelt, "Even Faster Exact k-Means Clustering"). Distances of centroids that are
left are compared as integers, so ties and bounds are exact; floating point only
prunes, with a margin.

Each round reads the vectors with their bounds, writes them anew, and sums them per
centroid in the tasks; the driver sees a few numbers for each component of each
centroid.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tillroll.sources.workspace import land

CLUSTERS = 16
ROUNDS = 3
COMPONENTS = 64
SCALE = 64

#: Components and centroids below this are compared in 64 bits (up to 64 components), others in Python's integers.
_NARROW = 1 << 27
_FAR = 1e300
_MARGIN = 1e-12
_LIMB = 30
_BOUNDS = [
    StructField("cluster", IntegerType()),
    StructField("second", IntegerType()),
    StructField("upper", DoubleType()),
    StructField("lower", DoubleType()),
]


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    apart = x - y
    return (apart * apart).sum(axis=1)


def _roots(squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A lower and an upper bound of each square root; beyond 1e300 both are 1e300."""
    if squared.dtype != object:
        root = np.sqrt(squared.astype(np.float64))
        return root * (1 - _MARGIN), root * (1 + _MARGIN)
    whole = [math.isqrt(int(v)) for v in squared]
    near = [_FAR if v >= 10**300 else float(v) for v in whole]
    root = np.array(near, np.float64)
    return np.minimum(root * (1 - _MARGIN), _FAR), np.minimum((root + 1) * (1 + _MARGIN), _FAR)


class Centroids:
    """Integer centroids, and for each one the others in rising distance from it."""

    def __init__(self, places: list[list[int]]):
        self.places = places
        self.wide = any(abs(v) >= _NARROW for row in places for v in row)
        self.exact = np.array(places, object if self.wide else np.int64)
        k = len(places)
        apart = np.zeros((k, k))
        for i in range(k):
            apart[i] = _roots(_squared(self.exact, self.exact[i]))[0]
        self.order = np.array([sorted((j for j in range(k) if j != i), key=lambda j: (apart[i, j], j)) for i in range(k)])
        self.apart = np.array([[apart[i, j] for j in self.order[i]] for i in range(k)])

    def moved_from(self, before: Centroids) -> np.ndarray:
        """How far each centroid is from where it was, at most."""
        both = self.wide or before.wide
        kind = object if both else np.int64
        return _roots(_squared(self.exact.astype(kind), before.exact.astype(kind)))[1]


def shallot_step(
    vectors: np.ndarray,
    centroids: Centroids,
    cluster: np.ndarray,
    second: np.ndarray,
    upper: np.ndarray,
    lower: np.ndarray,
) -> int:
    """Bring assignments and bounds, in place, to the given centroids; returns the distances computed.

    ``upper`` and ``lower`` must already allow for the centroids' moves. Of equally
    near centroids the one with the smaller number is taken.
    """
    k = len(centroids.places)
    if k == 1:
        cluster[:] = 0
        second[:] = -1
        return 0
    exact = centroids.exact
    if vectors.dtype == object or exact.dtype == object:
        vectors, exact = vectors.astype(object), exact.astype(object)
    # Half the distance to the nearest other centroid excludes all others, too.
    excluded = np.maximum(lower, centroids.apart[cluster, 0] / 2 * (1 - _MARGIN))
    rows = np.flatnonzero(upper >= excluded)
    if not len(rows):
        return 0
    first = _squared(vectors[rows], exact[cluster[rows]])
    computed = len(rows)
    upper[rows] = _roots(first)[1]
    open_ = upper[rows] >= excluded[rows]
    rows, first = rows[open_], first[open_]
    if not len(rows):
        return computed
    x = vectors[rows]
    near, far = cluster[rows].copy(), second[rows].copy()
    other = _squared(x, exact[far])
    computed += len(rows)
    swap = (other < first) | ((other == first) & (far < near))
    near, far = np.where(swap, far, near), np.where(swap, near, far)
    first, other = np.where(swap, other, first), np.where(swap, first, other)
    start = near.copy()
    from_start = _roots(first)[1]
    reach = from_start + _roots(other)[1]
    live = np.arange(len(rows))
    for step in range(k - 1):
        live = live[centroids.apart[start[live], step] <= reach[live]]
        if not len(live):
            break
        candidate = centroids.order[start[live], step]
        new = candidate != far[live]
        ids, candidate = live[new], candidate[new]
        if not len(ids):
            continue
        found = _squared(x[ids], exact[candidate])
        computed += len(ids)
        closer = (found < first[ids]) | ((found == first[ids]) & (candidate < near[ids]))
        up = ids[closer]
        far[up], other[up] = near[up], first[up]
        near[up], first[up] = candidate[closer], found[closer]
        beside = ~closer & ((found < other[ids]) | ((found == other[ids]) & (candidate < far[ids])))
        at = ids[beside]
        far[at], other[at] = candidate[beside], found[beside]
        changed = np.concatenate([up, at])
        reach[changed] = from_start[changed] + _roots(other[changed])[1]
    cluster[rows], second[rows] = near, far
    upper[rows], lower[rows] = _roots(first)[1], _roots(other)[0]
    return computed


def _integers(column: pa.Array, components: int, scale: int) -> tuple[list, list]:
    """floor(scale * x) of each vector: as 64-bit integers, or as texts where these are too narrow."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), components)
    with np.errstate(over="ignore"):
        grown = np.floor(flat * scale)
    wide = ~(np.abs(grown) < float(1 << 62)).all(axis=1)
    narrow = np.where(wide[:, None], 0, grown).astype(np.int64)
    texts = [None] * len(column)
    for i in np.flatnonzero(wide):
        texts[i] = [str(math.floor(v * scale) if abs(v) < 1e15 else int(v) * scale) for v in flat[i].tolist()]
    return list(narrow), texts


def integer_vectors(vectors: DataFrame, key: str, vector: str, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(id, ints, wide): the vectors of so many components, none null or non-finite, as floor(scale * x).

    ``wide`` holds the integers as texts where one of them passes 62 bits, else it is null.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = vectors.where(x.isNotNull() & (F.size(x) == components) & finite)
    chosen = usable.select(F.col(key).alias("id"), x.cast("array<double>").alias("x"))
    schema = StructType(
        [
            StructField("id", chosen.schema["id"].dataType),
            StructField("ints", ArrayType(LongType())),
            StructField("wide", ArrayType(StringType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ints, wide = _integers(batch.column(1), components, scale)
                columns = [batch.column(0), pa.array(ints, arrow.field(1).type), pa.array(wide, arrow.field(2).type)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return chosen.mapInArrow(run, schema)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's integer vectors, in Python's integers if one needs them."""
    ints = batch.column("ints")
    rows = ints.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    wide = batch.column("wide")
    if wide.null_count < batch.num_rows:
        rows = rows.astype(object)
        for i, texts in enumerate(wide.to_pylist()):
            if texts is not None:
                rows[i] = [int(t) for t in texts]
    elif rows.size and np.abs(rows).max() >= _NARROW:
        rows = rows.astype(object)
    return rows


def _assigned(state: DataFrame, centroids: Centroids, moved: np.ndarray | None, final: bool) -> DataFrame:
    """The vectors with assignments and bounds for these centroids; finally with distances instead."""
    kept = [f for f in state.schema.fields if f.name in ("id", "ints", "wide")]
    if final:
        schema = StructType([kept[0], _BOUNDS[0], StructField("distance", LongType())])
    else:
        schema = StructType(kept + _BOUNDS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch)
            if moved is None:
                # Nothing is known yet: a scan from any two centroids.
                cluster, second = np.zeros(n, np.int32), np.ones(n, np.int32)
                upper, lower = np.full(n, np.inf), np.zeros(n)
            else:
                cluster, second = (batch.column(c).to_numpy().copy() for c in ("cluster", "second"))
                upper, lower = (batch.column(c).to_numpy().copy() for c in ("upper", "lower"))
                upper = (upper + moved[cluster]) * (1 + _MARGIN)
                most, next_most = _two_largest(moved)
                lower = (lower - np.where(moved[cluster] == most, next_most, most)) * (1 - _MARGIN)
            shallot_step(x, centroids, cluster, second, upper, lower)
            if final:
                exact = centroids.exact.astype(object) if x.dtype == object else centroids.exact
                apart = _squared(x.astype(exact.dtype), exact[cluster])
                distances = [int(v) if v < 1 << 63 else None for v in apart.tolist()]
                columns = [batch.column("id"), pa.array(cluster), pa.array(distances, pa.int64())]
            else:
                columns = [batch.column(f.name) for f in kept]
                columns += [pa.array(v) for v in (cluster, second, upper, lower)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return state.mapInArrow(run, schema)


def _two_largest(moved: np.ndarray) -> tuple[float, float]:
    """The largest move, and the next one (the largest again if two centroids moved as far)."""
    ranked = np.sort(moved)[::-1]
    return float(ranked[0]), float(ranked[1]) if len(ranked) > 1 else 0.0


def _sums(state: DataFrame, components: int) -> dict[tuple[int, int], int]:
    """Exact sum of each component of each cluster; component -1 is the number of vectors.

    Tasks sum with Python's integers and send limbs of 30 bits, which Spark adds up.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cluster = _matrix(batch), batch.column("cluster").to_numpy()
            for c in np.unique(cluster).tolist():
                mine = x[cluster == c]
                row = np.array([len(mine), *mine.sum(axis=0).tolist()], object)
                totals[c] = totals[c] + row if c in totals else row
        rows = []
        for c, row in totals.items():
            for at, total in enumerate(row.tolist()):
                sign, rest, limb = (-1 if total < 0 else 1), abs(total), 0
                while rest:
                    rows.append((c, at - 1, limb, sign * (rest & ((1 << _LIMB) - 1))))
                    rest >>= _LIMB
                    limb += 1
        columns = [pa.array(list(x), pa.int64()) for x in zip(*rows)] or [pa.array([], pa.int64())] * 4
        yield pa.RecordBatch.from_arrays(columns, names=["c", "at", "limb", "v"])

    limbs = state.select("ints", "wide", "cluster").mapInArrow(run, "c long, at long, limb long, v long")
    found: dict[tuple[int, int], int] = defaultdict(int)
    for r in limbs.groupBy("c", "at", "limb").agg(F.sum("v").alias("v")).collect():
        found[r.c, r.at] += r.v << (_LIMB * r.limb)
    return found


def _recentred(state: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid at its vectors' mean, rounded down; one without vectors stays."""
    components = len(centroids.places[0])
    sums = _sums(state, components)
    places = [
        [sums[c, i] // sums[c, -1] for i in range(components)] if sums.get((c, -1)) else place
        for c, place in enumerate(centroids.places)
    ]
    return Centroids(places)


def first_centroids(vectors: DataFrame, k: int) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of ``1:<key>``, in its order.

    Vectors that share a key are told apart by their components; a null key counts as an empty text.
    """
    name = F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    ranked = vectors.select(F.sha2(name, 256).alias("h"), "ints", "wide").orderBy("h", "ints", "wide").limit(k)
    return [[int(v) for v in (r.wide or r.ints)] for r in ranked.collect()]


@dataclass(frozen=True)
class Clustering:
    """``vectors`` holds (key, cluster, distance); ``centroids`` and ``inertias`` go by cluster number.

    An inertia is the sum of its vectors' squared distances, 0 for a centroid without
    vectors; it is None if one of them is.
    """

    vectors: DataFrame
    centroids: list[list[int]]
    inertias: list[int | None]

    @property
    def inertia(self) -> int | None:
        return None if None in self.inertias else sum(self.inertias)

    def digests(self) -> list[str]:
        """SHA-256 of each centroid's components as decimal numbers joined by commas."""
        return [sha256(",".join(map(str, place)).encode()).hexdigest() for place in self.centroids]


def shallot_clusters(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> Clustering:
    """k-means over every usable vector, from the ``first_centroids``, for so many rounds.

    Usable are vectors of ``components`` components, none null or non-finite; others
    have no row. With fewer vectors than ``k`` there are fewer centroids; an empty
    table gives an empty one. Of equally near centroids the smaller number is taken,
    and a centroid without vectors stays where it is. Repeated rows are vectors of their
    own, null keys stay. Distances are squared; one that passes 64 bits is null. Only
    the key and the vector are read, so further columns may have any names.
    """
    # The parts stay as they are read: assigning needs no shuffle.
    state = land(integer_vectors(vectors, key, vector, components, scale), "int-vectors")
    places = first_centroids(state, k)
    if not places:
        none = StructType([StructField(key, vectors.schema[key].dataType), _BOUNDS[0], StructField("distance", LongType())])
        return Clustering(vectors.sparkSession.createDataFrame([], none), [], [])
    centroids, moved = Centroids(places), None
    for _ in range(rounds):
        state = land(_assigned(state, centroids, moved, False), "assigned-vectors")
        fresh = _recentred(state, centroids)
        centroids, moved = fresh, fresh.moved_from(centroids)
    found = land(_assigned(state, centroids, moved, True), "clustered-vectors")
    # One row for each centroid.
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    complete = F.count("distance") == F.count("*")
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.when(complete, whole).alias("s")).collect()}
    inertias = [None if sums.get(c, 0) is None else int(sums.get(c, 0)) for c in range(len(places))]
    return Clustering(found.withColumnRenamed("id", key), centroids.places, inertias)
