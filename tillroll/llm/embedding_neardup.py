"""Near-duplicate vectors by cosine, through a pigeonhole join on rotated subspaces.

Unit vectors with cosine c lie at squared distance 2 - 2c. After a random
rotation, which spreads distance evenly, the coordinates are split into blocks:
a pair within the squared distance D is, in some block, within D times the
block's share of the dimensions. Each block is joined by range: a k-d tree from
a bounded sample cuts it into cells, a vector lives in one cell and visits the
cells of higher number that its ball reaches, so every pair within the block's
budget meets exactly once. Where it meets, the pair is verified by its cosine,
and it counts in the first block whose budget it keeps. Cells hand on, for each
vector, its number of links and one link towards the smallest vector of its
local group: no pair is ever written. Equal vectors are one vector with a count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.sources.workspace import land

LEAST_COSINE = 0.93
BLOCKS = 8
#: Vectors of one label per cell aimed at, and the most cells of a tree.
CELL_ROWS = 1500
MAX_CELLS = 1024
#: Sampled vectors for the trees (chosen by a hash) at most about, never more than a quarter of all.
SAMPLE_ROWS = 20_000
#: Members of a cell in one group; larger cells are dealt over several groups.
GROUP_ROWS = 2000
_SLACK = 1e-9


def rotation(dimensions: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def block_edges(dimensions: int, blocks: int = BLOCKS) -> list[int]:
    """First coordinates of the blocks, and the end; blocks differ by one coordinate at most."""
    blocks = min(blocks, dimensions)
    return [round(i * dimensions / blocks) for i in range(blocks + 1)]


class Tree:
    """A k-d tree over one block: inner nodes (coordinate, border, low, high); ~cell stands for a cell."""

    def __init__(self, points: np.ndarray, cells: int):
        self.nodes: list[list] = []
        self.sizes: list[int] = []
        self._points = points
        self._grow(np.arange(len(points)), cells)
        del self._points

    def _grow(self, rows: np.ndarray, cells: int) -> int:
        if cells >= 2 and len(rows) >= 8:
            own = self._points[rows]
            axis = int(np.argmax(own.var(axis=0)))
            border = float(np.median(own[:, axis]))
            low = own[:, axis] <= border
            if 0 < low.sum() < len(rows):
                at = len(self.nodes)
                self.nodes.append([axis, border, 0, 0])
                self.nodes[at][2] = self._grow(rows[low], cells // 2)
                self.nodes[at][3] = self._grow(rows[~low], cells - cells // 2)
                return at
        self.sizes.append(len(rows))
        return ~(len(self.sizes) - 1)

    def visits(self, points: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, home?) for all cells within ``reach`` of each point, by distance to the cell's box."""
        todo = [(0 if self.nodes else ~0, np.arange(len(points)), np.zeros(len(points)), np.ones(len(points), bool), {})]
        rows, cells, homes = [], [], []
        while todo:
            at, some, far, home, beyond = todo.pop()
            if not len(some):
                continue
            if at < 0:
                rows.append(some)
                cells.append(np.full(len(some), ~at))
                homes.append(home)
                continue
            axis, border, low, high = self.nodes[at]
            gap = points[some, axis] - border
            for child, outside in ((low, np.maximum(gap, 0)), (high, np.maximum(-gap, 0))):
                side = gap <= 0 if child == low else gap > 0
                # What this axis adds replaces what it added before (the box only shrinks).
                before = beyond.get(axis, np.zeros(len(some)))
                now = np.maximum(before, outside)
                total = far + now**2 - before**2
                keep = total <= reach * reach * (1 + _SLACK) + _SLACK
                inner = {a: b[keep] for a, b in beyond.items()}
                inner[axis] = now[keep]
                todo.append((child, some[keep], total[keep], (home & side)[keep], inner))
        return np.concatenate(rows), np.concatenate(cells), np.concatenate(homes)


def _units(batch_column: pa.Array) -> np.ndarray:
    """Binary vectors of equal length as unit rows in double precision."""
    joined = b"".join(batch_column.to_pylist())
    rows = np.frombuffer(joined, "<f8").reshape(len(batch_column), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _packed(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(k, label, size, v): v holds the doubles of a usable vector, else null."""
    rows = vectors.select(
        F.col(key).alias("k"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("e")
    )
    usable = "label IS NOT NULL AND e IS NOT NULL AND size(e) > 0"
    rows = rows.select("k", "label", F.expr(f"CASE WHEN {usable} THEN e END").alias("e"))
    schema = rows.select("k", "label").schema.add("size", "integer").add("v", "binary")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, sizes = [], []
            for e in batch.column(2).to_pylist():
                found = None
                if e is not None and all(x is not None for x in e):
                    row = np.array(e, "<f8")
                    if np.isfinite(row).all() and row.any():
                        with np.errstate(over="ignore", under="ignore"):
                            norm = np.linalg.norm(row)
                            if not 1e-100 < norm < 1e100:
                                # The cosine is that of the vector over a power of two.
                                row = np.ldexp(row, -int(np.frexp(np.abs(row).max())[1]))
                        found = (row + 0.0).tobytes()
                packed.append(found)
                sizes.append(len(e) if found else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())],
                names=["k", "label", "size", "v"],
            )

    return rows.mapInArrow(pack, schema)


def _trees(sample: pa.Table, total: int) -> dict:
    """Trees of each (label, size) that is larger than a cell: {(label, size): (groups per cell, trees)}."""
    found: dict = {}
    share = max(1e-12, sample.num_rows / max(1, total))
    by: dict = {}
    for label, size, v in zip(*(sample.column(c).to_pylist() for c in ("label", "size", "v"))):
        by.setdefault((label, size), []).append(v)
    for name, rows in by.items():
        n = len(rows) / share
        cells = min(MAX_CELLS, 1 << max(0, int(np.log2(max(1.0, n / CELL_ROWS)))))
        if n <= CELL_ROWS:
            continue
        points = _units(pa.array(rows, pa.binary())) @ rotation(name[1])
        edges = block_edges(name[1])
        trees = [Tree(points[:, a:b], cells) for a, b in zip(edges, edges[1:])]
        parts = [
            [max(1, round(size / len(rows) * n / GROUP_ROWS)) for size in tree.sizes] for tree in trees
        ]
        found[name] = (trees, parts)
    return found


def _budgets(size: int, distance: float) -> tuple[list[int], np.ndarray]:
    edges = block_edges(size)
    return edges, distance * np.diff(edges) / size


def _deal(batch: pa.RecordBatch, trees: dict, distance: float) -> pa.RecordBatch:
    """Rows (label, size, block, cell, part, home, r, w, v): where each vector lives and visits."""
    labels = batch.column(0).to_pylist()
    sizes = batch.column(1).to_pylist()
    out: dict[str, list] = {c: [] for c in ("row", "block", "cell", "part", "home")}
    groups: dict = {}
    for i, name in enumerate(zip(labels, sizes)):
        groups.setdefault(name, []).append(i)
    for name, members in groups.items():
        members = np.array(members)
        edges, budgets = _budgets(name[1], distance)
        points = _units(batch.column(4).take(pa.array(members))) @ rotation(name[1])
        ids = batch.column(2).take(pa.array(members)).to_numpy()
        own = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        for block, (a, b) in enumerate(zip(edges, edges[1:])):
            if name in trees:
                tree, parts = trees[name][0][block], np.array(trees[name][1][block])
                rows, cells, home = tree.visits(points[:, a:b], float(np.sqrt(budgets[block])))
            else:
                rows, cells, home = np.arange(len(members)), np.zeros(len(members), np.int64), np.ones(len(members), bool)
                parts = np.array([1])
            homes = np.zeros(len(members), np.int64)
            homes[rows[home]] = cells[home]
            up = home | (cells > homes[rows])
            rows, cells, home = rows[up], cells[up], home[up]
            part = (own[rows] % parts[cells].astype(np.uint64)).astype(np.int64)
            # A visitor meets all parts of a foreign cell, and the parts above its own at home.
            first = np.where(home, part, 0)
            many = parts[cells] - first
            at = np.repeat(np.arange(len(rows)), many)
            step = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            out["row"].append(members[rows[at]])
            out["block"].append(np.full(len(at), block))
            out["cell"].append(cells[at])
            out["part"].append(first[at] + step)
            out["home"].append(home[at] & (step == 0))
    flat = {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()}
    take = pa.array(flat["row"].astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(take),
            batch.column(1).take(take),
            pa.array(flat["block"].astype(np.int32)),
            pa.array(flat["cell"].astype(np.int32)),
            pa.array(flat["part"].astype(np.int32)),
            pa.array(flat["home"].astype(bool)),
            batch.column(2).take(take),
            batch.column(3).take(take),
            batch.column(4).take(take),
        ],
        names=["label", "size", "block", "cell", "part", "home", "r", "w", "v"],
    )


def _meet(group: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, links of each, an id of its local group): verified pairs of one group, home with home and visitors."""
    size = group.column("size")[0].as_py()
    block = group.column("block")[0].as_py()
    edges, budgets = _budgets(size, 2 - 2 * least)
    budgets = budgets * (1 + _SLACK) + _SLACK
    home = group.column("home").to_numpy()
    order = np.concatenate((np.flatnonzero(home), np.flatnonzero(~home)))
    ids = group.column("r").to_numpy()[order]
    weights = group.column("w").to_numpy()[order]
    units = _units(group.column("v").combine_chunks().take(pa.array(order)))
    turned = units @ rotation(size)
    n_home = int(home.sum())
    links = np.zeros(len(ids), np.int64)
    up = np.arange(len(ids))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    a, b = edges[block], edges[block + 1]
    part = turned[:, a:b]
    squares = (part**2).sum(axis=1)
    for at in range(0, n_home, 256):
        end = min(at + 256, n_home)  # visitors do not meet each other here
        some = part[at:end]
        near = squares[at:end, None] + squares[None, at:] - 2 * (some @ part[at:].T)
        i, j = np.nonzero(near <= budgets[block] + 1e-6)
        i, j = i + at, j + at
        keep = i < j
        i, j = i[keep], j[keep]
        for s in range(0, len(i), 65536):
            p, q = i[s : s + 65536], j[s : s + 65536]
            apart = (turned[p] - turned[q]) ** 2
            by_block = np.add.reduceat(apart, edges[:-1], axis=1)
            within = by_block <= budgets
            mine = within[:, block] & (within.argmax(axis=1) == block)
            p, q = p[mine], q[mine]
            true = np.einsum("ij,ij->i", units[p], units[q]) >= least
            p, q = p[true], q[true]
            np.add.at(links, p, weights[q])
            np.add.at(links, q, weights[p])
            for x in np.unique(p):
                # One union for each member: all its partners join the smallest tree among them.
                partners = np.unique(np.append(q[p == x], x))
                roots = {root(int(y)) for y in partners}
                least_root = min(roots)
                for y in roots:
                    up[y] = least_root
    top = np.array([root(i) for i in range(len(ids))], np.int64)
    return ids, links, ids[top]


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = LEAST_COSINE,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per row of ``vectors``: ``key``, n_links, component_id, kept.

    Vectors link if their labels are equal and their cosine is ``least`` or more.
    Null labels, and vectors that are null, empty, zero or hold null or
    non-finite components, link with nothing; neither do vectors of different
    length. Repeated rows count as vectors of their own. Keys are integers; null
    keys form no link. Other columns are left out, so clashing names do no harm.
    """
    packed = land(_packed(vectors, key, vector, label), "vectors")
    usable = packed.where("v IS NOT NULL AND k IS NOT NULL")
    reps = usable.groupBy("label", "size", "v").agg(F.min("k").alias("r"), F.count("*").alias("w"))
    reps = land(reps.select("label", "size", "r", "w", "v"), "distinct-vectors")
    n = reps.count()
    share = min(0.25, sample_rows / max(1, n))
    place = F.pmod(F.xxhash64("v"), F.lit(1 << 30))
    sample = reps.where(place < int(share * (1 << 30))).select("label", "size", "v").limit(2 * sample_rows).toArrow()
    trees = _trees(sample, n)
    distance = 2 - 2 * least
    kind = reps.schema["label"].dataType.simpleString()

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield _deal(batch.slice(at, 1024), trees, distance)

    def meet(group: pa.Table) -> pa.Table:
        ids, links, tops = _meet(group, least)
        told = (links > 0) | (tops != ids)
        return pa.table({"r": ids[told], "links": links[told], "top": tops[told]})

    dealt = reps.mapInArrow(
        deal, f"label {kind}, size int, block int, cell int, part int, home boolean, r long, w long, v binary"
    )
    found = land(
        dealt.groupBy("label", "size", "block", "cell", "part").applyInArrow(meet, "r long, links long, top long"),
        "vector-links",
    )
    links = found.groupBy("r").agg(F.sum("links").alias("links"))
    roots = components(found, "r", "top")
    told = reps.join(links, "r", "left").join(roots, reps.r == roots.node, "left")
    told = land(
        told.select("label", "size", "v", "w", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "r").alias("root")),
        "told-vectors",
    )
    same = ["label", "size", "v"]
    rows = packed.join(told, same, "left")
    linked = F.col("root").isNotNull() & F.col("k").isNotNull()
    component = F.when(linked, F.col("root")).otherwise(F.col("k").cast("long"))
    return rows.select(
        F.col("k").alias(key),
        F.when(linked, F.col("links") + F.col("w") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("k") == component, F.lit(True)).alias("kept"),
    )
