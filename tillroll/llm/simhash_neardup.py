"""SimHash fingerprints of word shingles, linked through vantage-point shards.

Equal fingerprints are counted once. A tree of vantage points, built from a
bounded sample, parts the fingerprint space into shards: a fingerprint within
the radius ``t`` of a node's vantage point goes to the inner branch, any other
to the outer one. By the triangle inequality two fingerprints at distance 2 or
less can part only where the inner one lies within 1 of the border, so those
alone are sent to both branches: every linked pair meets in some shard. The
same rule prunes a smaller tree inside each shard, whose leaves are compared
exactly. A shard returns a spanning forest of its links (a row for each member
at most, however many pairs there are) and components join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tillroll.llm.common import add_columns
from tillroll.llm.components import components
from tillroll.sources.workspace import land

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: Fingerprints per shard aimed at, and the most shards (and so the largest tree sent to tasks).
SHARD_ROWS = 2000
MAX_SHARDS = 8192
#: Sampled fingerprints per shard for the tree: at most 32 x 8192 = 262,144 go to the driver,
#: and never more than a quarter of all.
SAMPLE_PER_SHARD = 32
_HASHES_AT_ONCE = 200_000


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of one text."""
    return int(fingerprints([text], shingle_words, seed)[0])


def fingerprints(texts: list[str], shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """SimHash of each text: words after lower-casing A-Z, shingles with repeats, XXH64.

    A bit is set if it is set in more than half of the shingle hashes. Texts with
    fewer words than a shingle hash the whole sequence; without words: zero.
    """
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split()
        n = len(words)
        if not n:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        size = min(shingle_words, n)
        starts = np.concatenate(([0], ends[:-1] + 1))[: n - size + 1]
        total, half = np.zeros(64, np.int64), n - size + 1
        for at in range(0, half, _HASHES_AT_ONCE):
            some = slice(at, at + _HASHES_AT_ONCE)
            hashes = np.array(
                [
                    digest(joined[s:e], seed)
                    for s, e in zip(starts[some].tolist(), ends[size - 1 :][some].tolist())
                ],
                dtype=">u8",
            )
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
            total += bits.sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * total > half).view(">u8")[0]
    return out


def add_fingerprint(docs: DataFrame, text: str = "text", name: str = "simhash") -> DataFrame:
    """Append the fingerprint of ``text`` as a signed long with the same 64 bits (null text: 0)."""

    def compute(batch: pa.RecordBatch) -> list:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        return [pa.array(fingerprints(texts).view(np.int64))]

    return add_columns(docs, [text], [(name, LongType())], compute)


# --- vantage-point trees -------------------------------------------------------------------


def _distance(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point)


def _split(values: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that part ``values`` best, or None if nothing parts them.

    A few members are tried. What counts is the size of the two branches with
    the copies along the border.
    """
    best, best_cost = None, 0.95 * float(len(values)) ** 2
    for point in rng.choice(values, size=min(5, len(values)), replace=False):
        counts = np.bincount(_distance(values, point), minlength=65)
        inner = np.cumsum(counts).astype(float)
        border = counts + np.concatenate(([0], counts[:-1]))
        outer = len(values) - inner + border
        cost = inner**2 + outer**2
        cost[(inner == 0) | (inner == len(values))] = np.inf
        at = int(np.argmin(cost))
        if cost[at] < best_cost:
            best, best_cost = (point, at), cost[at]
    return best


def build_tree(sample: np.ndarray, shards: int, seed: int = 7) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage point, radius, inner child, outer child); a child below 0 is shard -1 - child.

    ``shards`` is a wish: branches that nothing parts stay whole.
    """
    rng = np.random.default_rng(seed)
    nodes: list[list[int]] = []
    ends = 0
    leaf_size = max(4.0, len(sample) / max(1, shards))
    todo: list[tuple[np.ndarray, int, int]] = [(sample, -1, 0)]
    while todo:
        values, parent, side = todo.pop()
        found = _split(values, rng) if len(values) > leaf_size and shards > 1 else None
        if found is None or len(nodes) >= 4 * shards:
            ends += 1
            child = -ends
        else:
            point, radius = found
            far = _distance(values, point)
            child = len(nodes)
            nodes.append([int(point), int(radius), 0, 0])
            todo.append((values[far <= radius], child, 2))
            todo.append((values[far >= radius - MAX_BITS + 1], child, 3))
        if parent >= 0:
            nodes[parent][side] = child
    return [tuple(n) for n in nodes]


def route(values: np.ndarray, tree: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(index into values, shard): each value's own shard and those that its border reaches."""
    if not tree:
        return np.arange(len(values)), np.zeros(len(values), np.int64)
    found: list[tuple[np.ndarray, int]] = []
    todo = [(0, np.arange(len(values)))]
    while todo:
        at, rows = todo.pop()
        if not len(rows):
            continue
        if at < 0:
            found.append((rows, -1 - at))
            continue
        point, radius, inner, outer = tree[at]
        far = _distance(values[rows], np.uint64(point))
        todo.append((inner, rows[far <= radius]))
        todo.append((outer, rows[far >= radius - MAX_BITS + 1]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (
        np.concatenate([rows for rows, _ in found]),
        np.concatenate([np.full(len(rows), shard, np.int64) for rows, shard in found]),
    )


class _Forest:
    """Union of indices, the smallest index of each tree being its root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def shard_forest(values: np.ndarray, leaf: int = 256) -> list[tuple[int, int]]:
    """Links of a spanning forest over sorted distinct fingerprints at ``MAX_BITS`` or less.

    The vantage-point rule is applied again until leaves are small; members of a
    leaf that nothing parts are compared in blocks of 256 rows.
    """
    rng = np.random.default_rng(len(values))
    forest = _Forest(len(values))
    todo = [np.arange(len(values))]
    while todo:
        rows = todo.pop()
        found = _split(values[rows], rng) if len(rows) > leaf else None
        if found is not None:
            far = _distance(values[rows], found[0])
            todo += [rows[far <= found[1]], rows[far >= found[1] - MAX_BITS + 1]]
            continue
        own = values[rows]
        for at in range(0, len(rows), 256):
            near = np.bitwise_count(own[at : at + 256, None] ^ own[None, at:]) <= MAX_BITS
            for a, b in zip(*np.nonzero(near)):
                if a < b:
                    forest.join(int(rows[at + a]), int(rows[at + b]))
    return [(i, r) for i in range(len(values)) if (r := forest.root(i)) != i]


def _links(prints: DataFrame, shards: int | None, sample: int | None) -> DataFrame:
    """(a, b): spanning links of all fingerprints in the column ``f`` (distinct)."""
    n = prints.count()
    shards = shards or max(1, min(MAX_SHARDS, round(n / SHARD_ROWS)))
    wanted = min(sample or SAMPLE_PER_SHARD * shards, max(1, n // 4))
    tree: list[tuple[int, int, int, int]] = []
    if shards > 1:
        part = F.pmod(F.xxhash64("f"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, wanted / n)))
        picked = prints.where(part).limit(2 * wanted).toArrow()
        tree = build_tree(np.sort(picked.column("f").to_numpy()).view(np.uint64), shards)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            rows, shard = route(values.view(np.uint64), tree)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(values[rows])], ["shard", "f"])

    def pairs(key: tuple, group: pa.Table) -> pa.Table:
        values = np.unique(group.column("f").to_numpy().view(np.uint64))
        found = np.array(shard_forest(values), np.int64).reshape(-1, 2)
        ends = values.view(np.int64)
        return pa.table({"a": ends[found[:, 0]], "b": ends[found[:, 1]]})

    dealt = prints.mapInArrow(deal, "shard long, f long")
    return dealt.groupBy("shard").applyInArrow(pairs, "a long, b long")


def link_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
    sample: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``simhash`` (long) and ``component_id``.

    ``component_id`` is the smallest key whose fingerprint is reachable over
    links of two or fewer differing bits. Null and empty texts have fingerprint
    zero and link like any other. Repeated rows stay; a null key takes part in
    linking but names no component (null if a component has no other key). An
    empty table gives an empty result. Other columns are left out, so clashing
    names do no harm.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    rows = land(add_fingerprint(rows, "t", "f").select("k", "f"), "fingerprints")
    prints = land(rows.groupBy("f").agg(F.min("k").alias("first")), "prints")
    roots = components(_links(prints.select("f"), shards, sample), "a", "b")
    named = prints.join(roots, prints.f == roots.node, "left").select(
        "f", "first", F.coalesce("root", "f").alias("root")
    )
    named = land(named, "named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = land(named.join(least, "root").select("f", "component_id"), "components")
    return rows.join(by_print, "f").select(
        F.col("k").alias(key), F.col("f").alias("simhash"), "component_id"
    )


def keep_first(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
    sample: int | None = None,
) -> DataFrame:
    """The rows of ``docs`` that come first in their near-duplicate group, all columns kept.

    First is the row with the smallest key (null keys come last). Of repeated rows
    with that key exactly one stays. Links are those of ``link_documents``.
    """
    packed = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.struct("*").alias("row"))
    printed = add_fingerprint(packed, "t", "f").select(
        "k", "f", F.monotonically_increasing_id().alias("place"), "row"
    )
    printed = land(printed, "printed")  # places are fixed from here on
    keys = printed.select("k", "f", "place")
    prints = land(keys.select("f").distinct(), "prints")
    roots = components(_links(prints, shards, sample), "a", "b")
    named = prints.join(roots, prints.f == roots.node, "left").select("f", F.coalesce("root", "f").alias("root"))
    named = land(named, "named")
    grouped = keys.join(named, "f")
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("k").isNull(), "k", "place")).alias("first"))
    firsts = land(first.select(F.col("first.place").alias("place")), "firsts")
    return printed.join(firsts, "place", "left_semi").select("row.*")
