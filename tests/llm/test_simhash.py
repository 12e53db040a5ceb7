import random

import numpy as np
import pytest
import xxhash
from edge import SCHEMA, edge_docs, edge_rows, empty_docs

from tillroll.llm import simhash_neardup as sh


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ")
    for blank in "\t\n\x0b\x0c\r":
        words = [w for word in words for w in word.split(blank)]
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values):
    """Smallest index reachable over links of two bits or fewer."""
    forest = sh._Forest(len(values))
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[:i]) <= 2):
            forest.join(i, int(j))
    return [forest.root(i) for i in range(len(values))]


def near_values(rng, n):
    """Clusters of close fingerprints among scattered ones."""
    values = set()
    while len(values) < n:
        seed = rng.getrandbits(64)
        values.add(seed)
        for _ in range(rng.choice([0, 0, 1, 12])):
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                seed ^= 1 << bit
            values.add(seed)
    return np.array(sorted(values), np.uint64)


def test_fingerprint():
    for row in edge_rows():
        assert sh.fingerprint(row[1] or "") == plain_fingerprint(row[1])


@pytest.mark.parametrize("seed", range(4))
def test_shards_lose_no_link(seed):
    values = near_values(random.Random(seed), 1500)
    tree = sh.build_tree(values[::4], 16)
    rows, shards = sh.route(values, tree)
    assert len(set(shards.tolist())) > 4
    forest = sh._Forest(len(values))
    for shard in np.unique(shards):
        members = np.sort(rows[shards == shard])
        for a, b in sh.shard_forest(values[members], leaf=32):
            forest.join(int(members[a]), int(members[b]))
    assert [forest.root(i) for i in range(len(values))] == plain_roots(values)


def test_documents_and_edge_rows(spark):
    rng = random.Random(9)
    rows = edge_rows()
    for i in range(100, 220):
        words = [f"w{rng.randint(0, 400)}" for _ in range(200)]
        rows.append((i, " ".join(words), *rows[0][2:]))
        words[rng.randint(0, 199)] = "other"
        rows.append((i + 1000, " ".join(words), *rows[0][2:]))
    docs = spark.createDataFrame(rows, SCHEMA)
    prints = [plain_fingerprint(r[1]) for r in rows]
    values = np.array(sorted(set(prints)), np.uint64)
    roots = dict(zip(values.tolist(), plain_roots(values)))
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[roots[p]] = min(r[0], least.get(roots[p], r[0]))
    expected = sorted((str(r[0]), p, least.get(roots[p])) for r, p in zip(rows, prints))
    for shards in (None, 12):
        found = sh.link_documents(docs, shards=shards).collect()
        assert sorted((str(r.doc_id), r.simhash % (1 << 64), r.component_id) for r in found) == expected
    kept = sh.keep_first(docs, shards=12)
    assert kept.columns == docs.columns
    found = sorted(str(r.doc_id) for r in kept.collect())
    assert found == sorted(str(least.get(c)) for c in set(roots.values()))


def test_empty_table(spark):
    assert sh.link_documents(empty_docs(spark)).count() == 0
    assert sh.keep_first(empty_docs(spark)).count() == 0


def test_repeated_rows_leave_one(spark):
    kept = sh.keep_first(edge_docs(spark))
    assert kept.where("doc_id = 9").count() == 1
