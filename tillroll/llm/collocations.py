"""Phrase collocations: contiguous phrases counted by direct address, scored exactly.

Words are ranked by frequency. In each task a pair of ranked units falls into a tile,
a square of the table of all pairs. Tiles with many occurrences are dense arrays that
``numpy.bincount`` adds to; the others are sorted lists of (code, count). Words below
the ranks (there is room for a fixed number of them) are told by a 63-bit hash, and
their phrases are sorted lists of tuples. Spark adds up what the tasks have counted.

Longer phrases repeat this: the frequent phrases of the length before are ranked anew
and are the units that meet the next word. A phrase is only counted if both phrases
that it holds may be frequent, which a bitmap of fixed size tells (it errs on one
side only). What a task is sent so has a fixed size, whatever the corpus: ranked units
and bitmaps; no counted phrase is ever dropped for lack of room.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tillroll.llm.common import add_columns
from tillroll.sources.workspace import land

LEAST = 10
LONGEST = 3
TOP = 2000
#: Ranked words and ranked phrases of each further length: what tasks are sent of them.
WORDS = 1 << 16
UNITS = 1 << 16
#: Bits of the bitmaps of frequent words and phrases, and of the table that finds a phrase's rank.
BITS = 26
SLOTS = 20
#: Sides of a tile, dense tiles of a task, occurrences that make a tile dense, counted at a time.
TILE = 10
DENSE_TILES = 16
DENSE_FROM = 1 << 15
CHUNK = 1 << 19
#: Rows of a sorted list at which it goes to Spark, and different words of a task.
LIST_ROWS = 1 << 19
TASK_WORDS = 250_000
#: Rows of a batch on its way to Spark.
BATCH = 1 << 16
#: Parts of a language's phrases that are ranked apart first.
PARTS = 16

# A-Z become small, signs that end a piece become 0xFF (never in UTF-8), and the tabulator a blank.
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b".,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\xff" * 10 + b" "
)
_END = b"\xff"
_NO_WORD = -1


def pieces_of(text: str) -> list[bytes]:
    """The text's words in UTF-8, with 0xFF between pieces."""
    return text.encode("utf-8", "replace").translate(_TABLE).replace(_END, b" \xff ").split()


def _key(seed: int, lang: str, word: bytes) -> int:
    """63-bit hash of a word of a language."""
    return xxhash.xxh64_intdigest(lang.encode() + _END + word, seed) >> 1


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of tuples of integers."""
    h = np.full(len(columns[0]), 0x9E3779B97F4A7C15, np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.int64).view(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(32)
    return h


def _by_lang(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[tuple[str, list[bytes]]]:
    """The words of a run of rows of one language, with 0xFF between pieces and documents."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        texts: dict[str, list[str]] = {}
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            if text:
                texts.setdefault("und" if lang is None else lang, []).append(text)
        for lang, found in texts.items():
            yield lang, pieces_of("\n".join(found))


def _summed(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different codes and their counts."""
    if counts is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    if counts is None:
        return codes[starts], np.diff(np.r_[starts, len(codes)])
    return codes[starts], np.add.reduceat(counts, starts) if len(codes) else counts


class TileCounts:
    """Counts of pairs (unit, word) of ranks: dense tiles, and a sorted list for the others."""

    def __init__(self, words: int):
        self._words = words
        self._across = (words >> TILE) + 1
        self._dense: dict[int, np.ndarray] = {}
        self._buffer: list[np.ndarray] = []
        self._waiting = 0
        self._lists: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, units: np.ndarray, words: np.ndarray) -> None:
        self._buffer.append(units * self._words + words)
        self._waiting += len(units)
        if self._waiting >= CHUNK:
            self._count()

    def _count(self) -> None:
        if not self._waiting:
            return
        codes = np.concatenate(self._buffer)
        self._buffer, self._waiting = [], 0
        units, words = np.divmod(codes, self._words)
        tiles = (units >> TILE) * self._across + (words >> TILE)
        cells = ((units & ((1 << TILE) - 1)) << TILE) | (words & ((1 << TILE) - 1))
        often, times = _summed(tiles)
        # What is dense stays dense; the fullest tiles join while there is room.
        fresh = sorted(((-n, t) for t, n in zip(often.tolist(), times.tolist()) if n >= DENSE_FROM and t not in self._dense))
        for _, tile in fresh[: max(0, DENSE_TILES - len(self._dense))]:
            self._dense[tile] = np.zeros(1 << (2 * TILE), np.uint32)
        rest = np.ones(len(codes), bool)
        for tile, cells_of in self._dense.items():
            mine = tiles == tile
            if mine.any():
                cells_of += np.bincount(cells[mine], minlength=len(cells_of)).astype(np.uint32)
                rest &= ~mine
        self._lists.append(_summed(codes[rest]))
        self.rows += len(self._lists[-1][0])
        if self.rows >= 2 * LIST_ROWS:
            self._merge()

    def _merge(self) -> None:
        codes, counts = (np.concatenate(x) for x in zip(*self._lists))
        self._lists = [_summed(codes, counts)]
        self.rows = len(self._lists[0][0])

    def take(self, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(units, words, counts): the list's, and at the end those of the dense tiles."""
        if last:
            self._count()
        empty = np.zeros(0, np.int64)
        if self._lists:
            self._merge()
        codes, counts = [list(x) for x in zip(*self._lists)] or ([empty], [empty])
        if last:
            for tile, cells in self._dense.items():
                at = np.flatnonzero(cells)
                unit = (tile // self._across << TILE) + (at >> TILE)
                word = (tile % self._across << TILE) + (at & ((1 << TILE) - 1))
                codes.append(unit * self._words + word)
                counts.append(cells[at].astype(np.int64))
            self._dense = {}
        self._lists, self.rows = [], 0
        units, words = np.divmod(np.concatenate(codes), self._words)
        return units, words, np.concatenate(counts)


class TupleCounts:
    """Counts of tuples of numbers, as one sorted list."""

    def __init__(self, length: int):
        self._length = length
        self._new: list[list[np.ndarray]] = []
        self._waiting = 0
        self._columns = [np.zeros(0, np.int64) for _ in range(length + 1)]

    def add(self, columns: list[np.ndarray]) -> None:
        if len(columns[0]):
            self._new.append([*columns, np.ones(len(columns[0]), np.int64)])
            self._waiting += len(columns[0])
            if self._waiting >= CHUNK:
                self._count()

    def _count(self) -> None:
        if not self._new:
            return
        columns = [np.concatenate([old, *new]) for old, *new in zip(self._columns, *self._new)]
        self._new, self._waiting = [], 0
        order = np.lexsort(columns[-2::-1])
        columns = [c[order] for c in columns]
        differs = np.zeros(len(order), bool)
        differs[0] = True
        for c in columns[:-1]:
            differs[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(differs)
        self._columns = [c[starts] for c in columns[:-1]] + [np.add.reduceat(columns[-1], starts)]

    @property
    def rows(self) -> int:
        return len(self._columns[0])

    def take(self) -> list[np.ndarray]:
        self._count()
        found, self._columns = self._columns, [np.zeros(0, np.int64) for _ in range(self._length + 1)]
        return found


@dataclass
class Frequent:
    """What tasks know of the frequent phrases of one length; its size is fixed by the parameters.

    ``ranked`` holds the words of the ranked ones, column by column; ``slots`` finds a
    rank by the phrase's hash, ``crowded`` those whose slot a better rank took; ``bits``
    has a bit for the hash of every frequent one. Of ranked phrases with one 64-bit hash
    only one is found; ``count_words`` makes sure that words never share theirs.
    """

    ranked: list[np.ndarray]
    slots: np.ndarray
    crowded: np.ndarray
    crowded_hashes: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(ranked: list[np.ndarray], bits: np.ndarray) -> Frequent:
        slots = np.full(1 << SLOTS, -1, np.int32)
        places = (_mixed(ranked) & np.uint64((1 << SLOTS) - 1)).astype(np.int64)
        backwards = np.arange(len(places))[::-1]
        slots[places[backwards]] = backwards
        crowded = np.flatnonzero(slots[places] != np.arange(len(places)))
        hashes = _mixed(ranked)[crowded]
        order = np.argsort(hashes, kind="stable")
        return Frequent(ranked, slots, crowded[order], hashes[order], bits)

    def may_be(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each phrase may be frequent; false only for those that are not."""
        place = _bit_place(hashes)
        return (self.bits[place >> 3] >> (place & 7) & 1).astype(bool)

    def ranks(self, hashes: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        """The rank of each phrase, or -1."""
        if not len(self.ranked[0]):
            return np.full(len(hashes), -1, np.int64)
        rank = self.slots[(hashes & np.uint64((1 << SLOTS) - 1)).astype(np.int64)].astype(np.int64)
        same = rank >= 0
        for known, column in zip(self.ranked, columns):
            same &= known[rank] == column
        rank = np.where(same, rank, -1)
        # Those whose slot went to a better rank.
        other = np.flatnonzero(~same)
        if len(self.crowded) and len(other):
            at = np.searchsorted(self.crowded_hashes, hashes[other])
            at = np.minimum(at, len(self.crowded) - 1)
            found = self.crowded[at]
            same = self.crowded_hashes[at] == hashes[other]
            for known, column in zip(self.ranked, columns):
                same &= known[found] == column[other]
            rank[other[same]] = found[same]
        return rank


def _bit_place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


class _Numbers:
    """A language's words as numbers: rank, or -2 - hash for a word that may be frequent, or -1.

    New words of a run of texts are looked up together, as arrays.
    """

    def __init__(self, lang: str, seed: int, words: Frequent):
        self._lang, self._seed, self._words = lang, seed, words
        self._known: dict[bytes, int] = {_END: _NO_WORD}

    def of(self, found: list[bytes]) -> np.ndarray:
        fresh = list(set(found).difference(self._known))
        if fresh:
            if len(self._known) + len(fresh) > TASK_WORDS:
                self._known = {_END: _NO_WORD}
                fresh = list(set(found).difference(self._known))
            keys = np.array([_key(self._seed, self._lang, w) for w in fresh], np.int64)
            hashes = _mixed([keys])
            rank = self._words.ranks(hashes, [keys])
            numbers = np.where(rank >= 0, rank, np.where(self._words.may_be(hashes), -2 - keys, _NO_WORD))
            self._known.update(zip(fresh, numbers.tolist()))
        return np.fromiter(map(self._known.__getitem__, found), np.int64, len(found))


def _word_rows(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, key, n): every word's count, summed in the tasks first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, words in _by_lang(batch):
                counts.setdefault(lang, Counter()).update(words)
                if sum(map(len, counts.values())) >= TASK_WORDS:
                    yield rows(counts)
                    counts = {}
        yield rows(counts)

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        found = [(lang, w.decode(), _key(seed, lang, w), n) for lang, c in counts.items() for w, n in c.items() if w != _END]
        columns = [list(c) for c in zip(*found)] or [[], [], [], []]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "key", "n"])

    parts = docs.mapInArrow(run, "lang string, word string, key long, n long")
    return parts.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def count_words(docs: DataFrame, lang: str, text: str) -> tuple[DataFrame, int]:
    """(lang, word, key, n) of all words, and the seed under which no two words share a key."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    for seed in count(13):
        words = land(_word_rows(rows, seed), "words")
        if words.groupBy("key").count().where("count > 1").isEmpty():
            return words, seed


def _bits(phrases: DataFrame, columns: list[str]) -> np.ndarray:
    """The bitmap of the phrases' hashes: 2**BITS bits, built by Spark."""

    def places(batch: pa.RecordBatch) -> list:
        numbers = [batch.column(i).to_numpy() for i in range(batch.num_columns)]
        return [pa.array(_bit_place(_mixed(numbers)) + 1, pa.int64())]

    placed = add_columns(phrases.select(*columns), columns, [("place", LongType())], places).select("place")
    maps = placed.groupBy(F.expr("bitmap_bucket_number(place)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bitmap")
    )
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    for r in maps.collect():
        part = np.frombuffer(bytes(r.bitmap), np.uint8)
        bits[(r.bucket - 1) * 4096 : (r.bucket - 1) * 4096 + len(part)] |= part
    return bits


def _ranked(phrases: DataFrame, columns: list[str], most: int) -> list[np.ndarray]:
    """The most frequent phrases, at most so many; ties by their words' numbers."""
    rows = phrases.orderBy(F.desc("n"), *columns).limit(most).select(*columns).collect()
    return [np.array([r[i] for r in rows], np.int64) for i in range(len(columns))]


def _phrase_counts(docs: DataFrame, length: int, seed: int, known: list, words: int) -> DataFrame:
    """(w1, ..., n): counts of the phrases of so many words that may be frequent.

    ``known`` has a broadcast ``Frequent`` for each shorter length.
    """
    names = [f"w{i + 1}" for i in range(length)]

    def batches_of(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(columns[0]), BATCH):
            part = [pa.array(c[at : at + BATCH], pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(part, names=[*names, "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, units = known[0].value, known[-1].value
        numbers: dict[str, _Numbers] = {}
        tiles, tuples = TileCounts(words), TupleCounts(length)

        def from_tiles(last: bool) -> Iterator[pa.RecordBatch]:
            unit, word, n = tiles.take(last)
            first = [unit] if length == 2 else [column[unit] for column in units.ranked]
            return batches_of([*first, word, n])

        for batch in batches:
            for lang, found in _by_lang(batch):
                if lang not in numbers:
                    numbers[lang] = _Numbers(lang, seed, single)
                x = numbers[lang].of(found)
                if len(x) < length:
                    continue
                columns = [x[i : len(x) - length + 1 + i] for i in range(length)]
                keep = np.ones(len(columns[0]), bool)
                for c in columns:
                    keep &= c != _NO_WORD
                if length == 2:
                    columns = [c[keep] for c in columns]
                    unit = columns[0]
                else:
                    shorter = [x[i : len(x) - length + 2 + i] for i in range(length - 1)]
                    hashes = _mixed(shorter)
                    frequent = units.may_be(hashes)
                    keep &= frequent[:-1] & frequent[1:]
                    columns = [c[keep] for c in columns]
                    unit = units.ranks(hashes[:-1][keep], columns[:-1])
                tiled = (unit >= 0) & (columns[-1] >= 0)
                tiles.add(unit[tiled], columns[-1][tiled])
                tuples.add([c[~tiled] for c in columns])
                if tiles.rows >= LIST_ROWS:
                    yield from from_tiles(False)
                if tuples.rows >= LIST_ROWS:
                    yield from batches_of(tuples.take())
        yield from from_tiles(True)
        yield from batches_of(tuples.take())

    parts = docs.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"]))
    return parts.groupBy(*names).agg(F.sum("n").alias("n"))


def _exact_score(a: str, left: str, right: str) -> str:
    """SQL: floor(1000000 * a * a / (left * right)), exact up to 38 digits."""
    wide = "CAST({} AS DECIMAL(19,0))".format
    product = f"CAST({wide(left)} * {wide(right)} AS DECIMAL(38,0))"
    return f"(CAST(CAST({wide(a)} * {wide(a)} AS DECIMAL(38,0)) * 1000000BD AS DECIMAL(38,0)) DIV {product})"


def _cut(rows: DataFrame, length: int, counted: dict[int, DataFrame]) -> DataFrame:
    """The candidates of one length with l, r and score of their lowest-scoring cut."""
    own = [f"w{i + 1}" for i in range(length)]
    cuts = []
    for k in range(1, length):
        for side, at, size in (("l", 0, k), ("r", k, length - k)):
            part = counted[size].select(
                *[F.col(f"w{i + 1}").alias(f"w{at + i + 1}") for i in range(size)], F.col("n").alias(f"{side}{k}")
            )
            rows = rows.join(part, [f"w{at + i + 1}" for i in range(size)])
        score = _exact_score("n", f"l{k}", f"r{k}")
        cuts.append(f"struct({score} AS score, {k} AS k, l{k} AS l, r{k} AS r)")
    best = rows.withColumn("cut", F.expr(f"array_min(array({', '.join(cuts)}))"))
    return best.select(*own, "n", "cut.l", "cut.r", "cut.score")


def _covers(counted: dict[int, DataFrame], length: int, longest: int) -> DataFrame | None:
    """The phrases of one length inside longer candidates, with the largest of those candidates' counts."""
    own = [f"w{i + 1}" for i in range(length)]
    parts = []
    for size in range(length + 1, longest + 1):
        inside = F.array(*[F.struct(*[F.col(f"w{at + i + 1}").alias(own[i]) for i in range(length)]) for at in range(size - length + 1)])
        parts.append(counted[size].select(F.inline(inside), "n"))
    if not parts:
        return None
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.select(*own, "n").groupBy(*own).agg(F.max("n").alias("longer"))


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    words: int = WORDS,
    units: int = UNITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``longest`` words.

    A-Z become small; pieces end at ``.,;:!?`` and at U+000A to U+000D, words at blanks
    and tabulators. A candidate occurs a >= ``least`` times in its language, which has n
    words. Its score is floor(1000000 * a * a / (l * r)) at its lowest-scoring cut, the first
    on ties. Candidates inside a longer one that occurs half as often at least are dropped.
    The order is by score, a (both falling) and phrase (by UTF-8 bytes).

    A null language is ``und``; null, empty and blank texts have no words. Repeated rows
    count as often as they occur. An empty table, or one without candidates, gives no rows.
    Only the two named columns are read, so others may have any names. ``words`` and
    ``units`` bound what is counted by direct address; they do not change the result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    all_words, seed = count_words(docs, lang, text)
    known, vocabulary = _vocabulary(spark, all_words, least, words)
    counted = {1: vocabulary.select(F.col("number").alias("w1"), "n")}
    for length in range(2, longest + 1):
        names = [f"w{i + 1}" for i in range(length)]
        counts = _phrase_counts(rows, length, seed, known, words)
        counted[length] = land(counts.where(F.col("n") >= least), f"phrases-{length}")
        if length < longest:
            frequent = Frequent.of(_ranked(counted[length], names, units), _bits(counted[length], names))
            known = [known[0], spark.sparkContext.broadcast(frequent)]
    texts = vocabulary.select("number", "lang", "word")
    scored = []
    for length in range(2, longest + 1):
        own = [f"w{i + 1}" for i in range(length)]
        kept = counted[length]
        covers = _covers(counted, length, longest)
        if covers is not None:
            outside = F.coalesce(100 * F.col("longer") < 50 * F.col("n"), F.lit(True))
            kept = kept.join(covers, own, "left").where(outside).drop("longer")
        cut = _cut(kept, length, counted)
        for i, name in enumerate(own):
            word = texts.select(F.col("number").alias(name), F.col("word").alias(f"t{i}"), *["lang"] * (i == 0))
            cut = cut.join(word, name)
        phrase = F.concat_ws(" ", *[f"t{i}" for i in range(length)])
        scored.append(cut.select("lang", phrase.alias("phrase"), F.col("n").alias("a"), "l", "r", "score"))
    every = scored[0]
    for s in scored[1:]:
        every = every.unionByName(s)
    every = land(every, "collocations")
    # The best of each part of a language first, so that one task ranks PARTS * top phrases at most.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.hash("phrase"), F.lit(PARTS))
    parts = Window.partitionBy("lang", "part").orderBy(*order)
    best = every.withColumn("part", part).withColumn("place", F.row_number().over(parts)).where(F.col("place") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    sizes = all_words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _vocabulary(spark: SparkSession, all_words: DataFrame, least: int, most: int) -> tuple[list, DataFrame]:
    """What tasks know of the frequent words, broadcast, and the table (number, lang, word, n) of them."""
    frequent = all_words.where(F.col("n") >= least)
    ranked = _ranked(frequent, ["key"], most)
    known = Frequent.of(ranked, _bits(frequent, ["key"]))
    ranks = spark.createDataFrame([(k, r) for r, k in enumerate(ranked[0].tolist())], "key long, rank long")
    # At most ``most`` rows of two numbers.
    numbered = frequent.join(F.broadcast(ranks), "key", "left").select(
        F.coalesce("rank", -2 - F.col("key")).alias("number"), "lang", "word", "n"
    )
    return [spark.sparkContext.broadcast(known)], land(numbered, "vocabulary")
