"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents are cut into pieces no longer than a sequence, and pieces are placed
by bounded-space online best fit: a fixed number of bins is open, a bitset keyed
by free space finds the fullest bin that still has room in a few integer
operations, and when one bin too many is open the fullest is closed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from tillroll.llm.common import SharedFile, byte_signs, spare_name, texts_of

CAPACITY = 4096
END_ID = 1
OPEN_BINS = 2048
#: Words remembered by a Python worker (about 150 bytes each), and the longest such word.
KNOWN_WORDS = 800_000
KNOWN_LENGTH = 48
#: ASCII signs that, after a letter, are tokens of their own in these vocabularies.
_TAIL = ".,!?;:%&*$#|)"


class WordIds(dict):
    """Ids of words as little-endian 32-bit integers, each distinct word encoded by the library once.

    The vocabularies used here split at white space, drop it, keep runs of letters
    apart from runs of signs and lower-case everything, so a text's ids are those
    of its words in turn, and a run of letters is one unit of the library's model.
    """

    def __init__(self, tokenizer_json: str):
        super().__init__()
        self._library = Tokenizer.from_str(tokenizer_json)
        self._library.no_truncation()
        self._library.no_padding()
        self._model = self._library.model
        self._signs = byte_signs()

    def __missing__(self, word: str) -> bytes:
        core = word.rstrip(_TAIL)
        if len(core) < len(word) and self._ends_with_letter(core):
            ids = self[core] + self[word[len(core) :]]
        elif (unit := self._unit(word)) is not None:
            ids = np.array([t.id for t in self._model.tokenize(unit)], "<u4").tobytes()
        else:
            ids = np.array(self._library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= KNOWN_LENGTH:
            self[word] = ids
        return ids

    def _ends_with_letter(self, core: str) -> bool:
        """Whether signs after it are apart for the library, which composes and lowers first.

        Some letters come to end with a mark by that, which the signs would join.
        """
        if core.isascii():
            return core[-1:].isalpha()
        return core[-1:].isalpha() and is_normalized("NFC", core) and core.lower()[-1:].isalpha()

    def _unit(self, word: str) -> str | None:
        """A word of letters alone as the library's model sees it, or None if the library must split it."""
        lower = word.lower()
        if not lower.isalpha() or not word.isalpha() or "\u03a3" in word:
            return None
        if lower.isascii():
            return lower
        if not is_normalized("NFC", word):
            return None
        signs = self._signs
        return "".join([signs[b] for b in lower.encode()])

    def of_text(self, text: str) -> bytes:
        if len(self) > KNOWN_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_ENCODERS: dict[int, WordIds] = {}


def _encoder(shared) -> WordIds:
    found = _ENCODERS.get(shared.id)
    if found is None:
        _ENCODERS.clear()
        found = _ENCODERS[shared.id] = WordIds(shared.value)
    return found


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of each document: ``key``, piece, start, length and ``ids`` (little-endian 32-bit).

    A document's ids end with ``end_id``; a null or empty text is that id alone.
    Only documents longer than ``capacity`` are cut. The vocabulary must drop
    white space (its file's path is a parameter). Other columns are left out, so
    clashing names do no harm; null keys and repeated rows are kept.
    """
    shared = SharedFile(docs.sparkSession, tokenizer)
    rows = docs.select(F.col(key), F.col(text).alias(spare_name("text", [key])))
    schema = StructType(
        [
            StructField(key, docs.schema[key].dataType, True),
            StructField("piece", IntegerType(), False),
            *[StructField(n, LongType(), False) for n in ("start", "length")],
        ]
    ).add("ids", "binary", False)
    arrow = to_arrow_schema(schema)
    last = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _encoder(shared)
        for batch in batches:
            texts = texts_of(batch, 1)
            for at in range(0, len(texts), 512):
                owner, piece, start, ids = [], [], [], []
                for i, text in enumerate(texts[at : at + 512], at):
                    whole = known.of_text(text) + last
                    for n, place in enumerate(range(0, len(whole), step)):
                        owner.append(i)
                        piece.append(n)
                        start.append(place // 4)
                        ids.append(whole[place : place + step])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    schema=arrow,
                )

    return rows.mapInArrow(cut, schema)


class BestFit:
    """Bounded-space online best fit.

    ``bits`` has bit ``s`` set while some open bin has exactly ``s`` places
    free; ``bins[s]`` lists those bins. A full bin is closed at once.
    """

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.bits = 0
        self.bins: dict[int, list[int]] = {}
        self.open = 0
        self.made = 0

    def _take(self, space: int) -> int:
        bins = self.bins[space]
        found = bins.pop()
        if not bins:
            del self.bins[space]
            self.bits &= ~(1 << space)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of the next piece, 1 <= length <= capacity."""
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(space)
        else:
            space, chosen = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            self.bins.setdefault(left, []).append(chosen)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return chosen, self.capacity - space


def best_fit(
    pieces: DataFrame,
    length: str = "length",
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
) -> DataFrame:
    """Append ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    Pieces are dealt out by a hash of their columns into as many parts as
    adaptive execution finds fit (one for each ``advisoryPartitionSizeInBytes``),
    and packed in order of falling length within blocks of hash order, so that a
    retried task places them alike. Sequence numbers hold the part in their high
    bits. All columns of ``pieces`` are kept; of a clashing name the new column stays.
    """
    pieces = pieces.drop("sequence_id", "offset")
    order = F.xxhash64(*[c for c in pieces.columns if c != "ids"])
    at = spare_name("order", pieces.columns)
    dealt = pieces.withColumn(at, order).repartition(at).sortWithinPartitions(at, length)
    schema = StructType(
        pieces.schema.fields
        + [StructField("sequence_id", LongType(), False), StructField("offset", LongType(), False)]
    )
    arrow = to_arrow_schema(schema)
    kept = pieces.columns

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index(length)).to_numpy()
            found = np.empty((len(sizes), 2), np.int64)
            for i in np.argsort(-sizes, kind="stable").tolist():
                found[i] = bins.place(int(sizes[i]))
            columns = [batch.column(n) for n in kept]
            columns += [pa.array(found[:, 0] + base), pa.array(found[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return dealt.mapInArrow(pack, schema)


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Packed pieces of ``docs`` with their ids; see ``token_pieces`` and ``best_fit``."""
    return best_fit(token_pieces(docs, tokenizer, key, text), **options)
