"""Byte-level BPE: encoding by a heap of merge ranks over a linked symbol list, and decoding.

A pre-token's symbols form a doubly linked list. A heap holds the ranks of
adjacent pairs; the lowest rank is merged first, leftmost on ties. Entries whose
symbols have changed meanwhile are skipped when they come up (they are stale).
Decoding concatenates the byte strings of the vocabulary.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tillroll.llm.common import SharedFile, add_columns, byte_signs, texts_of

#: Pre-tokens of the byte-level vocabularies (fixed value of the published format).
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blank-free pieces remembered by a Python worker, and the longest such piece.
KNOWN_PIECES = 700_000
KNOWN_LENGTH = 48


class Bpe:
    """Encoder and decoder of one vocabulary file of the ``tokenizers`` library (byte-level BPE)."""

    def __init__(self, tokenizer_json: str):
        content = json.loads(tokenizer_json)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.signs = byte_signs()
        self.special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        of_sign = {sign: byte for byte, sign in enumerate(self.signs)}
        names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.strings = {}
        for i, name in names.items():
            plain = all(c in of_sign for c in name)
            self.strings[i] = bytes(of_sign[c] for c in name) if plain else name.encode()
        parts = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self._cut = regex.compile(f"({'|'.join(parts)})") if parts else None
        self._pre = regex.compile(PRE_TOKENS)
        self._odd = regex.compile(r"\s\s|^\s|\s$|[^\S \n]")
        # Ids of pre-tokens, and of blank-free pieces at a line's start and after a blank.
        self._known: dict[str, tuple[int, ...]] = {}
        self._first: dict[str, tuple[int, ...]] = {}
        self._later: dict[str, tuple[int, ...]] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges, by rank and from the left."""
        n = len(symbols)
        if n < 2:
            return symbols
        symbols = list(symbols)
        before = list(range(-1, n - 1))
        after = list(range(1, n + 1))
        ranks = self.ranks
        # An entry is rank * n + place: one integer, ordered by rank and then from the left.
        heap = []
        for i in range(n - 1):
            rank = ranks.get((symbols[i], symbols[i + 1]))
            if rank is not None:
                heap.append(rank * n + i)
        heapq.heapify(heap)
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            j = after[i]
            if j >= n or ranks.get((symbols[i], symbols[j])) != rank:
                continue  # stale: one of the two has been merged since
            symbols[i] += symbols[j]
            symbols[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get((symbols[i], symbols[k]))
                if rank is not None:
                    heapq.heappush(heap, rank * n + i)
            h = before[i]
            if h >= 0:
                rank = ranks.get((symbols[h], symbols[i]))
                if rank is not None:
                    heapq.heappush(heap, rank * n + h)
        return [s for s in symbols if s]

    def _pre_token(self, text: str) -> tuple[int, ...]:
        found = self._known.get(text)
        if found is None:
            signs, ids = self.signs, self.ids
            symbols = [signs[b] for b in text.encode("utf-8", "replace")]
            found = tuple(ids[s] for s in self.merge(symbols))
            if len(text) <= KNOWN_LENGTH:
                self._known[text] = found
        return found

    def _piece(self, known: dict[str, tuple[int, ...]], piece: str, blank: str) -> tuple[int, ...]:
        whole = blank + piece
        if piece.isalpha():
            ids = self._pre_token(whole)
        else:
            ids = tuple(i for part in self._pre.findall(whole) for i in self._pre_token(part))
        if len(piece) <= KNOWN_LENGTH:
            known[piece] = ids
        return ids

    def _ordinary(self, text: str) -> list[int]:
        """As ``_plain``; texts whose white space is single blanks and line ends go piece by piece.

        There a blank belongs to the piece after it and a line end stands alone,
        so each blank-free piece is one or more whole pre-tokens.
        """
        if len(self._first) + len(self._later) + len(self._known) > 2 * KNOWN_PIECES:
            for known in (self._first, self._later, self._known):
                known.clear()
        if self._odd.search(text):
            return [i for part in self._pre.findall(text) for i in self._pre_token(part)]
        first, later = self._first, self._later
        out: list[int] = []
        line_end = self.ids[self.signs[10]]
        for n, line in enumerate(text.split("\n")):
            if n:
                out.append(line_end)
            pieces = line.split(" ")
            head = first.get(pieces[0])
            out += self._piece(first, pieces[0], "") if head is None else head
            for piece in pieces[1:]:
                ids = later.get(piece)
                out += self._piece(later, piece, " ") if ids is None else ids
        return out

    def encode(self, text: str) -> list[int]:
        if self._cut is None or not any(s in text for s in self.special):
            return self._ordinary(text) if text else []
        out: list[int] = []
        for part in self._cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self._ordinary(part)
        return out

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings joined; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_CODERS: dict[int, Bpe] = {}


def _coder(shared: SharedFile) -> Bpe:
    found = _CODERS.get(shared.id)
    if found is None:
        _CODERS.clear()
        found = _CODERS[shared.id] = Bpe(shared.value)
    return found


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append the ids of each whole text (null: no ids); all other columns stay."""
    shared = SharedFile(docs.sparkSession, tokenizer)

    def compute(batch: pa.RecordBatch) -> list:
        coder = _coder(shared)
        return [_lists(coder.encode(t) for t in texts_of(batch))]

    return add_columns(docs, [text], [(ids, ArrayType(IntegerType(), False))], compute)


def decode(docs: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Append the text of each list of ids (null: the empty text); all other columns stay."""
    shared = SharedFile(docs.sparkSession, tokenizer)

    def compute(batch: pa.RecordBatch) -> list:
        coder = _coder(shared)
        return [pa.array([coder.decode(x or []) for x in _ids_of(batch.column(0))], pa.string())]

    return add_columns(docs, [ids], [(decoded, StringType())], compute)


def _lists(lists) -> pa.Array:
    """Lists of ids as one Arrow array, without a Python list of all of them."""
    parts, ends = [], [0]
    for x in lists:
        parts.append(np.array(x, np.int32))
        ends.append(ends[-1] + len(x))
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _ids_of(column: pa.ListArray):
    for x in column:
        values = x.values
        yield [] if values is None else values.to_numpy(zero_copy_only=False).tolist()


def round_trip(
    docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass: appends the ids and the text decoded from them."""
    shared = SharedFile(docs.sparkSession, tokenizer)

    def compute(batch: pa.RecordBatch) -> list:
        coder = _coder(shared)
        found = _lists(coder.encode(t) for t in texts_of(batch))
        return [found, pa.array([coder.decode(x) for x in _ids_of(found)], pa.string())]

    adds = [(ids, ArrayType(IntegerType(), False)), (decoded, StringType())]
    return add_columns(docs, [text], adds, compute)
