"""Byte-level BPE from a file of ranks: longest matches with backtracking, and decoding.

A list of tokens is what merging by rank makes of a byte string exactly if each
token alone merges to itself and no two neighbours would have merged across
their border. So merging is never done on whole strings: bytes are mapped to
Latin-1, one run of an Aho-Corasick automaton finds the longest token at each
place, and tokens are put down from the left. If a token does not go with the one
before it, its next shorter prefix is tried; if none is left, the token before it
is taken back and that place is marked, as no other way can lead through it.
Each place is visited once for each prefix at most. Whether two tokens go together
is found by merging their few bytes, and remembered.

A match of the pattern that is a token itself is that token, whatever merging
says, as in the library that publishes the format.
"""

from __future__ import annotations

import base64
import re

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType

from tillroll.llm.common import SharedFile, add_columns, texts_of

#: Entries of each of a worker's memories (emptied when full), and the longest text remembered.
KNOWN = 400_000
KNOWN_LENGTH = 48
#: Bytes of packed ids that are decoded at a time, or one text's if it has more.
UNPACKED = 1 << 20

#: Letters and numbers that ``regex`` knows and Unicode 16, the version of the format's library, doesn't
#: (fixed values: first and last of each run). There they are signs like any other.
NEWER = (
    (0x558, 0x558), (0x58b, 0x58c), (0x88f, 0x88f), (0xc5c, 0xc5c), (0xcdc, 0xcdc), (0x208f, 0x208f),
    (0x209d, 0x209f), (0xa7ce, 0xa7cf), (0xa7d2, 0xa7d2), (0xa7d4, 0xa7d4), (0xa7dd, 0xa7dd),
    (0xa7e2, 0xa7e2), (0xa7f1, 0xa7f1), (0xab6c, 0xab6d), (0x107bb, 0x107bf), (0x10940, 0x10959),
    (0x10ec5, 0x10ec7), (0x10ed9, 0x10eee), (0x11b0a, 0x11b0a), (0x11db0, 0x11ddb), (0x11de0, 0x11de9),
    (0x11df1, 0x11df1), (0x1246f, 0x1246f), (0x12475, 0x1247f), (0x12550, 0x12686), (0x16ea0, 0x16eb8),
    (0x16ebb, 0x16ed3), (0x16ff2, 0x16ff6), (0x187f8, 0x187ff), (0x18cd6, 0x18cda), (0x18d09, 0x18d20),
    (0x18d80, 0x18df2), (0x18e00, 0x19191), (0x191a0, 0x191d2), (0x1b123, 0x1b128), (0x1b168, 0x1b168),
    (0x1d6a6, 0x1d6a6), (0x1df1f, 0x1df24), (0x1df2b, 0x1df81), (0x1df90, 0x1df96), (0x1dfcd, 0x1dfff),
    (0x1e6c0, 0x1e6de), (0x1e6e0, 0x1e6e2), (0x1e6e4, 0x1e6e5), (0x1e6e7, 0x1e6ed), (0x1e6f0, 0x1e6f4),
    (0x1e6fe, 0x1e6ff), (0x2b73a, 0x2b73f), (0x2b81e, 0x2b81e), (0x2cea2, 0x2cead), (0x323b0, 0x33479),
    (0x3d000, 0x3fc3f),
)
_NEWER = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NEWER) + "]")
#: Never a letter or number in any version.
_SIGN = chr(0xFFFF)

# White space other than the blank and the line end.
_OTHER_SPACE = re.compile("[" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n") + "]")
_UNSURE = re.compile(r"\s\s|[^\S\n]")
_SURE_BLANK = regex.compile(r"(?<=\S) (?=\S)")


_NO_RANK = float("inf")


class RankedBpe:
    """Encoder and decoder of one file of ``base64 rank`` lines that has all 256 bytes."""

    def __init__(self, ranks: str, pattern: str):
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        names = {base64.b64decode(name).decode("latin-1"): int(rank) for name, rank in pairs}
        self._ids = names
        self._names = {i: name for name, i in names.items()}
        self.strings = {i: name.encode("latin-1") for name, i in names.items()}
        self._length = {i: len(name) for name, i in names.items()}
        self._shorter = {i: self._prefix(name) for name, i in names.items()}
        self._sorted_ids = np.array(sorted(self.strings), "<u4")
        self._sorted_strings = pa.array([self.strings[i] for i in sorted(self.strings)], pa.large_binary())
        self._automaton = ahocorasick.Automaton()
        for name, i in names.items():
            self._automaton.add_word(name, (i, len(name) - 1))
        self._automaton.make_automaton()
        self._pattern = regex.compile(pattern)
        self._whole: dict[int, bool] = {}
        self._together: dict[tuple[int, int], bool] = {}
        self._parts: dict[str, bytes] = {}
        self._first = _Pieces(self, "")
        self._later = _Pieces(self, " ")
        self._line_end = self.pack_part("\n")

    def _prefix(self, name: str) -> int:
        """The longest token that begins this one and is shorter, or -1."""
        cuts = range(len(name) - 1, 0, -1)
        return next((self._ids[name[:n]] for n in cuts if name[:n] in self._ids), -1)

    def merged(self, name: str) -> list[str]:
        """A short byte string after all merges: lowest rank first, leftmost on ties."""
        parts, rank = list(name), self._ids.get
        ranks = [rank(a + b, _NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            lowest = min(ranks)
            if lowest == _NO_RANK:
                break
            at = ranks.index(lowest)
            parts[at] += parts.pop(at + 1)
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], _NO_RANK)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], _NO_RANK)
        return parts

    def _reached(self, token: int) -> bool:
        """Whether a token's own bytes merge to it."""
        found = self._whole.get(token)
        if found is None:
            name = self._names[token]
            found = self._whole[token] = self.merged(name) == [name]
        return found

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between two neighbours alone."""
        found = self._together.get((left, right))
        if found is None:
            if len(self._together) >= KNOWN:
                self._together.clear()
            a, b = self._names[left], self._names[right]
            found = self._together[left, right] = self.merged(a + b) == [a, b]
        return found

    def segment(self, name: str) -> list[int]:
        """Tokens of one match of the pattern, its bytes given as Latin-1."""
        if name in self._ids:
            return [self._ids[name]]
        length, shorter, reached, together = self._length, self._shorter, self._whole, self._together
        longest = [-1] * len(name)
        for end, (token, back) in self._automaton.iter(name):
            longest[end - back] = token  # ends rise, so the longest comes last
        lost = bytearray(len(name) + 1)
        tokens: list[int] = []
        at, token = 0, longest[0]
        while at < len(name):
            while token >= 0:
                end = at + length[token]
                # Looked up here first, as most are known.
                if not lost[end] and (reached.get(token) or self._reached(token)):
                    if not tokens or together.get((tokens[-1], token)) or self._compatible(tokens[-1], token):
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at = end
                token = longest[at] if at < len(name) else -1
            elif tokens:
                lost[at] = 1
                token = tokens.pop()
                at -= length[token]
                token = shorter[token]
            else:
                raise ValueError("the ranks lack single bytes")
        return tokens

    def pack_part(self, part: str) -> bytes:
        """Packed ids of one match of the pattern."""
        found = self._parts.get(part)
        if found is None:
            ids = self.segment(part.encode("utf-8").decode("latin-1"))
            found = np.array(ids, "<u4").tobytes()
            if len(part) <= KNOWN_LENGTH:
                if len(self._parts) >= KNOWN:
                    self._parts.clear()
                self._parts[part] = found
        return found

    def pack_piece(self, piece: str, blank: str) -> bytes:
        """Packed ids of a piece that no match of the pattern leaves."""
        if "\n" in piece and "\n\n" not in piece and not _UNSURE.search(piece):
            # A line end between two signs is a match of its own.
            head, *lines = piece.split("\n")
            start = self._later[head] if blank else self._first[head]
            return start + b"".join(self._line_end + self._first[line] for line in lines)
        whole = blank + piece
        if _NEWER.search(whole):
            parts = [whole[m.start() : m.end()] for m in self._pattern.finditer(_NEWER.sub(_SIGN, whole))]
        else:
            parts = [m.group() for m in self._pattern.finditer(whole)]
        return b"".join(map(self.pack_part, parts))

    def pack(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        A blank between two signs that are no white space always begins a match,
        so texts are cut there and pieces are looked up.
        """
        if not text:
            return b""
        if "  " in text or " \n" in text or "\n " in text or _OTHER_SPACE.search(text):
            pieces = _SURE_BLANK.split(text)
        else:
            pieces = text.split(" ")
        return self._first[pieces[0]] + b"".join(map(self._later.__getitem__, pieces[1:]))

    def unpack(self, ids: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        return self._unpack([ids])[0].as_py()

    def unpack_all(self, ids: list[bytes]) -> pa.Array:
        """The bytes that each of several packed ids stand for, as a binary column."""
        parts, chunk, held = [], [], 0
        for x in ids:
            chunk.append(x)
            held += len(x)
            if held >= UNPACKED:
                parts.append(self._unpack(chunk))
                chunk, held = [], 0
        parts.append(self._unpack(chunk))
        return pa.concat_arrays(parts)


    def _unpack(self, ids: list[bytes]) -> pa.Array:
        found = np.frombuffer(b"".join(ids), "<u4")
        at = np.minimum(np.searchsorted(self._sorted_ids, found), len(self._sorted_ids) - 1)
        if (self._sorted_ids[at] != found).any():
            raise KeyError("an id that the file of ranks lacks")
        taken = self._sorted_strings.take(pa.array(at))
        ends = np.cumsum([0] + [len(x) // 4 for x in ids])
        # The taken strings lie one after the other, so a text is a run of them.
        offsets = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[ends]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), taken.buffers()[2]]
        ).cast(pa.binary())


class _Pieces(dict):
    """Packed ids by piece, at a text's start or after a blank."""

    def __init__(self, coder: RankedBpe, blank: str):
        super().__init__()
        self._coder, self._blank = coder, blank

    def __missing__(self, piece: str) -> bytes:
        found = self._coder.pack_piece(piece, self._blank)
        if len(piece) <= KNOWN_LENGTH and "\n" not in piece:
            if len(self) >= KNOWN:
                self.clear()
            self[piece] = found
        return found


_CODERS: dict[tuple[int, str], RankedBpe] = {}


def _coder(shared: SharedFile, pattern: str) -> RankedBpe:
    found = _CODERS.get((shared.id, pattern))
    if found is None:
        _CODERS.clear()
        found = _CODERS[shared.id, pattern] = RankedBpe(shared.value, pattern)
    return found


def _id_type(packed: bool) -> DataType:
    return BinaryType() if packed else ArrayType(IntegerType(), False)


def _id_column(ids: list[bytes], packed: bool) -> pa.Array:
    if packed:
        return pa.array(ids, pa.binary())
    ends = np.cumsum([0] + [len(x) // 4 for x in ids])
    values = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _packed_ids(column: pa.Array, packed: bool):
    for x in column:
        if packed:
            yield x.as_py() or b""
        else:
            yield np.array(x.as_py() or [], "<u4").tobytes()


def encode(
    docs: DataFrame,
    ranks: str,
    text: str = "text",
    ids: str = "ids",
    packed: bool = False,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Append the ids of each whole text; all other columns stay.

    Each match of ``pattern`` is encoded by itself. ``packed`` gives the ids as
    binary, little-endian unsigned 32-bit integers, else as an array of integers.
    A null or empty text has no ids. Repeated rows, null keys and further columns
    pass through; a column named ``ids`` is replaced; an empty table stays empty.
    """
    shared = SharedFile(docs.sparkSession, ranks)

    def compute(batch: pa.RecordBatch) -> list:
        coder = _coder(shared, pattern)
        return [_id_column([coder.pack(t) for t in texts_of(batch)], packed)]

    return add_columns(docs, [text], [(ids, _id_type(packed))], compute)


def decode(
    docs: DataFrame,
    ranks: str,
    ids: str = "ids",
    decoded: str = "decoded",
    packed: bool = False,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Append the bytes that each row's ids stand for (null or no ids: no bytes).

    They need not be UTF-8, as ids may hold parts of a character. All other columns
    stay as with ``encode``; an id that the file lacks is an error.
    """
    shared = SharedFile(docs.sparkSession, ranks)

    def compute(batch: pa.RecordBatch) -> list:
        coder = _coder(shared, pattern)
        return [coder.unpack_all(list(_packed_ids(batch.column(0), packed)))]

    return add_columns(docs, [ids], [(decoded, BinaryType())], compute)


def round_trip(
    docs: DataFrame,
    ranks: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    packed: bool = False,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``encode`` and ``decode`` of the encoded ids in one pass, with their rules for odd rows."""
    shared = SharedFile(docs.sparkSession, ranks)

    def compute(batch: pa.RecordBatch) -> list:
        coder = _coder(shared, pattern)
        found = [coder.pack(t) for t in texts_of(batch)]
        return [_id_column(found, packed), coder.unpack_all(found)]

    adds = [(ids, _id_type(packed)), (decoded, BinaryType())]
    return add_columns(docs, [text], adds, compute)
