import base64
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from edge import edge_docs, edge_rows, empty_docs
from pyspark.sql import functions as F

from tillroll.llm import byte_bpe, queries
from tillroll.llm.common import table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXT = open(PATH, encoding="utf-8").read()


def library_of(lines):
    ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, lines.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return library_of(TEXT)


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.RankedBpe(TEXT, public_tokenizers.PATTERN)


def ids_of(coder, text):
    packed = coder.pack(text)
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_same_as_the_library(library, coder):
    rng = random.Random(2)
    alphabet = "ab eE,.'\n\n\t\r é 　😀١<|0\x1c\x85 "
    texts = [r[1] or "" for r in edge_rows()]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x3FF), rng.randint(0x3000, 0xD7FF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(30)) for _ in range(300)]
    texts += ["a\n\nb", "a\n\n\nb", "\n", "a\n", "\na", " a", "a ", "a  b", "a   b", "\n \n", "it's they'll", "a \nb", "a\n b", "a\n\n"]
    for text in texts:
        found = ids_of(coder, text)
        assert found == library.encode_ordinary(text), repr(text)
        assert coder.unpack(coder.pack(text)) == text.encode()


def test_letters_of_later_versions(library, coder):
    """Each kind of sign beside a letter, a number and a sign."""
    step = 97
    for at in [*range(0x80, 0xD800, step), *range(0xE000, 0x34000, step), *(a for run in byte_bpe.NEWER for a in run)]:
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}b" for c in (at - 1, at, at + 1) if not 0xD800 <= c < 0xE000)
        assert ids_of(coder, text) == library.encode_ordinary(text), hex(at)


def test_long_matches_without_blanks(library, coder):
    rng = random.Random(3)
    words = [t.decode("utf-8", "ignore").strip() for t in list(coder.strings.values())[2000:9000]]
    for n in (50, 400, 3000):
        text = "".join(w for w in (rng.choice(words) for _ in range(n)) if w.isalpha())
        assert ids_of(coder, text) == library.encode_ordinary(text)
    assert ids_of(coder, "x" * 70_001) == library.encode_ordinary("x" * 70_001)


@pytest.mark.parametrize("seed", range(12))
def test_any_order_of_ranks(seed):
    """Ranks that no training would give: tokens that merging never reaches, parts that come after their whole."""
    rng = random.Random(seed)
    names = {bytes([b]) for b in range(256)}
    names |= {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(5, 60))}
    ordered = rng.sample(sorted(names), len(names))
    lines = "\n".join(f"{base64.b64encode(n).decode()} {i}" for i, n in enumerate(ordered))
    coder, library = byte_bpe.RankedBpe(lines, public_tokenizers.PATTERN), library_of(lines)
    for _ in range(300):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        assert ids_of(coder, text) == library.encode_ordinary(text)


def test_memories_may_be_emptied(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "KNOWN", 3)
    coder = byte_bpe.RankedBpe(TEXT, public_tokenizers.PATTERN)
    text = " ".join(f"word{i % 7} other" for i in range(60))
    assert ids_of(coder, text) == library.encode_ordinary(text)


def test_columns(spark):
    docs = edge_docs(spark)
    both = byte_bpe.round_trip(docs, PATH)
    apart = byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH)
    packed = byte_bpe.decode(byte_bpe.encode(docs, PATH, packed=True), PATH, packed=True)
    assert both.columns == [*docs.columns, "ids", "decoded"]
    key = lambda rows: sorted(map(str, rows))
    assert key(both.collect()) == key(apart.collect())
    for rows in (both.collect(), packed.collect()):
        assert len(rows) == docs.count()
        assert all(bytes(r.decoded) == (r.text or "").encode() and r.score == "own" for r in rows)
    sizes = packed.select(F.octet_length("ids") / 4).collect()
    assert sorted(r[0] for r in sizes) == sorted(len(r.ids) for r in both.collect())
    assert byte_bpe.round_trip(empty_docs(spark), PATH).count() == 0


def test_query(spark, small, library):
    from hashlib import sha256

    texts = {r.doc_id: r.text or "" for r in table(spark, small, "documents").collect()}
    rows = queries.QUERIES["op12_byte_bpe"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == sha256(texts[r.doc_id].encode()).hexdigest()


def test_decoding_many_texts_at_once(coder, monkeypatch):
    texts = ["", "one text", "", "naïve 😀", "a\n\nb" * 50, ""]
    packed = [coder.pack(t) for t in texts]
    for size in (1, 8, 1 << 20):
        monkeypatch.setattr(byte_bpe, "UNPACKED", size)
        assert coder.unpack_all(packed).to_pylist() == [t.encode() for t in texts]
    assert coder.unpack_all([]).to_pylist() == []
    with pytest.raises(KeyError):
        coder.unpack_all([packed[1], (10**6).to_bytes(4, "little")])
