import random

import numpy as np
import public_tokenizers
from edge import edge_docs, edge_rows, empty_docs
from tokenizers import Tokenizer

from tillroll.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_are_the_librarys():
    library = Tokenizer.from_file(PATH)
    known = packing.WordIds(open(PATH, encoding="utf-8").read())
    texts = [r[1] or "" for r in edge_rows()]
    texts += ["a<|endoftext|>b", "don't I'll 123 ４５６ ﬁ ", "A\tB\r\n C", "\x00 x\x1cy\x85z　", "ΟΔΟΣ, é, it's."]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(known.of_text(text), "<u4").tolist() == expected


def test_places_against_a_plain_search():
    rng = random.Random(1)
    bins, space = packing.BestFit(100, 8), {}
    for _ in range(2000):
        length = rng.randint(1, 100)
        fitting = [s for s in space.values() if s >= length]
        chosen, offset = bins.place(length)
        before = space.pop(chosen, 100)
        assert before == (min(fitting) if fitting else 100) and offset == 100 - before
        if before > length:
            space[chosen] = before - length
            if len(space) > 8:
                fullest = min(space.values())
                closed = [b for b in space if b not in [x for v in bins.bins.values() for x in v]]
                assert len(closed) == 1 and space.pop(closed[0]) == fullest


def test_pieces_of_edge_rows(spark):
    library = Tokenizer.from_file(PATH)
    rows = packing.pack_documents(edge_docs(spark), PATH).collect()
    whole, places = {}, {}
    for r in rows:
        assert r.length == len(r.ids) // 4 and r.start == 4096 * r.piece
        whole.setdefault((r.doc_id, r.piece), []).append(bytes(r.ids))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096
    for doc_id, text, *_ in edge_rows():
        if doc_id is None:
            continue
        expected = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        parts = [whole[k][0] for k in sorted(k for k in whole if k[0] == doc_id)]
        assert b"".join(parts) == expected
    assert len(whole[(9, 0)]) == 2  # a repeated row is packed twice


def test_empty_table(spark):
    assert packing.pack_documents(empty_docs(spark), PATH).count() == 0


def test_as_few_sequences_as_tokens_allow(spark, small):
    rows = packing.best_fit(packing.token_pieces(spark.read.parquet(f"{small}/documents.parquet"), PATH).drop("ids"))
    total, made = rows.selectExpr("sum(length)", "count(DISTINCT sequence_id)").first()
    assert made <= -(-total // 4096) * 1.01 + 1


def test_letters_whose_small_form_has_a_mark():
    """A sign after a capital I with a dot joins the mark that its small form ends with; any letter, any sign."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, known = Tokenizer.from_file(path), packing.WordIds(open(path, encoding="utf-8").read())
    letters = [c for c in map(chr, range(0x41, 0x2000)) if c.isalpha()][::7] + ["\u0130", "\u01f0", "\u0390"]
    for letter in letters:
        for sign in ".,!?;:'\")]":
            text = f"TAR{letter}H{letter}{sign} {letter}{sign}"
            expected = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(known.of_text(text), "<u4").tolist() == expected, text
