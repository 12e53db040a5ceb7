import random

import public_tokenizers
from edge import edge_docs, edge_rows, empty_docs
from tokenizers import Tokenizer

from tillroll.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_same_as_the_library():
    library = Tokenizer.from_file(PATH)
    coder = bpe.Bpe(open(PATH, encoding="utf-8").read())
    rng = random.Random(2)
    alphabet = "ab E,.'\n\t é 　😀١<|"
    texts = [r[1] or "" for r in edge_rows()]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += ["x<|endoftext|> y", "<|endoftext|>", "a\n\nb", " a", "a ", "\n \n", "it's they'll"]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        found = coder.encode(text)
        assert found == expected
        assert coder.decode(found) == library.decode(expected, skip_special_tokens=False)


def test_decode_of_parts_of_characters():
    coder = bpe.Bpe(open(PATH, encoding="utf-8").read())
    library = Tokenizer.from_file(PATH)
    ids = coder.encode("😀é")
    for end in range(len(ids) + 1):
        assert coder.decode(ids[:end]) == library.decode(ids[:end], skip_special_tokens=False)


def test_columns(spark):
    docs = edge_docs(spark)
    both = bpe.round_trip(docs, PATH)
    apart = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert both.columns == [*docs.columns, "ids", "decoded"]
    key = lambda rows: sorted(map(str, rows))
    assert key(both.collect()) == key(apart.collect())
    assert all(r.decoded == (r.text or "") and r.score == "own" for r in both.collect())
    assert bpe.round_trip(empty_docs(spark), PATH).count() == 0
