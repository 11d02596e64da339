"""The piece encoder gives the library's ids for any text."""
import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from shopstream.llm.pieces import PieceEncoder, count_tokens  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENC = PieceEncoder(PATH)
SMALL = PieceEncoder(PATH, bits=6)


def check(texts, enc=ENC):
    want = [e.ids for e in enc.lib.encode_batch(texts, add_special_tokens=False)]
    ids, counts = enc.encode(texts)
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]
    assert enc.count(texts).tolist() == counts.tolist()


ALPHABET = st.one_of(st.sampled_from(list(" \n\t'stmdrevl!?.,09aZé \u0085\x1c 　²½中")),
                     st.characters(codec="utf-8"))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), max_size=5))
def test_any_text(texts):
    check(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), max_size=5))
def test_full_table_is_emptied(texts):
    check(texts, SMALL)


def test_edges():
    check([])
    check(["", "", "a", ""])
    check(["it's we'll they've I'd I'm you're 's'sky '' ''s x'lly \n's  's", "don't", "'", "'s", "a'", "l'", "'l", "'v"])
    check(["<|endoftext|>", "a<|endoftext|> b", "a  \n\n  b   ", "   ", "\n", "x" * 500 + " " + "y" * 70, "!" * 200])


def test_documents():
    rows = duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    check([r[0] or "" for r in rows])


def test_other_vocabularies():
    texts = ["Hello  World", "", "a <|endoftext|> b", "é中"]
    from tokenizers import Tokenizer
    p = public_tokenizers.path("word_bpe_49k.json")
    want = [len(e.ids) for e in Tokenizer.from_file(p).encode_batch(texts, add_special_tokens=False)]
    assert count_tokens(p, texts).tolist() == want
    import sentencepiece
    m = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=m)
    assert count_tokens(m, texts).tolist() == [len(x) for x in sp.encode(texts)]
    assert isinstance(count_tokens(m, []), np.ndarray)
