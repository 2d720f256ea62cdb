import public_tokenizers
import pytest
from aerocast.llm import bpe
from helpers import ODD, documents, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
text = st.lists(st.one_of(st.text(max_size=8), st.sampled_from(["<|endoftext|>", "<|startoftext|>", " ", "'ll", "Σ", "İ", "e\u0301", "\x1c", "hello"]))).map("".join)


def same(t):
    mine, want = bpe.load(PATH).encode(t).tolist(), LIBRARY.encode(t, add_special_tokens=False).ids
    return mine == want and bpe.load(PATH).decode(mine) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(text)
def test_as_the_library(t):
    assert same(t)


@pytest.mark.parametrize("t", ["ab" * 700, "x1y2é" * 400, "a" * 5000, "漢字" * 500])
def test_long_words(t):
    assert same(t)


def test_scan_and_heap_agree():
    b = bpe.load(PATH)
    for w in (b"internationalization", b"abababababab", b"zzzzzzzzzzz", "überéé".encode()):
        parts = [b.inner[x] for x in w]
        parts[-1] = b.last[w[-1]]
        assert b.merge(w) == b._merge_long(parts)


def test_rows(spark):
    docs = with_clashes(documents(spark, ODD).withColumnRenamed("n_chars", "decoded"))
    out = bpe.encode_decode(docs, PATH).collect()
    assert len(out) == len(ODD)
    assert all(r.ids == [] and r.decoded == "" for r in out if r.doc_id in (1, 2, 3))
    for r in out:
        want = LIBRARY.encode(next(t[1] for t in ODD if t[0] == r.doc_id) or "", add_special_tokens=False).ids
        assert r.ids == want
    assert bpe.encode_decode(documents(spark, []), PATH).count() == 0
