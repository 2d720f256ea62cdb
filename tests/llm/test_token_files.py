import zlib

import numpy as np
import public_tokenizers
import pytest
from aerocast.llm import token_files as T
from aerocast.session import scratch_path
from helpers import ODD, documents, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = T.PieceEncoder(PATH)
text = st.lists(st.one_of(st.text(max_size=8), st.sampled_from(["<|endoftext|>", " ", "  ", "\n", " \n ", "'ll", "word", " word,", "\x1c", "\x85"]))).map("".join)


@settings(max_examples=400, deadline=None)
@given(text)
def test_ids_as_the_library(t):
    assert ENCODER.encode(t).tolist() == LIBRARY.encode(t, add_special_tokens=False).ids


def test_frames():
    data = T.frame(7, np.array([1, 2, 50_256], np.uint32), 2) + T.frame(None, np.array([2], np.uint32), 4)
    assert [(o, n, d, i.tolist()) for o, n, d, i in T.records(data)] == [(0, 29, 7, [1, 2, 50_256]), (29, 27, None, [2])]
    for at in (1, 5, 12, 20, 25, 28):
        broken = bytearray(data)
        broken[at] ^= 4
        with pytest.raises(ValueError):
            list(T.records(bytes(broken)))
    with pytest.raises((ValueError, T.struct.error)):
        list(T.records(data[:-3]))


def test_round_trip(spark):
    docs = with_clashes(documents(spark, [*ODD, (-3, "<|endoftext|> x"), *[(100 + i, f"text {i} \n" * (i % 7)) for i in range(500)]]))
    path = T.write_token_files(docs.repartition(5), scratch_path(spark, "test-tokens"), PATH)
    index = T.build_index(spark, path).collect()
    rows = docs.select("doc_id", "text").collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, [*LIBRARY.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in rows)
    got = sorted(index, key=lambda r: r.ids_before)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [w[:2] for w in want]
    before = 0
    for r, w in zip(got, want):
        assert (r.ids_before, r.n_ids, r.ids_crc32) == (before, len(w[2]), zlib.crc32(np.array(w[2], "<u4").tobytes()))
        before += len(w[2])
    read = T.read_token_files(spark, path).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in read) == want


def test_shuffled_read(spark):
    docs = with_clashes(documents(spark, [*ODD, (7, "a second seven"), (7, "a second seven"), *[(100 + i, f"text {i} \n" * (i % 7)) for i in range(900)]]))
    path = T.write_token_files(docs.repartition(5), scratch_path(spark, "test-tokens"), PATH)
    index = T.build_index(spark, path)
    whole = {(r.file, r.offset): (r.doc_id, r.ids) for r in T.read_token_files(spark, path).collect()}
    for rows in (index.orderBy(F.rand(3)), index.where("n_ids % 5 = 1").withColumn("doc_id", F.lit("clash")), index.union(index).repartition(3)):
        got = [(r.file, r.offset, r.doc_id, r.ids) for r in T.read_records(rows, path).collect()]
        assert sorted((r.file, r.offset) for r in rows.select("file", "offset").collect()) == sorted(g[:2] for g in got)
        assert all(whole[g[:2]] == g[2:] for g in got)
    order = index.coalesce(1).sortWithinPartitions(F.desc("ids_before"))
    assert [(r.file, r.offset) for r in T.read_records(order, path).collect()] == [(r.file, r.offset) for r in order.collect()]
    assert T.read_records(index.where("false"), path).count() == 0
    for bad in (F.col("offset") + 1, F.lit(None).cast("long")):
        with pytest.raises(PythonException):
            T.read_records(index.withColumn("offset", bad), path).collect()


def test_empty_table(spark):
    path = T.write_token_files(documents(spark, []), scratch_path(spark, "test-tokens"), PATH)
    assert T.build_index(spark, path).count() == 0 and T.read_token_files(spark, path).count() == 0


def test_marks_after_letters_need_no_search(monkeypatch):
    enc = T.PieceEncoder(PATH)
    monkeypatch.setattr(enc, "_part", enc._word)  # the first part is "x"
    for t in ("x word*** word,. é##| word", "x\nÉmentvié&&&\nVi. le%%%"):
        assert enc.encode(t).tolist() == LIBRARY.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("t", ["\n", "a\n", "\na", "a\n\nb", "a \nb", "a\n\tb", "a\x1c\nb", "a\nb\n "])
def test_odd_lines(t):
    assert T._odd_line(t)
    assert not any(map(T._odd_line, ["", "a", " a ", "a\nb", "a\nb c\nd"]))
