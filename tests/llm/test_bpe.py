"""Encoding against the tokenizers library, and exact round trips."""

import hashlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlark.llm import bpe, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return bpe.Encoder(vocabulary)


def same(library, encoder, vocabulary, text):
    ours = np.frombuffer(encoder(text), "<u4").tolist()
    assert ours == library.encode(text, add_special_tokens=False).ids
    back = b"".join(vocabulary.bytes[i] for i in ours).decode("utf-8", "replace")
    assert back == library.decode(ours, skip_special_tokens=False) == text


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(" \n'streadaé<|endoftext>中", max_size=80))
def test_any_text(library, encoder, vocabulary, text):
    same(library, encoder, vocabulary, text)


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "'s'S 're", "\x1c\x1d \x85　​ x",
        "a" * 3000, "antidisestablishment" * 40, "  \n\n  x  ", "🙂👩‍👩‍👧", "\x00\x01", "1234567890" * 50, "é" * 700,
    ],
)
def test_odd_texts(library, encoder, vocabulary, text):
    same(library, encoder, vocabulary, text)


def test_each_character_of_the_basic_plane(library, encoder, vocabulary):
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    same(library, encoder, vocabulary, " ".join(points))


@settings(max_examples=200, deadline=None)
@given(st.text("aein rst", min_size=1, max_size=90))
def test_heap_and_scan_merge_alike(vocabulary, word):
    parts = [vocabulary.first[b] for b in word.encode()]
    assert bpe.merged_short(list(parts), vocabulary.merges) == bpe.merged_long(list(parts), vocabulary.merges)


def test_a_long_word_takes_no_quadratic_time(encoder):
    assert len(encoder("ab" * 200_000)) > 0


def test_query(spark, library):
    texts = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{FOLDER}/documents.parquet'").fetchall())
    rows = queries.QUERIES["op4_bpe"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_frames(spark):
    path = queries.tokenizer_path()
    schema = "doc_id bigint, text string, ids string"
    rows = [(1, None, "x"), (2, "", "x"), (3, "hello there", None), (3, "hello there", None), (None, "a<|endoftext|>", "")]
    coded = bpe.encode_documents(spark.createDataFrame(rows, schema), path)
    out = {r.doc_id: r.ids for r in coded.collect()}
    assert out[1] == [] and out[2] == [] and out[3] == [31373, 612] and out[None] == [64, 50256]
    back = bpe.decode_documents(coded.withColumn("more", coded.doc_id), path).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == [(0, "a<|endoftext|>"), (1, ""), (2, ""), (3, "hello there"), (3, "hello there")]
    missing = bpe.decode_documents(spark.createDataFrame([(1, None), (2, [256]), (3, [255, 31373])], "doc_id int, ids array<int>"), path)
    assert {r.doc_id: r.text is None for r in missing.collect()} == {1: True, 2: False, 3: False}
    none = spark.createDataFrame([], schema)
    assert bpe.decode_documents(bpe.encode_documents(none, path), path).collect() == []


def test_other_files_are_refused(tmp_path):
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.Vocabulary(f.read())
