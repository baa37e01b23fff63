"""Packing: the tokenizers library's ids, gapless sequences, and few of them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlark.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, length string, sequence_id string, leaf string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder(tokenizer):
    return packing._Words(tokenizer.to_str())


def whole_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def plain_pieces(tokenizer, rows, capacity=4096):
    out = []
    for doc, text in rows:
        ids = whole_ids(tokenizer, text)
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


def check_places(rows, capacity):
    """rows: (sequence_id, offset, length): gapless from 0 and within the capacity. Returns the number of sequences."""
    by = {}
    for s, at, n in rows:
        by.setdefault(s, []).append((at, n))
    for places in by.values():
        at = 0
        for start, n in sorted(places):
            assert start == at
            at += n
        assert 0 < at <= capacity
    return len(by)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAé'ls 9,.!<|>\n\t\x0b\x0c\r\x1c\x85\xa0 ́İΣ日😀�\x00")))
def test_words_one_by_one_are_the_whole_text(tokenizer, encoder, text):
    got = encoder.encode(text.encode())
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_plain_character(tokenizer, encoder):
    plain = [chr(c) for c in range(0x250) if packing._PLAIN(chr(c))]
    assert len(plain) > 300
    for c in plain:
        for text in (c, f"a{c}b{c}{c}", f"{c}7{c}.{c}'s", f"{c}\u0301"):
            assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_whole_texts(spark, tokenizer, encoder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").where("text IS NOT NULL").collect()
    for (text,) in docs:
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_word_cache_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    encoder = packing._Words(tokenizer.to_str())
    for text in ["a b c", "d e f a", "x" * 100 + " " + "x" * 100, "", " ".join(map(str, range(50))), "a a"]:
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert b"x" * 100 not in encoder and len(encoder.pieces) <= 5
    assert len(encoder) <= 5


ROWS = [(1, "Hello, world's <|endoftext|> end"), (1, "Hello, world's <|endoftext|> end"), (None, "x y"), (None, None), (2, ""), (3, " \n"), (4, "word " * 30_000)]


def test_pieces(spark, tokenizer):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in ROWS], SCHEMA)
    assert sorted(map(tuple, packing.pieces(df, PATH).collect()), key=repr) == plain_pieces(tokenizer, ROWS)
    got = packing.pieces(df, PATH, capacity=7, with_ids=True).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == plain_pieces(tokenizer, ROWS, 7)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    assert packing.pieces(df.limit(0), PATH).count() == 0


def test_other_tokenizers_are_refused(spark):
    with pytest.raises(ValueError, match="word by word"):
        packing.pieces(spark.createDataFrame([], SCHEMA), public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit(sizes):
    bins, offsets, fills = packing.best_fit(np.array(sizes, np.int64), 50)
    assert check_places(zip(bins.tolist(), offsets.tolist(), sizes, strict=True), 50) == len(fills) if sizes else not fills
    # Plain best fit, largest first: the fullest bin that has room.
    rooms = []
    for size in sorted(sizes, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= size]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= size
        else:
            rooms.append(50 - size)
    assert sorted(fills) == sorted(50 - room for room in rooms)
    assert all(a + b > 50 for i, a in enumerate(fills) for b in fills[:i])  # the reason why little goes up


def packed(spark, lengths, capacity=4096, **options):
    df = spark.createDataFrame([(i, n, "x", "y") for i, n in enumerate(lengths)], "doc_id bigint, length bigint, offset string, bin string")
    out = packing.pack(df.drop("bin"), capacity, **options)
    assert out.columns == ["doc_id", "length", "sequence_id", "offset"]
    rows = out.collect()
    assert sorted((r.doc_id, r.length) for r in rows) == sorted(enumerate(lengths))
    return check_places([(r.sequence_id, r.offset, r.length) for r in rows], capacity)


@pytest.mark.parametrize("kind", ["mixed", "halves", "small", "large"])
def test_hierarchy_is_as_good_as_one_task(spark, kind):
    rng = random.Random(4)
    draw = {
        "mixed": lambda: min(4096, int(rng.lognormvariate(6, 1.2)) + 1),
        "halves": lambda: rng.choice([1500, 2500, 2049, 2048]),
        "small": lambda: rng.randint(1, 40),
        "large": lambda: rng.randint(2500, 4096),
    }[kind]
    lengths = [draw() for _ in range(3000)]
    one = len(packing.best_fit(np.array(lengths), 4096)[2])
    for options in (dict(leaf=150, fan=3, carried=8), dict(leaf_bins=20, fan=2, carried=64), dict(leaf=5000)):
        n = packed(spark, lengths, **options)
        leaves = max(-(-3000 // options.get("leaf", 5000)), -(-sum(lengths) // (4096 * options.get("leaf_bins", 10**6))))
        assert n <= one * 1.01 + (leaves - 1) / 2, (kind, options, n, one)
        assert n >= -(-sum(lengths) // 4096)


def test_one_small_piece_a_leaf_travels_to_the_root(spark):
    """Halves left over in every leaf meet further up, over several rounds."""
    lengths = [100] * 64
    assert packed(spark, lengths, capacity=1000, leaf=1, fan=4, carried=4) <= 8  # 7 at best


def test_pack_edges(spark):
    assert packed(spark, []) == 0
    assert packed(spark, [1]) == 1
    assert packed(spark, [4096] * 5) == 5
    df = spark.createDataFrame([(7, 3)] * 500, "doc_id bigint, length bigint")  # equal rows
    rows = packing.pack(df, 10, leaf=50).collect()
    assert len(rows) == 500 and check_places([(r.sequence_id, r.offset, r.length) for r in rows], 10) <= 168
    for bad in (0, 11, None):
        with pytest.raises(Exception, match="capacity"):
            packing.pack(spark.createDataFrame([(1, bad)], "doc_id bigint, length bigint"), 10)


def test_packed_sequences_hold_the_documents(spark, tokenizer):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in ROWS], SCHEMA)
    out = packing.packed_sequences(df, PATH, capacity=100, leaf=20, fan=2).collect()
    found = {}
    for r in out:
        assert len(r.ids) <= 100 and sum(d.length for d in r.documents) == len(r.ids)
        for d in r.documents:
            found.setdefault((d.doc_id, d.piece), []).append(tuple(r.ids[d.offset : d.offset + d.length]))
    expected = {}
    for doc, text in ROWS:
        ids = whole_ids(tokenizer, text)
        for n, at in enumerate(range(0, len(ids), 100)):
            expected.setdefault((doc, n), []).append(tuple(ids[at : at + 100]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}


def test_query_on_a_whole_table(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op13_packing"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    expected = plain_pieces(tokenizer, map(tuple, docs.collect()))
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == expected
    n = check_places([(r.sequence_id, r.offset, r.length) for r in rows], 4096)
    best = len(packing.best_fit(np.array([e[3] for e in expected]), 4096)[2])
    assert n <= best
    assert docs.count() == len({r.doc_id for r in rows})
