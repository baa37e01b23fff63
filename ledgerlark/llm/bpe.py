"""Byte-level BPE, encoding and decoding, from a tokenizer file.

A short word is held as one contiguous array of parts and one of the ranks of adjacent
parts. The smallest rank is found by scanning, its boundary is deleted, and the two ranks
beside it are looked up anew. Scanning costs the square of the length, so words beyond
``LONG_WORD`` bytes use a heap over the same merges; both give the same parts.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Fixed value: how the byte-level pre-tokenizer splits a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_WORD = 128
CACHED_WORDS = 200_000
CACHED_LENGTH = 64
NEVER = 1 << 60
PIECE = 2 << 20


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


class Vocabulary:
    """Merges and token bytes of a byte-level BPE file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, split = spec["model"], spec["pre_tokenizer"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        odd += [k for k in ("byte_fallback", "ignore_merges", "fuse_unk") if model.get(k)]
        odd += ["normalizer"] if spec.get("normalizer") else []
        odd += ["added token"] if any(
            t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]
        ) else []
        if odd or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True):
            raise ValueError(f"not a plain byte-level BPE file: {odd or split}")
        letters = byte_alphabet()
        back = {c: b for b, c in letters.items()}
        ids = model["vocab"]
        self.first = [ids[letters[b]] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (1 + max([*ids.values(), *self.added.values()]))
        for token, i in ids.items():
            self.bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in self.added.items():
            self.bytes[i] = token.encode()


def merged_short(parts: list[int], merges: dict) -> list[int]:
    """All merges of a short word: scan for the least rank, delete that boundary, refresh its neighbours."""
    no = (NEVER, -1)
    look = merges.get
    next_to = [look(pair, no) for pair in zip(parts, parts[1:], strict=False)]
    ranks = [x[0] for x in next_to]
    while ranks:
        least = min(ranks)
        if least == NEVER:
            break
        at = ranks.index(least)
        parts[at] = look((parts[at], parts[at + 1]))[1]
        del parts[at + 1], ranks[at]
        if at:
            ranks[at - 1] = look((parts[at - 1], parts[at]), no)[0]
        if at < len(ranks):
            ranks[at] = look((parts[at], parts[at + 1]), no)[0]
    return parts


def merged_long(parts: list[int], merges: dict) -> list[int]:
    """The same merges with a heap and links, for words where scanning would be quadratic."""
    n = len(parts)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    heap = [(found[0], i, parts[i], parts[i + 1]) for i in range(n - 1) if (found := merges.get((parts[i], parts[i + 1])))]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j < 0 or parts[j] != right:
            continue
        parts[i] = merges[left, right][1]
        parts[j] = -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if found := merges.get((parts[i], parts[k])):
                heapq.heappush(heap, (found[0], i, parts[i], parts[k]))
        if (h := before[i]) >= 0 and (found := merges.get((parts[h], parts[i]))):
            heapq.heappush(heap, (found[0], h, parts[h], parts[i]))
    return [p for p in parts if p >= 0]


class Words(dict):
    """Word to packed token ids; computed when first met, short words kept."""

    def __init__(self, vocabulary: Vocabulary):
        self.first, self.merges = vocabulary.first, vocabulary.merges

    def __missing__(self, word: str) -> bytes:
        parts = [self.first[b] for b in word.encode()]
        merge = merged_short if len(parts) <= LONG_WORD else merged_long
        packed = np.array(merge(parts, self.merges), "<u4").tobytes()
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = packed
        return packed


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.words = Words(vocabulary)
        self.split = regex.compile(SPLIT).findall
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in vocabulary.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.markers = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        word = self.words.__getitem__
        if self.markers is None or not self.markers.search(text):
            return b"".join(map(word, self.split(text)))
        out = []
        for k, piece in enumerate(self.markers.split(text)):
            out += [self.added[piece]] if k % 2 else map(word, self.split(piece))
        return b"".join(out)


def shared_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file at ``path`` on the driver, sent to every executor once.

    A vocabulary does not grow with the corpus; files of over 64 MB are refused.
    """
    with open(path, encoding="utf-8") as f:
        text = f.read(64 * 2**20 + 1)
    if len(text) > 64 * 2**20:
        raise ValueError(f"{path} is no tokenizer file")
    Vocabulary(text)
    return spark.sparkContext.broadcast(text)


_loaded: dict[int, tuple[Vocabulary, Encoder]] = {}


def _ready(shared: Broadcast) -> tuple[Vocabulary, Encoder]:
    """Parsed once in each Python worker, which serves many tasks."""
    text = shared.value
    key = hash(text)
    if key not in _loaded:
        _loaded.clear()
        vocabulary = Vocabulary(text)
        _loaded[key] = vocabulary, Encoder(vocabulary)
    return _loaded[key]


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``PIECE`` bytes of the column, one row at least."""
    values = batch.column(column)
    if pa.types.is_list(values.type):
        sizes = pc.multiply(pc.list_value_length(values), 4)
    else:
        sizes = pc.binary_length(values)
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        past = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, past + PIECE)))
        yield batch.slice(at, stop - at)
        at = stop


def _with_column(docs: DataFrame, source: str, name: str, kind: str, make) -> DataFrame:
    """``docs`` with ``name`` made from ``source``, slice by slice; a column of that name is replaced.

    Batches of many long texts would hold several copies of everything at once, so each is
    worked off in slices, and the results leave the task slice by slice.
    """
    fields = [f for f in docs.schema.fields if f.name.lower() != name.lower()]
    schema = StructType([*fields, StructField(name, StructType.fromDDL(f"x {kind}")["x"].dataType)])
    kept = [f.name for f in fields]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias("__in"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = make()
        for batch in batches:
            for piece in _pieces(batch, len(kept)):
                made = to(piece.column(len(kept)))
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], made], names=[*kept, name])

    return rows.mapInArrow(work, schema)


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", packed: bool = False) -> DataFrame:
    """``docs`` with the token ids of every whole text; NULL and empty texts have no tokens.

    Ids are an array of integers or, ``packed``, a binary of little-endian unsigned 32-bit
    integers. Strings of added tokens inside a text become those tokens, as the file
    declares. A column that is called ``ids`` already is replaced. Rows never move and
    repeated rows agree.
    """
    shared = shared_vocabulary(docs.sparkSession, path)

    def make():
        encode = _ready(shared)[1]

        def one(texts: pa.Array) -> pa.Array:
            coded = [encode(x) if x else b"" for x in texts.to_pylist()]
            if packed:
                return pa.array(coded, pa.binary())
            ends = np.cumsum([0, *map(len, coded)]) // 4
            flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))

        return one

    return _with_column(docs, text, ids, "binary" if packed else "array<int>", make)


def decode_documents(docs: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the text that ``ids`` (array or packed) stand for, in column ``text``, which is replaced if there.

    Bytes that are no UTF-8 become U+FFFD; NULL ids give a NULL text.
    """
    shared = shared_vocabulary(docs.sparkSession, path)

    def make():
        token = _ready(shared)[0].bytes.__getitem__

        def text_of(x) -> str | None:
            if x is None:
                return None
            numbers = np.frombuffer(x, "<u4").tolist() if isinstance(x, bytes) else x
            return b"".join(map(token, numbers)).decode("utf-8", "replace")

        return lambda column: pa.array(map(text_of, column.to_pylist()), pa.string())

    return _with_column(docs, ids, text, "string", make)
