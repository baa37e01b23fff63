"""Packing tokenised documents into sequences: hierarchical best fit over what is left.

Documents are cut only where they are longer than a sequence. The pieces are dealt at random
over leaves of bounded size; each leaf packs its own by best fit, largest first, and emits
the sequences that are nearly full. The others go up a tree as items of their fill: the leaves
below one node meet, are best-fitted again whole, and so on to the root.

What goes up is bounded without losing anything. Best fit leaves no two bins of a node that
would fit together, so at most one of them is half full or less, and only that one can find
a place elsewhere. A node meets ``FAN`` of those at most, so if each child sends its
``CARRIED`` least filled bins, there are always more hosts than guests. The rest is emitted. As bins
stay whole, a leaf can cost up to half a bin against one task with everything, so leaves are many bins large.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from ledgerlark.llm.bpe import byte_alphabet
from ledgerlark.llm.common import batch_slices, written

CAPACITY = 4096
#: The id that ends every document.
END = 1
#: Pieces and sequences' worth of ids that a leaf holds on average at most, children of a node, and bins that a child sends up at most.
LEAF = 131_072
LEAF_BINS = 1024
FAN = 16
CARRIED = 1024
#: A bin with this share of its room taken is nearly full.
NEARLY = 0.99
CACHED_WORDS = 800_000
CACHED_LENGTH = 64

#: Characters that Unicode composition leaves alone and that have one lower case: ASCII and most of Latin.
_PLAIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f]*").fullmatch
# Fixed value: the steps of a tokenizer file that a word of plain characters can be taken through one by one.
_STEPS = (
    ["NFC", ("Replace", {"Regex": r"\s+"}, " "), "Lowercase"],
    [("Split", "Removed", True), ("ByteLevel", False, False)],
)


def _steps(spec: dict) -> tuple[list, list]:
    normal = [
        x["type"] if x["type"] != "Replace" else (x["type"], x["pattern"], x["content"])
        for x in (spec.get("normalizer") or {}).get("normalizers", [])
    ]
    split = [
        (x["type"], x["behavior"], x["invert"]) if x["type"] == "Split" else (x["type"], x.get("add_prefix_space"), x.get("use_regex"))
        for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    ]
    return normal, split


class _Pieces(dict):
    """Packed ids of the pieces that a word is split into, by the model of the tokenizer."""

    def __init__(self, tokenize):
        super().__init__()
        self.tokenize = tokenize
        self.letters = {b: c for b, c in byte_alphabet().items()}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        ids = self[piece] = array("I", [t.id for t in self.tokenize(spelled)]).tobytes()
        return ids


class _Words(dict):
    """Packed ids of words, that is of runs without white space, as the tokenizers library gives them.

    The tokenizer drops white space and lets nothing reach across it, so a text's ids are those of its
    words one after the other. Words of plain characters go to the library's model piece by piece, which spares
    the steps that do nothing to them; others go through the whole library. Both kinds are kept while a
    worker lives, within a bound.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        spec = json.loads(definition)
        self.tokenizer = Tokenizer.from_str(definition)
        self.added = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)").search
        self.split = None
        if _steps(spec) == _STEPS and spec["model"]["type"] == "BPE" and not spec.get("post_processor"):
            self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
            self.pieces = _Pieces(self.tokenizer.model.tokenize)

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        ids = None
        if self.split:
            # The commonest words, letters and perhaps a sign, are split without the pattern.
            sign = text[-1] if text[-1] in ".,;:!?" else ""
            stem = text[:-1] if sign else text
            if stem.isalpha() and max(stem) < "\u0180" and "\u0130" not in stem:
                ids = self.pieces[stem.lower()]
                if sign:
                    ids += self.pieces[sign]
            elif _PLAIN(text) and not self.added(text):
                ids = b"".join(map(self.pieces.__getitem__, self.split(text.lower())))
        if ids is None:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(word) <= CACHED_LENGTH:
            self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))


_encoders: dict[int, _Words] = {}


def _encoder(shared: Broadcast) -> _Words:
    """Loaded once in each Python worker, which serves many tasks."""
    definition = shared.value
    key = hash(definition)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = _Words(definition)
    return _encoders[key]


def shared_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file at ``path`` on the driver (64 MB at most), sent to every executor once.

    A file whose tokenizer keeps white space, or adds anything at the start of a text, is refused.
    """
    with open(path, encoding="utf-8") as f:
        definition = f.read(64 * 2**20 + 1)
    if len(definition) > 64 * 2**20:
        raise ValueError(f"{path} is no tokenizer file")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    whole, *words = (tokenizer.encode(x, add_special_tokens=False).ids for x in (" ab\t,\n \x0b\x0c9\r\u0301c ", "ab", ",", "9", "\u0301c"))
    if whole != sum(words, []):
        raise ValueError(f"{path}: the tokenizer does not work word by word")
    return spark.sparkContext.broadcast(definition)


def pieces(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` [, ``ids``]: the tokenised documents, cut.

    A document's ids are those of its whole text by the tokenizer file at ``path``, which must drop white
    space, then ``end``; so a NULL, empty or blank text is one piece of one id. Documents of at most
    ``capacity`` ids are one piece; a longer one is cut every ``capacity`` ids, however long it is.
    ``start`` counts its ids before the piece; ``ids`` are packed little-endian unsigned 32-bit integers, and
    ``ids_crc32`` is their checksum. Every row of ``docs`` is a document: repeated rows and
    NULL keys are documents of their own. Other columns, whatever their names, are not read; an empty table
    has no pieces.
    """
    shared = shared_tokenizer(docs.sparkSession, path)
    schema = StructType.fromDDL("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    if with_ids:
        schema = schema.add("ids", BinaryType())
    last = np.array([end], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            for some in batch_slices(batch, 1):
                out = []
                for doc, text in zip(some.column(0).to_pylist(), some.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    ids = encoder.encode(text or b"") + last
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        out.append((doc, n, at // 4, len(part) // 4, zlib.crc32(part), part))
                columns = list(zip(*out, strict=True))[: len(schema)]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=schema.names
                )

    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of every size, and the fill of every bin: largest first, each into the fullest bin with room."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while some bin has room for r
    fills: list[int] = []
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        left = room - size
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(b)
    return bins, offsets, fills


def _sent_up(fills: np.ndarray, capacity: int, carried: int) -> np.ndarray:
    """Which bins a node sends up: the least filled ones of those that are not nearly full."""
    up = np.flatnonzero(fills < NEARLY * capacity)
    if len(up) > carried:
        up = up[np.argpartition(fills[up], carried)[:carried]]
    chosen = np.zeros(len(fills), bool)
    chosen[up] = True
    return chosen


def _packed_leaf(schema: StructType, capacity: int, carried: int):
    names = schema.names

    def work(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        bins, offsets, fills = best_fit(rows["length"].to_numpy(), capacity)
        fills = np.array(fills, np.int64)
        up = _sent_up(fills, capacity, carried)[bins] & (offsets == 0)
        made = {
            "bin": pa.array((key[0].as_py() << 32) + bins),
            "at": pa.array(offsets),
            "open": pa.array(fills[bins], mask=~up),
        }
        return pa.table({n: made.get(n, rows[n] if n in rows.column_names else None) for n in names})

    return work


def _merged(capacity: int, carried: int):
    """A node's bins, best-fitted whole: each with its host (the largest in the new bin) and its shift there."""

    def work(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("bin")
        ids, sizes = rows["bin"].to_numpy(), rows["open"].to_numpy()
        bins, offsets, fills = best_fit(sizes, capacity)
        hosts = np.empty(len(fills), np.int64)
        hosts[bins[offsets == 0]] = ids[offsets == 0]
        fills = np.array(fills, np.int64)
        up = _sent_up(fills, capacity, carried)[bins] & (offsets == 0)
        return pa.table(
            {"bin": pa.array(ids), "host": pa.array(hosts[bins]), "shift": pa.array(offsets), "open": pa.array(fills[bins], mask=~up)}
        )

    return work


def pack(
    items: DataFrame, capacity: int = CAPACITY, leaf: int = LEAF, leaf_bins: int = LEAF_BINS, fan: int = FAN, carried: int = CARRIED
) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: packed into sequences of at most ``capacity``.

    ``items`` has a column ``length`` from 1 to ``capacity``; NULL or other lengths fail. Every row is an item, so
    repeated rows all get a place of their own; which of equal ones goes where is arbitrary. Offsets of a
    sequence are gapless from 0; sequence ids are unique, not consecutive. Columns called
    ``sequence_id`` or ``offset`` are replaced, others are carried along. An empty table stays empty. A leaf
    takes ``leaf`` items and ``leaf_bins`` times the capacity on average at most, dealt by a hash of their row
    number, so no key and no group of copies meets in one task.
    """
    dropped = {"sequence_id", "offset", "__item", "leaf", "bin", "at", "open"}
    items = items.select(*[F.col(f"`{c}`") for c in items.columns if c.lower() not in dropped])
    carriers = items.columns
    fine = F.col("length").between(1, capacity)
    checked = F.when(fine, F.col("length")).otherwise(F.raise_error(F.lit("length must be from 1 to the capacity")))
    items = items.withColumn("length", F.coalesce(checked, F.lit(0)).cast("bigint"))
    items = written(items.withColumn("__item", F.monotonically_increasing_id()), "pack-items")
    sizes = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("ids")).first()
    leaves = max(1, -(-sizes["n"] // leaf), -(-sizes["ids"] // (leaf_bins * capacity)))

    dealt = items.withColumn("leaf", F.pmod(F.xxhash64("__item"), F.lit(leaves))).drop("__item")
    schema = StructType.fromJson(dealt.drop("leaf").schema.jsonValue())
    for name in ("bin", "at", "open"):
        schema = schema.add(name, LongType())
    placed = written(dealt.groupBy("leaf").applyInArrow(_packed_leaf(schema, capacity, carried), schema), "pack-leaves")

    moves = None
    bins = placed.where("open IS NOT NULL").select("bin", "open")
    nodes, width = leaves, 1
    while nodes > 1:
        nodes, width = -(-nodes // fan), width * fan
        grouped = bins.groupBy(F.floor(F.shiftright("bin", 32) / F.lit(width)).alias("node"))
        done = written(
            grouped.applyInArrow(_merged(capacity, carried), "bin bigint, host bigint, shift bigint, open bigint"), "pack-round"
        )
        new = done.where("bin <> host").select("bin", "host", "shift")
        if moves is None:
            moves = new
        else:  # hosts of earlier rounds may have become guests
            later = new.select(F.col("bin").alias("host"), F.col("host").alias("next"), F.col("shift").alias("more"))
            earlier = moves.join(later, "host", "left").select(
                "bin", F.coalesce("next", "host").alias("host"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")
            )
            moves = written(earlier.union(new), "pack-moves")
        bins = done.where("open IS NOT NULL").select(F.col("host").alias("bin"), "open")

    if moves is None:
        return placed.select(*carriers, F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    moves = moves.select("bin", F.col("host").alias("__host"), F.col("shift").alias("__shift"))
    return placed.join(moves, "bin", "left").select(
        *carriers,
        F.coalesce("__host", "bin").alias("sequence_id"),
        (F.col("at") + F.coalesce("__shift", F.lit(0))).alias("offset"),
    )


def packed_sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, **options) -> DataFrame:
    """``sequence_id``, ``ids`` (array), ``documents`` (doc_id, piece, offset, length in order): the packed corpus.

    Rows, NULLs and long texts go as in ``pieces``; an empty table gives no sequence. Each sequence has at most
    ``capacity`` ids, so gathering one is bounded. The ids are moved once, to their sequence.
    """
    cut = pieces(docs, path, capacity=capacity, end=end, with_ids=True)
    cut = written(cut.withColumn("row", F.monotonically_increasing_id()), "pack-ids")
    places = pack(cut.select("row", "length"), capacity, **options).select("row", "sequence_id", "offset")
    member = F.struct("offset", "doc_id", "piece", "length", F.col("ids").alias("packed"))
    whole = cut.join(places, "row").groupBy("sequence_id").agg(F.array_sort(F.collect_list(member)).alias("m"))

    def numbers(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            ends = np.cumsum([0, *(len(x) // 4 for x in column.to_pylist())]).astype(np.int32)
            flat = np.frombuffer(b"".join(column.to_pylist()), "<u4").astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    numbers.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    unpacked = F.arrow_udf(numbers, "array<int>")
    packed = F.aggregate("m", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["packed"]))
    return whole.select(
        "sequence_id",
        unpacked(packed).alias("ids"),
        F.transform("m", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"], x["length"])).alias("documents"),
    )
