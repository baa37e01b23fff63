"""Near-duplicates by bottom-k sketches of one hash function.

Every document's set of word shingles is hashed once; its k smallest hashes are its
sketch. Documents with equal sets are one class from then on. Inverted lists of the
retained values bring classes together, the sketch of the union of two classes bounds
their similarity, and what may reach the threshold is confirmed on the full sets.

No list is multiplied out. A class is listed under its *rarest* retained values only:
two sketches that share at least ``least_shared`` values share one of the first
``size - least_shared + 1`` in any common order, so passages that many documents hold,
being the most frequent values, bring nobody together on their own. Short sketches pick the
classes that share a list at all; those get long sketches, and there the place of the
first shared value bounds what a pair can share. Within a list, classes are first compared
with one pivot of similar size; confirmed links join them to components, and only
classes that are still in different components are compared pair by pair. Links within
a component cannot change the result, which is the components. Where a list has many pairs
for its classes, sets are not moved once for every pair: blocks of its classes get each set once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StructType

from ledgerlark.llm.common import SENT_ROWS, Scratch, sent_along, slices, written
from ledgerlark.llm.graph import components

SKETCH = 32
LONG_SKETCH = 512
CACHED_WORDS = 100_000
STAR_ROUNDS = 6
#: From so many pairs on, lists with ``DENSE`` times more pairs than sets to be moved are compared in blocks.
BLOCK_PAIRS = 20_000
DENSE = 2
#: Values of sets in one half of a block, a few MB.
BLOCK_VALUES = 1 << 19
#: A sketch may miss a link at the threshold once in so many.
MISSED = 10**12
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 40:
            self[word] = value
        return value


def shingle_hashes(data: bytes, size: int, hashes: dict) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles; a shorter text is one shingle."""
    words = data.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.int64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    x = np.full(n, width, np.uint64)
    for k in range(width):
        x = (x ^ codes[k : k + n]) * _ODD[k % len(_ODD)]
        x ^= x >> np.uint64(29)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return np.unique(x.view(np.int64))


def _long_lists(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*lists, np.empty(0, np.int64)])))


def sketched(size: int, k: int):
    """Column function: n (size of the set), set_key (128-bit digest of it), sketch (k smallest hashes)."""
    schema = StructType.fromDDL("n bigint, set_key binary, sketch array<bigint>")
    kind = to_arrow_type(schema)

    def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _WordHashes()
        for some in slices(texts):
            sets = [shingle_hashes(x, size, hashes) for x in some]
            yield pa.StructArray.from_arrays(
                [
                    pa.array(list(map(len, sets)), pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    _long_lists([s[:k] for s in sets]),
                ],
                fields=list(kind),
            )

    batches.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, schema).asNondeterministic()  # see per_text


def full_sets(size: int):
    """Column function: all shingle hashes of a text."""

    def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _WordHashes()
        for some in slices(texts):
            yield _long_lists([shingle_hashes(x, size, hashes) for x in some])

    batches.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, ArrayType(LongType())).asNondeterministic()


def least_shared(k: int, percent: int) -> int:
    """Values that two sketches of size k share at least, for sets at the threshold.

    Of the k smallest values of the union each lies in both sets with a probability of the
    similarity, drawn without replacement, so the binomial tail bounds the chance of fewer. It
    is summed in whole numbers, and the largest bound that it leaves out with a chance of
    at most ``MISSED`` is taken.
    """
    term, tail, shared = (100 - percent) ** k, 0, 0
    while (tail + term) * MISSED <= 100**k:
        tail += term
        term = term * (k - shared) * percent // ((shared + 1) * (100 - percent))
        shared += 1
    return max(1, shared)


def rare_lists(sketches: DataFrame, k: int, percent: int) -> DataFrame:
    """``v``, ``cls``, ``n``, ``place``: the classes under their rarest retained values, from rare to frequent.

    ``place`` counts from 1 through all values of the sketch. Values of one class make no list.
    """
    postings = sketches.select("cls", "n", F.explode("sketch").alias("v"))
    often = postings.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    held = postings.join(often, "v").groupBy("cls", "n").agg(F.array_sort(F.collect_list(F.struct("c", "v"))).alias("l"))
    size = F.least(F.col("n"), F.lit(k))
    # Sets of up to k shingles are their own sketch, and the bound on them is exact.
    shared = F.least(F.lit(least_shared(k, percent)), F.ceil(F.col("n") * F.lit(percent) / 100))
    # Values that occur once are the rarest: they use up places without a list.
    alone = size - F.size("l")
    first = F.slice("l", F.lit(1), F.greatest(size - shared + 1 - alone, F.lit(0)).cast("int"))
    listed = held.select("cls", "n", alone.alias("alone"), F.posexplode(first).alias("at", "x"))
    return listed.select("x.v", "cls", "n", (F.col("alone") + F.col("at") + 1).alias("place"))


def may_reach(an: Column, ap: Column, bn: Column, bp: Column, k: int, percent: int) -> Column:
    """Whether two classes whose first shared value has places ap and bp can be alike enough.

    Sizes must fit, and what is left of both sketches from that value on must be able to hold
    the shared values that the threshold asks for: exactly so many where both sketches are
    whole sets, else ``least_shared``. The condition holds in the list of the first
    shared value of every link, so no link is lost by testing it in every list.
    """
    fits = F.least(an, bn) * 100 >= F.greatest(an, bn) * percent
    exact = F.ceil((an + bn) * percent / F.lit(100 + percent))
    asked = F.when(F.greatest(an, bn) <= k, exact).otherwise(F.lit(least_shared(k, percent)))
    left = F.least(F.least(an, F.lit(k)) - ap, F.least(bn, F.lit(k)) - bp) + 1
    return fits & (left >= asked)


def star_pairs(lists: DataFrame, k: int, percent: int, salt: int) -> DataFrame:
    """Pairs (a < b) of classes in different components: those of a list with its pivots.

    There is a pivot per list and band of sizes; a class meets those of its own band and of
    the one below, which holds every size that could match from below. First the class with
    the fewest rarer values is the pivot, which is the most typical one; later ones are drawn.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent))).cast("bigint")
    members = lists.withColumn("band", band)
    first = F.col("place") if not salt else F.lit(0)
    drawn = F.struct(first.alias("o"), F.xxhash64(F.col("cls"), F.lit(salt)).alias("h"), "cls", "n", "place", "comp")
    pivots = members.groupBy("v", "band").agg(F.min(drawn).alias("p")).select("v", "band", "p.cls", "p.n", "p.place", "p.comp")
    pivots = pivots.toDF("v", "band", "pcls", "pn", "pplace", "pcomp")
    near = members.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    met = near.join(pivots, ["v", "band"]).where(
        (F.col("comp") != F.col("pcomp")) & may_reach(F.col("n"), F.col("place"), F.col("pn"), F.col("pplace"), k, percent)
    )
    return met.select(F.least("cls", "pcls").alias("a"), F.greatest("cls", "pcls").alias("b")).distinct()


def open_lists(lists: DataFrame) -> DataFrame:
    """Lists that still hold several components, with whether a member is of the largest of its list."""
    by = lists.groupBy("v", "comp").agg(F.count(F.lit(1)).alias("c"))
    tops = by.groupBy("v").agg(F.count(F.lit(1)).alias("kinds"), F.max_by("comp", F.struct("c", "comp")).alias("top"))
    tops = tops.where("kinds > 1").select("v", "top")
    return lists.join(tops, "v").withColumn("minor", F.col("comp") != F.col("top")).drop("top")


def first_meetings(lists: DataFrame) -> DataFrame:
    """The lists without repeats, each row with ``prior``: the earlier listed values of its class.

    Of lists with the same members only the first is kept: members agree on the order of the values they
    share, so the first value that two of them share is never one that is left out. Members are told by two sums
    of 64-bit hashes, so the lists need not be gathered. A class has fewer than ``LONG_SKETCH`` listed values.
    """
    sums = [F.sum(F.xxhash64("cls", F.lit(seed)).cast("decimal(38,0)")).alias(f"s{seed}") for seed in (1, 2)]
    by = lists.groupBy("v").agg(F.count(F.lit(1)).alias("c"), *sums, F.min(F.struct("cls", "place")).alias("m"))
    kept = by.groupBy("c", "s1", "s2").agg(F.min(F.struct("m.place", "v")).alias("first")).select("first.v")
    held = lists.join(kept, "v", "left_semi")
    held = held.groupBy("cls", "n", "comp").agg(F.array_sort(F.collect_list(F.struct("place", "v", "minor"))).alias("l"))
    rows = held.select("cls", "n", "comp", "l", F.posexplode("l").alias("at", "x"))
    prior = F.slice(F.transform("l", lambda x: x["v"]), F.lit(1), F.col("at"))
    return rows.select("x.v", "cls", "n", "x.place", "comp", "x.minor", prior.alias("prior"))


def other_pairs(lists: DataFrame, k: int, percent: int, listed: bool = False) -> DataFrame:
    """All pairs (a < b) that share a list, may reach the threshold and are in different components.

    One side is always outside the list's largest component, so a large group of copies
    is met by outsiders and never by itself. A pair is made in the list of its first shared value alone, so
    once, however many values it shares; ``listed`` adds that value as ``v``.
    """
    lists = first_meetings(lists)
    left = lists.where("minor").select("v", *[F.col(c).alias(f"x{c}") for c in ("cls", "n", "place", "comp", "prior")])
    once = ~F.col("minor") | (F.col("xcls") < F.col("cls"))
    may = may_reach(F.col("xn"), F.col("xplace"), F.col("n"), F.col("place"), k, percent)
    new = ~F.arrays_overlap("xprior", "prior")
    met = left.join(lists, "v").where((F.col("xcomp") != F.col("comp")) & once & may & new)
    pairs = met.select(F.least("xcls", "cls").alias("a"), F.greatest("xcls", "cls").alias("b"), "v")
    return pairs.groupBy("a", "b").agg(F.min("v").alias("v")) if listed else pairs.select("a", "b").distinct()


def met_sets(pairs: DataFrame, sets: DataFrame, values: Column) -> DataFrame:
    """Stored pairs (a, b) with the sizes and the values of both classes.

    Few pairs are sent along, and then only sets that are in one are shuffled.
    """

    def side(name: str) -> DataFrame:
        return sets.select(F.col("cls").alias(name), F.col("n").alias(f"n{name}"), values.alias(f"s{name}"))

    others = side("b")
    if pairs.count() <= SENT_ROWS:
        others = others.join(F.broadcast(pairs.select("b")), "b", "left_semi")
        pairs = F.broadcast(pairs)
    return pairs.join(side("a"), "a").join(others, "b")


def in_blocks(pairs: DataFrame, weights: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Stored pairs (a, b, v) as those that are met one by one, and those of dense lists with their ``block``, if any.

    ``weights`` has the values ``w`` of every ``cls``. The classes of a list are dealt into parts of about
    ``BLOCK_VALUES``, and a block holds two parts; small lists share one. So a set is moved once for
    every part of its lists, however many pairs it is in. Pairs without ``v`` stay single.
    """
    if "v" not in pairs.columns or pairs.count() < BLOCK_PAIRS:
        return pairs, None
    ends = pairs.select("v", F.explode(F.array("a", "b")).alias("cls")).distinct()
    sums = ends.join(weights.groupBy("cls").agg(F.sum("w").alias("w")), "cls").groupBy("v")
    sums = sums.agg(F.count(F.lit(1)).alias("m"), F.sum("w").alias("w"))
    sums = sums.withColumn("parts", F.ceil(F.col("w") / F.lit(BLOCK_VALUES)))
    counts = pairs.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    dense = counts.join(sums, "v").where(F.col("c") >= F.col("m") * F.col("parts") * F.lit(DENSE))
    dense = scratch.stored(dense.select("v", "parts", "w"), "near-dense")
    values = dense.agg(F.sum(F.col("w") * F.col("parts"))).first()[0]
    if not values:
        return pairs, None
    lists = sent_along(dense.select("v", "parts"))
    single = scratch.stored(pairs.join(lists, "v", "left_anti").select(pairs.columns), "near-single")
    x, y = (F.pmod(F.xxhash64(c), "parts") for c in "ab")
    block = F.pmod(F.xxhash64("v", F.least(x, y), F.greatest(x, y)), F.lit(-(-values // BLOCK_VALUES)))
    return single, scratch.stored(pairs.join(lists, "v").select("a", "b", "v", block.alias("block")), "near-blocks")


def _alike(k: int | None, percent: int):
    """Arrow function of a block's pairs and sets: the pairs that are or may be alike, and whether that is ``whole``, so sure.

    Without ``k`` the values are full sets. A class may have several sets; each is compared.
    """
    asked = least_shared(k, percent) if k else 0

    def block(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        sets = sets.sort_by("cls")
        ids, sizes = sets["cls"].to_numpy(), sets["n"].to_numpy()
        values = sets["held"].combine_chunks()
        flat, ends = values.values.to_numpy(), values.offsets.to_numpy()
        rows, sure = [], []
        ranges = [np.searchsorted(ids, pairs[c].to_numpy(), side).tolist() for c in "ab" for side in ("left", "right")]
        for row, (a, past_a, b, past_b) in enumerate(zip(*ranges, strict=True)):
            for i in range(a, past_a):
                for j in range(b, past_b):
                    both = np.concatenate((flat[ends[i] : ends[i + 1]], flat[ends[j] : ends[j + 1]]))
                    both.sort(kind="stable")
                    again = both[1:] == both[:-1]
                    shared, union = int(again.sum()), len(both) - int(again.sum())
                    whole = not k or max(sizes[i], sizes[j]) <= k
                    if not whole:
                        if union > k:
                            least = both[np.concatenate(([True], ~again))][k - 1]
                            shared = int(np.searchsorted(both[1:][again], least, "right"))
                        alike = shared >= asked
                    else:
                        alike = shared * 100 >= union * percent
                    if alike:
                        rows.append(row)
                        sure.append(whole)
        found = pairs.select(["a", "b", "v"]).take(pa.array(rows, pa.int64()))
        return found.append_column("whole", pa.array(sure, pa.bool_()))

    return block


def block_pairs(dense: DataFrame, sets: DataFrame, values: Column, k: int | None, percent: int, scratch: Scratch) -> DataFrame:
    """The stored pairs of blocks that are alike, or may be where sketches of ``k`` are not whole sets: a, b, v, whole."""
    ends = dense.select("block", F.explode(F.array("a", "b")).alias("cls")).distinct()
    ends = sent_along(scratch.stored(ends, "near-ends"))
    moved = sets.select("cls", "n", values.alias("held")).join(ends, "cls")
    both = dense.groupBy("block").cogroup(moved.groupBy("block"))
    return both.applyInArrow(_alike(k, percent), "a bigint, b bigint, v bigint, whole boolean")


def confirmed(pairs: DataFrame, sets: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs whose full sets reach the threshold, stored; most others fall by the estimate of the union's sketch.

    Where both sketches are whole sets they are exact at once, and only the other pairs meet their full sets. One
    of such a pair is larger than a sketch, so no set below the threshold's share of that size is part of a link.
    Pairs with the list ``v`` that they come from are compared in blocks where that list is dense.
    """
    both = F.size(F.array_intersect("sa", "sb"))
    reached = both * 100 >= (F.size("sa") + F.size("sb") - both) * percent
    pairs = scratch.stored(pairs, "near-pairs")
    columns = pairs.columns
    single, dense = in_blocks(pairs, sets.select("cls", F.least("n", F.lit(k)).alias("w")), scratch)
    met = met_sets(single, sets, F.col("sketch"))
    whole = F.greatest("na", "nb") <= k
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    likely = F.size(F.array_intersect(union, F.array_intersect("sa", "sb"))) >= least_shared(k, percent)
    met = met.where(F.when(whole, reached).otherwise(likely)).select(*columns, whole.alias("whole"))
    if dense is not None:
        met = met.unionByName(block_pairs(dense, sets, F.col("sketch"), k, percent, scratch))
    met = scratch.stored(met, "near-likely")
    pairs = scratch.stored(met.where("NOT whole").select(columns), "near-unsure")
    large, full = sets.where(F.col("n") * 100 > k * percent), F.coalesce("set", "sketch")
    single, dense = in_blocks(pairs, large.select("cls", F.col("n").alias("w")), scratch)
    sure = met_sets(single, large, full).where(reached).select("a", "b")
    if dense is not None:
        sure = sure.union(block_pairs(dense, large, full, None, percent, scratch).select("a", "b"))
    links = written(met.where("whole").select("a", "b").union(sure).distinct(), "near-links")
    scratch.drop("near-pairs", "near-likely", "near-unsure", "near-dense", "near-single", "near-blocks", "near-ends")
    return links


def same_id_links(live: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links between the classes of ids that have several texts; usually there are none."""
    several = live.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi"))
    several = written(several.where("lo <> hi").select("doc_id"), "near-several")
    if not several.count():
        return None
    held = live.join(several, "doc_id", "left_semi").join(classes, "set_key").groupBy("doc_id", "cls").count()
    first = held.groupBy("doc_id").agg(F.min("cls").alias("a"))
    pairs = held.join(first, "doc_id").where("a <> cls").select("a", F.col("cls").alias("b"))
    return written(pairs.distinct(), "near-links")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    k: int = SKETCH,
    long_k: int = LONG_SKETCH,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked when 100 * |intersection| >= ``percent`` * |union| of their sets of
    ``size``-word shingles (white space splits words, A-Z count as lower case). A text of
    fewer words is one shingle; a NULL or blank text has an empty set and no links. The
    component is named after its smallest id, and ``kept`` marks that document. Rows of one
    id are one document with several texts, linked by any of them, and share the verdict; rows
    with a NULL id take no part and are kept.
    """
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    seen = written(docs.select("doc_id", sketched(size, k)(F.col("text")).alias("s")).select("doc_id", "s.*"), "near-sketches")
    live = seen.where("n > 0 AND doc_id IS NOT NULL")
    least = live.groupBy("set_key").agg(F.min(F.struct("doc_id", "n", "sketch")).alias("r"))
    reps = written(least.select("set_key", F.col("r.doc_id").alias("cls"), "r.n", "r.sketch"), "near-classes")

    # Classes that meet another one in a list of short sketches; the others are done.
    listed = rare_lists(reps, k, percent).select(F.col("cls").alias("doc_id")).distinct()
    listed = sent_along(written(listed, "near-listed"))
    texts = docs.where("doc_id IS NOT NULL").join(listed, "doc_id", "left_semi")
    sets = texts.select(F.col("doc_id").alias("cls"), full_sets(size)(F.col("text")).alias("set")).where("size(set) > 0")
    sets = sets.select("cls", F.size("set").cast("bigint").alias("n"), F.slice("set", 1, long_k).alias("sketch"), "set")
    sets = sets.withColumn("set", F.when(F.col("n") > long_k, F.col("set")))
    scratch = Scratch(docs.sparkSession)
    sets = scratch.stored(sets, "near-sets")

    lists = scratch.stored(rare_lists(sets.select("cls", "n", "sketch"), long_k, percent), "near-lists")
    lists = lists.withColumn("comp", F.col("cls"))
    links, joined = same_id_links(live, reps), None
    for turn in range(STAR_ROUNDS + 1):
        lists = scratch.stored(open_lists(lists), "near-open")
        scratch.drop("near-lists")
        by = lists.groupBy("v").agg(F.count(F.lit(1)).alias("c"), F.count_if("minor").alias("m"))
        todo = by.agg(F.sum(F.col("c") * F.col("m")).alias("pairs"), F.sum("c").alias("members")).first()
        if not todo["pairs"]:
            break
        last = turn > 0 and (todo["pairs"] <= 1000 * todo["members"] or turn == STAR_ROUNDS)
        pairs = other_pairs(lists, long_k, percent, listed=True) if last else star_pairs(lists.drop("minor"), long_k, percent, turn)
        found = confirmed(pairs, sets, long_k, percent, scratch)
        links = found if links is None else links.union(found)
        joined = scratch.stored(components(links), "near-components")
        if last:
            break
        now = lists.drop("comp", "minor").join(joined, F.col("cls") == F.col("node"), "left")
        lists = now.select("v", "cls", "n", "place", F.coalesce("component", "cls").alias("comp"))
    scratch.drop("near-open", "near-sets")

    classes = reps.select("set_key", "cls")
    if links is not None:
        joined = joined or written(components(links), "near-components")
        named = classes.join(joined, F.col("cls") == F.col("node"), "left")
        classes = named.select("set_key", F.coalesce("component", "cls").alias("cls"))
    out = seen.select("doc_id", "n", "set_key").join(classes, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("cls", "doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
