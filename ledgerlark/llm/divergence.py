"""Source divergence: how far the word use of each source is from the others of its language.

Terms are counted in one pass over the texts, and everything after that works on counts. The
comparison of all sources of a language with each other is a cube of sources, sources and
terms. It is cut into cells of a block of sources, another one and a block of terms: each
task owns one cell, gets the two slices of counts that it needs (a slice goes to one cell
per block of sources), adds up the divergences of its terms, and the partial sums are
reduced along the term axis. The measure is symmetric, so one of two mirrored cells is made.

All arithmetic is on whole numbers, exactly: decimals where counts are multiplied, and 64
bits below that, as a share is at most 10^9 + 1.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import batch_slices, written

#: Documents of a language that must hold a term, and places in the list of a source's own terms.
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
#: Sources and terms of a block, on average.
SOURCE_BLOCK = 32
TERM_BLOCK = 4096
#: Counters that a task holds before it hands them on.
HELD = 200_000
SCALE = 1_000_000_000
#: Everything but letters a-z and bytes beyond ASCII parts words; A-Z count as lower case.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple, Counter] = defaultdict(Counter)
    documents: dict[tuple, Counter] = defaultdict(Counter)

    def handed_on() -> Iterator[pa.RecordBatch]:
        for group, of in counts.items():
            terms = list(of)
            held = documents[group]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group[0]] * (len(terms) + 1), pa.string()),
                    pa.array([group[1]] * (len(terms) + 1), pa.string()),
                    pa.array([*terms, None], pa.binary()).cast(pa.string()),
                    pa.array([*of.values(), 0], pa.int64()),
                    pa.array([*(held[t] for t in terms), 0], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        counts.clear()
        documents.clear()

    held = 0
    for batch in batches:
        for some in batch_slices(batch, 2):
            texts = some.column(2).cast(pa.binary()).to_pylist()
            for lang, source, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), texts, strict=True):
                terms = terms_of(text)
                of = counts[lang, source]
                before = len(of)
                of.update(terms)
                documents[lang, source].update(set(terms))
                held += len(of) - before
                if held > HELD:
                    yield from handed_on()
                    held = 0
    yield from handed_on()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences, ``docs`` rows that hold it; one row per group has a NULL term.

    Each row of ``docs`` is a document, repeated ones too. NULL text, language and source count as empty.
    Counts are combined within a task before they are shuffled, so frequent terms and hot sources
    travel as one row a task; texts are taken whole, a slice of rows at a time.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    found = rows.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact for any 64-bit counts."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (F.col(count) if isinstance(count, str) else count).cast("decimal(20,0)")
    above = above + F.lit(2 * SCALE).cast("decimal(12,0)")
    below = (F.col(total).cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)") * F.col(terms).cast("decimal(20,0)")).cast("decimal(23,0)")
    whole = F.call_function("div", above, F.greatest(below, F.lit(1).cast("decimal(23,0)")))
    return F.lit(1).cast("bigint") + whole


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares stay below 2^30, so 64 bits hold the square."""
    apart = p - q
    return (apart * apart) // (p + q)


def _cell(rows: pa.Table) -> pa.Table:
    """Partial divergences of one cell, summed over its terms, for each pair of its two blocks of sources."""
    rows = rows.sort_by("source")
    names, blocks = rows["source"].to_pylist(), rows["block"].to_pylist()
    width = rows["width"][0].as_py()
    dense = np.empty((len(names), width), np.int64)
    for i, (base, at, shares) in enumerate(
        zip(rows["base"].to_pylist(), rows["at"].to_pylist(), rows["shares"].to_pylist(), strict=True)
    ):
        dense[i] = base
        if at:
            dense[i, at] = shares
    first, second = rows["first"][0].as_py(), rows["second"][0].as_py()
    left = [i for i, b in enumerate(blocks) if b == first]
    right = [i for i, b in enumerate(blocks) if b == second]
    out: list[tuple[str, str, int]] = []
    for n, i in enumerate(left):
        others = left[n + 1 :] if first == second else right
        if others:
            sums = divergence(dense[others], dense[i]).sum(axis=1)
            out += [(names[i], names[j], s) for j, s in zip(others, sums.tolist(), strict=True)]
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    lang = rows["lang"][0].as_py()
    return pa.table(
        {
            "lang": pa.array([lang] * len(out), pa.string()),
            "x": pa.array(columns[0], pa.string()),
            "y": pa.array(columns[1], pa.string()),
            "value": pa.array(columns[2], pa.int64()),
        }
    )


def audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    source_block: int = SOURCE_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: the audit of every (language, source) group.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z as lower case. A language keeps those that
    at least ``least`` of its documents hold. With p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)), V kept terms and
    N their occurrences in the group, the divergence at a term is floor((p - q)^2 / (p + q)).
    Part ``pair`` has every other source of the language with the sum over all kept terms;
    part ``term`` has the ``top`` terms that the group uses more than its language does, q being the share there.
    Ranks go by value, highest first, then by item in UTF-8 order.

    NULL text, language and source are empty strings, so NULL and empty sources are one group. Each row is a
    document, repeated ones too. Groups without terms take part with the share of a count
    of 0; where no term is kept all pairs have the value 0. Other columns are not read, whatever their names;
    very long texts are one text; an empty table gives no rows. The pairs are the result, so they grow with the
    square of the sources of a language, but with nothing else.
    """
    counts = written(term_counts(docs, lang, source, text), "divergence-counts")
    vocabulary = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    vocabulary = vocabulary.where(F.col("docs") >= least).select("lang", "term", "n")
    vocabulary = written(vocabulary, "divergence-terms")

    # Per language: terms, occurrences, blocks. Per term: its block and its place there.
    groups = counts.where("term IS NULL").select("lang", "source")
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    totals = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    langs = langs.join(totals, "lang", "left").fillna(0, ["terms", "lang_total"])
    langs = langs.withColumn("source_blocks", F.ceil(F.col("sources") / F.lit(source_block)))
    langs = langs.withColumn("term_blocks", F.greatest(F.ceil(F.col("terms") / F.lit(term_block)), F.lit(1)))
    langs = written(langs, "divergence-langs")
    terms = vocabulary.join(langs.select("lang", "term_blocks"), "lang")
    terms = terms.withColumn("k", F.pmod(F.xxhash64("term"), F.col("term_blocks")))
    place = F.row_number().over(Window.partitionBy("lang", "k").orderBy("term")) - 1  # a block is bounded
    terms = written(terms.select("lang", "term", "k", place.alias("at"), F.col("n").alias("lang_n")), "divergence-blocks")

    kept = counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(terms, ["lang", "term"])
    kept = written(kept, "divergence-kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(sums, ["lang", "source"], "left").fillna(0, ["total"]).join(langs, "lang")
    groups = groups.withColumn("block", F.pmod(F.xxhash64("source"), F.col("source_blocks")))
    groups = written(groups.withColumn("base", share(F.lit(0), "total", "terms")), "divergence-groups")

    scored = kept.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    scored = scored.withColumn("p", share("n", "total", "terms"))

    # The cube: a slice is the shares of one source at the terms of one block.
    slices = scored.groupBy("lang", "source", "k").agg(F.collect_list(F.struct("at", "p")).alias("held"))
    widths = terms.groupBy("lang", "k").agg(F.count(F.lit(1)).alias("width"))
    whole = groups.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("term_blocks") - 1)))
    whole = whole.join(widths, ["lang", "k"], "left").join(slices, ["lang", "source", "k"], "left")
    whole = whole.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("source_blocks") - 1)))
    whole = whole.select(
        "lang",
        "source",
        "block",
        F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"),
        "k",
        F.coalesce("width", F.lit(0)).alias("width"),
        "base",
        F.transform("held", lambda x: x["at"]).alias("at"),
        F.transform("held", lambda x: x["p"]).alias("shares"),
    )
    cells = whole.groupBy("lang", "first", "second", "k")
    partial = cells.applyInArrow(_cell, "lang string, x string, y string, value bigint")
    summed = written(partial.groupBy("lang", "x", "y").agg(F.sum("value").alias("value")), "divergence-pairs")
    pairs = summed.select("lang", F.col("x").alias("source"), F.col("y").alias("item"), "value").union(
        summed.select("lang", F.col("y"), F.col("x"), "value")
    )

    q = share("lang_n", "lang_total", "terms")
    own = scored.withColumn("q", q).where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).union(own.withColumn("part", F.lit("term")).select(columns))
