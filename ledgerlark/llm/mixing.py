"""Mixing sources to target weights by Poisson replication.

Each document is repeated a Poisson-distributed number of times whose mean is the
repetition rate of its source. The number comes from inverting the distribution at a
uniform value hashed from the seed and the document's id, so it does not depend on
partitions, retries or other documents, and a changed rate changes few documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import written

HASH_DIGITS = 13  # 52 bits, exact in a double
#: Copies that a task makes of one document at a time, and tables that a Python worker keeps.
BLOCK = 1024
KEPT_TABLES = 64


def uniform(seed: str, *parts: Column) -> Column:
    """A value in [0, 1) from the seed and the parts; NULL hashes like an empty string."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double") / F.lit(float(16**HASH_DIGITS))


def repetition_rates(
    docs: DataFrame, source: str, size: Column, weights: Mapping[str | None, float] | None, epochs: float
) -> DataFrame:
    """Per source: ``source``, ``size`` and ``rate``, the mean number of copies of its documents.

    The mixture has ``epochs`` times the size of the corpus. Without ``weights`` all sources
    get the same share; with them, a source that is not named gets none, and shares are
    relative to the sources that are present and have any text.
    """
    sums = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("bigint").alias("size"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            if value < 0:
                raise ValueError("weights must not be negative")
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    sums = written(sums.where("size > 0").withColumn("weight", weight), "mix-sizes")
    totals = sums.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    if not totals["weight"]:  # no text, or no weight on any source that is present
        return sums.select("source", "size", F.lit(0.0).alias("rate"))
    rate = F.col("weight") / F.lit(totals["weight"]) * F.lit(float(epochs)) * F.lit(totals["size"]) / F.col("size")
    return sums.select("source", "size", rate.alias("rate"))


def distribution(rate: float) -> tuple[int, np.ndarray]:
    """The first number and the distribution function from there on, as far as doubles tell it from 0 and 1.

    Terms are taken relative to the one at the mode, up and down from it in logarithms, and divided by their sum, so
    large rates neither underflow nor lose digits. The table is some times the square root of the rate long.
    """
    mode, reach = math.floor(rate), math.ceil(12 * math.sqrt(rate) + 40)
    first = max(0, mode - reach)
    up = np.cumsum(math.log(rate) - np.log(np.arange(mode + 1, mode + reach + 1, dtype=float)))
    down = np.cumsum(np.log(np.arange(mode, first, -1, dtype=float)) - math.log(rate))
    upto = np.cumsum(np.exp(np.concatenate([down[::-1], [0.0], up])))
    return first, upto / upto[-1]


_tables: dict[float, tuple[int, np.ndarray]] = {}


def _copies(values: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """For each uniform value and rate the number whose share of the distribution holds the value."""
    for u, rate in values:
        u, rate = u.to_numpy(zero_copy_only=False), rate.to_numpy(zero_copy_only=False)
        out = np.zeros(len(u), np.int64)
        for r in np.unique(rate):
            if r > 0:
                if r not in _tables:
                    if len(_tables) >= KEPT_TABLES:
                        _tables.clear()
                    _tables[r] = distribution(float(r))
                first, upto = _tables[r]
                here = rate == r
                out[here] = first + np.searchsorted(upto, u[here], side="right")
        yield pa.array(out)


_copies.__annotations__ = {"values": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    epochs: float = 1.0,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: str = "mix-1",
) -> DataFrame:
    """The mixture: ``docs`` repeated, with ``copy`` (from 1) and ``shuffle_key``, in global random order.

    Sizes are code points of the text. A NULL source is a source of its own; NULL and
    empty texts have no size but are repeated at their source's rate, and a source
    without any text is left out, so an empty table gives no rows; the size of very long texts is counted whole. Rows of
    equal key get equal numbers of copies, and the copies of one document are made in blocks by several
    tasks where rates are high. Columns
    called ``copy`` or ``shuffle_key`` are replaced. The partitions are dealt by the hash
    of document and copy and sorted by it within, so reading them in turn reads the
    documents in random order and no source or group of copies meets in one task.
    """
    docs = docs.drop("copy", "shuffle_key")
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    # Written, so that its size is known: the planner sends it along only while it is small.
    rates = written(repetition_rates(docs, source, size, weights, epochs), "mix-rates")
    highest = rates.agg(F.max("rate")).first()[0] or 0.0
    table = rates.select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    drawn = docs.withColumn("__u", uniform(seed, F.col(key)))
    drawn = drawn.join(table, F.col(source).eqNullSafe(F.col("__source")))
    copies = F.arrow_udf(_copies, "bigint").asNondeterministic()  # else it is copied into the filter and run twice
    drawn = drawn.withColumn("__n", copies("__u", "__rate")).where("__n > 0").drop("__u", "__rate", "__source")
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__n") - 1) / F.lit(BLOCK)).cast("bigint")))
    drawn = drawn.withColumn("__block", block)
    if highest > BLOCK:  # many copies of one document are made by many tasks
        drawn = drawn.repartition(F.xxhash64(F.col(key), "__block"))
    begin = F.col("__block") * F.lit(BLOCK)
    ends = F.least(F.col("__n"), begin + F.lit(BLOCK))
    out = drawn.withColumn("copy", F.explode(F.sequence(begin + F.lit(1).cast("bigint"), ends))).drop("__n", "__block")
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (F.col(key), F.col("copy"))]
    out = out.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), *parts)))
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
