"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Queries and candidates are dealt into blocks of bounded size, and every query block meets
every candidate block in one cell. There the candidates become postings, one list of
(row, weight) per term; each query adds its weight times a term's postings into a dense
array of scores, term after term; a partition selection takes the best of the cell, and
the cells' selections are merged. Nothing is approximated, skipped or broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import written

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 4096
PANEL = 32  # queries whose score arrays are held at once
DENSE = 0.2  # share of the rows from which a term's postings, or a panel's weights, are spread out whole
HITS = "query_id bigint, query_hash bigint, vec_id bigint, score bigint"
ARROW_HITS = pa.schema([(n, pa.int64()) for n in ("query_id", "query_hash", "vec_id", "score")])


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component; NULL where the vector or a component is NULL or not finite."""

    def odd(x):
        y = x.cast("double")
        return y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))

    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return F.when(vector.isNotNull() & ~F.exists(vector, odd), whole)


def flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of all entries that are not zero."""
    lists = lists.combine_chunks()
    sizes = np.array(lists.value_lengths().to_pylist(), np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    terms = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    used = values != 0
    return rows[used], terms[used], values[used]


def by_term(rows: np.ndarray, terms: np.ndarray, values: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    order = np.argsort(terms, kind="stable")
    names, starts = np.unique(terms[order], return_index=True)
    ends = [*starts[1:], len(order)]
    return {int(t): (rows[order[a:b]], values[order[a:b]]) for t, a, b in zip(names, starts, ends, strict=True)}


def score_bound(queries: dict, postings: dict) -> int:
    """What no score and no partial sum exceeds."""
    return sum(
        max(abs(int(v)) for v in (w.min(), w.max())) * max(abs(int(v)) for v in (x.min(), x.max()))
        for t, (_, w) in queries.items()
        if t in postings
        for x in [postings[t][1]]
    )


def narrowest(bound: int) -> type:
    """The smallest integers that hold values up to ``bound``; Python's beyond 62 bits."""
    return next((kind for kind, bits in ((np.int16, 15), (np.int32, 31), (np.int64, 62)) if bound < 1 << bits), object)


def spread_out(rows: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Weights in a dense array, 0 elsewhere."""
    out = np.zeros(n, weights.dtype)
    out[rows] = weights
    return out


def best_of_cell(cell: pa.Table, k: int) -> pa.Table:
    """The k best candidates of each query of a cell."""
    cell = cell.sort_by("vec_id")  # a smaller row number is a smaller id
    asked = cell.filter(cell["is_query"])
    cand = cell.filter(pa.compute.invert(cell["is_query"]))
    if not len(asked) or not len(cand):
        return ARROW_HITS.empty_table()
    queries, postings = by_term(*flat(asked["q"])), by_term(*flat(cand["q"]))
    bound = score_bound(queries, postings)
    kind = narrowest(bound)
    query_ids, ids = asked["vec_id"].to_numpy(), cand["vec_id"].to_numpy()
    n, out = len(ids), []
    postings = {t: (rows, weights.astype(kind)) for t, (rows, weights) in postings.items()}
    spread = {t: spread_out(rows, weights, n) for t, (rows, weights) in postings.items() if len(rows) >= DENSE * n}
    # A score and a place in one number, which the narrowest type that holds it makes quick to select.
    wide = narrowest((bound + 1) * n)
    places = np.arange(n - 1, -1, -1).astype(wide)
    own_from, own_to = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    for first in range(0, len(asked), PANEL):
        size = min(PANEL, len(asked) - first)
        scores = np.zeros((size, n), kind)
        product = np.empty((size, n), kind)
        for term, (holders, weights) in queries.items():
            if term not in postings:
                continue
            a, b = np.searchsorted(holders, [first, first + size])
            if a == b:
                continue
            rows, posted = postings[term]
            held, weight = holders[a:b] - first, weights[a:b].astype(kind)[:, None]
            if term in spread and len(held) >= DENSE * size:
                np.multiply(spread_out(held, weight[:, 0], size)[:, None], spread[term][None, :], out=product)
                scores += product
            elif term in spread:
                scores[held] += weight * spread[term][None, :]
            else:
                scores[np.ix_(held, rows)] += weight * posted[None, :]
        ranked = scores.astype(wide) * (n if wide is object else wide(n)) + places
        own = np.zeros((size, n), bool)
        for i, (a, b) in enumerate(zip(own_from[first : first + size], own_to[first : first + size], strict=True)):
            own[i, a:b] = True
            ranked[i, a:b] = np.iinfo(wide).min if wide is not object else -(1 << 200)
        take = min(k, n)
        top = np.argpartition(ranked, n - take, axis=1)[:, n - take :] if take < n else np.tile(np.arange(n), (size, 1))
        row = np.repeat(np.arange(size), top.shape[1])
        col = top.reshape(-1)
        real = ~own[row, col]
        row, col = row[real], col[real]
        score = scores[row, col]
        if kind is object:
            score = np.array([max(-(2**63), min(2**63 - 1, int(s))) for s in score])
        hashes = asked["query_hash"].to_numpy()[first : first + size]
        out.append(
            pa.table(
                [query_ids[first : first + size][row], hashes[row], ids[col], score.astype(np.int64)], schema=ARROW_HITS
            )
        )
    return pa.concat_tables(out)


def top_k(
    vectors: DataFrame,
    asked: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    scale: int = 64,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best other rows of each query.

    ``asked`` says which rows are queries. Ties go to the smaller id. Rows with a NULL key
    and vectors that are NULL or hold NULL or non-finite components take no part; an empty
    vector scores 0. Vectors of different lengths agree on the terms that both have. Rows
    that repeat id and vector count once; an id with several vectors is a candidate with
    each of them, and asks with each. Sums beyond 64 bits are held at the largest value.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), quantised(F.col(vector), scale).alias("q"), asked.alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("q").isNotNull()).dropDuplicates(["vec_id", "q"])
    rows = written(rows.withColumn("query_hash", F.xxhash64("vec_id", "q")), "topk-rows")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("m")).first()
    n_cand, n_query = (max(1, -(-a // b)) for a, b in ((sizes["n"], candidate_block), (sizes["m"], query_block)))
    spread = F.xxhash64("query_hash", F.lit(1))
    queries = rows.where("is_query").select(
        F.pmod(spread, F.lit(n_query)).alias("qb"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_cand - 1).cast("bigint"))).alias("cb"),
        F.lit(True).alias("is_query"),
        "vec_id",
        "query_hash",
        "q",
    )
    cands = rows.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_query - 1).cast("bigint"))).alias("qb"),
        F.pmod(spread, F.lit(n_cand)).alias("cb"),
        F.lit(False).alias("is_query"),
        "vec_id",
        "query_hash",
        "q",
    )
    hits = queries.unionByName(cands).groupBy("qb", "cb").applyInArrow(lambda cell: best_of_cell(cell, k), HITS)
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
