"""Exact search against plain sums."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import queries, topk

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string, rank string"


def plain(rows, asked, k=20):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault((i, tuple(math.floor(64 * x) for x in v)))
    out = []
    for i, v in usable:
        if asked(i):
            scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in usable if j != i]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def ours(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0, **options).collect()))


@pytest.mark.parametrize("blocks", [(4096, 4096), (3, 7)])
def test_against_plain_sums(spark, blocks):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 0.01, -0.3, rng.uniform(-2, 2)]) for _ in range(9)]) for i in range(150)]
    rows += [(i + 500, rows[4][1]) for i in range(60)]  # ties
    rows += [rows[20], rows[20], (21, None), (22, [1.0, None]), (23, [float("nan")]), (24, [float("inf"), 1.0])]
    rows += [(None, [1.0]), (40, [0.5]), (1000, []), (1020, [0.0] * 9), (1021, [3.0] * 12), (-20, [0.25] * 9)]
    got = ours(spark, rows, query_block=blocks[0], candidate_block=blocks[1])
    assert got == plain(rows, lambda i: i % 20 == 0)


def test_few_rows(spark):
    assert ours(spark, []) == []
    assert ours(spark, [(0, [1.0])]) == []
    assert ours(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert ours(spark, [(0, [1.0]), (20, [-1.0])]) == [(0, 1, 20, -4096), (20, 1, 0, -4096)]


def test_sums_of_any_size(spark):
    rows = [(0, [1e4] * 4), (1, [2e6] * 4), (2, [-3e6, 1e6, 0.0, 1.0]), (3, [9e12] * 4)]
    held = [(q, n, i, min(s, 2**63 - 1)) for q, n, i, s in plain(rows, lambda i: i == 0)]
    assert ours(spark, rows) == held
    near = [(0, [1e7] * 3)] + [(i, [1e7, 1e7, 1e7 + i / 64]) for i in range(1, 30)]
    assert ours(spark, near) == plain(near, lambda i: i % 20 == 0)
    top = ours(spark, [(0, [1e16]), (1, [1e16])])
    assert top == [(0, 1, 1, 2**63 - 1)]


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    df = queries.QUERIES["op6_topk"](spark, "/root/testdata/sf0.001")
    cursor = con.execute(queries.ORACLES["op6_topk"])
    assert df.columns == [d[0] for d in cursor.description]
    assert sorted(map(tuple, df.collect())) == sorted(cursor.fetchall())
