"""Poisson replication: shares, determinism and odd rows."""

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ledgerlark.llm import mixing, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, source string, copy string, shuffle_key string, cdf string, rate string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


def drawn(seed, key, rate):
    """Plain inversion."""
    u = int(hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52
    n, upto = 0, math.exp(-rate)
    while upto <= u and n < rate + 12 * math.sqrt(rate) + 40:
        n += 1
        upto += math.exp(n * math.log(rate) - rate - math.lgamma(n + 1))
    return n


def plain(rows, weights, epochs, seed="mix-1"):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text or "")
    sizes = {s: n for s, n in sizes.items() if n}
    shares = {s: 1.0 if weights is None else weights.get(s, 0.0) for s in sizes}
    total = sum(shares.values())
    out = Counter()
    for key, text, source in rows:
        rate = shares[source] / total * epochs * sum(sizes.values()) / sizes[source] if source in sizes and total else 0
        for copy in range(drawn(seed, key, rate) if rate else 0):
            out[key, text, source, copy + 1] += 1
    return out


ROWS = [(i, "word " * (1 + i % 7), "big") for i in range(400)] + [(1000 + i, "é" * 30, "small") for i in range(60)]
ODD = [(5000, None, "none"), (5001, "", "none"), (5002, "text", None), (None, "text", "small"), (5003, None, "small"),
       (1000, "é" * 30, "small"), (1000, "é" * 30, "small"), (5004, "x" * 200_000, "long")]


@pytest.mark.parametrize(
    ("weights", "epochs"), [(None, 1.0), ({"big": 1, "small": 3}, 2.0), ({"small": 1, None: 2}, 40.0), ({"absent": 1}, 1.0), ({}, 1.0)]
)
def test_against_plain_inversion(spark, weights, epochs):
    rows = ROWS + ODD
    out = mixing.mix(frame(spark, rows), weights, epochs).collect()
    assert Counter((r.doc_id, r.text, r.source, r.copy) for r in out) == plain(rows, weights, epochs)
    for r in out:
        name = "" if r.doc_id is None else r.doc_id
        assert r.shuffle_key == hashlib.md5(f"mix-1:order:{name}:{r.copy}".encode()).hexdigest()
        assert (r.cdf, r.rate) == ("c", "d")


def test_shares_are_met(spark):
    rows = [(i, "x" * 100, "a" if i % 10 else "b") for i in range(20_000)]
    out = Counter(r.source for r in mixing.mix(frame(spark, rows), {"a": 1, "b": 1}).select("source").collect())
    assert abs(out["a"] / 10_000 - 1) < 0.05 and abs(out["b"] / 10_000 - 1) < 0.05


def test_large_rates_do_not_underflow(spark):
    rows = [(1, "x", "rare"), (2, "x" * 2999, "rest")]
    n = mixing.mix(frame(spark, rows), {"rare": 1}).count()
    assert abs(n - 3000) < 6 * math.sqrt(3000)


@pytest.mark.parametrize("rate", [1e-12, 0.3, 1.0, 7.25, 49.0, 700.0])
def test_distribution(rate):
    first, upto = mixing.distribution(rate)
    plain, total = [], 0.0
    for k in range(first + len(upto)):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        plain.append(total)
    assert np.abs(np.array(plain[first:]) - upto).max() < 1e-11 and (first == 0 or plain[first - 1] < 1e-20)


def test_rates_of_a_billion():
    """The table goes with the square root of the rate, and its middle and spread are those of the distribution."""
    rate = 1e9
    first, upto = mixing.distribution(rate)
    assert len(upto) < 10**6
    for sigmas in (-2.0, -1.0, 0.0, 1.0, 2.0):
        at = int(rate + sigmas * math.sqrt(rate)) - first
        assert abs(upto[at] - 0.5 * (1 + math.erf(sigmas / math.sqrt(2)))) < 1e-4
    (got,) = mixing._copies(iter([(pa.array([0.0, 0.5, 1 - 2**-52, 0.25]), pa.array([rate, rate, rate, 0.0]))]))
    low, middle, high, none = got.to_pylist()
    assert rate - 12.1 * math.sqrt(rate) - 41 <= low < middle < high <= rate + 12.1 * math.sqrt(rate) + 41 and none == 0
    assert abs(middle - rate) < 2


def test_many_copies_are_made_in_blocks_by_many_tasks(spark):
    rows = [(1, "x", "rare"), (2, "x" * 199_999, "rest")]
    out = mixing.mix(frame(spark, rows), {"rare": 1})
    first, upto = mixing.distribution(200_000.0)
    u = int(hashlib.md5(b"mix-1:1").hexdigest()[:13], 16) / 2**52
    copies = sorted(r.copy for r in out.select("copy").collect())
    assert copies == list(range(1, first + int(np.searchsorted(upto, u, side="right")) + 1))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION") == 2  # blocks, then the global order
    assert mixing.mix(frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString().count("REPARTITION") == 1


def test_order_is_global_and_does_not_depend_on_partitions(spark):
    one = mixing.mix(frame(spark, ROWS).coalesce(1)).select("doc_id", "copy", "shuffle_key").collect()
    many = mixing.mix(frame(spark, ROWS).repartition(9)).select("doc_id", "copy", "shuffle_key").collect()
    assert sorted(one) == sorted(many)
    assert len({r.shuffle_key for r in one}) == len(one)


def test_empty_table(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    assert mixing.mix(frame(spark, [(1, None, "a"), (2, "", None)])).collect() == []


def test_negative_weights_are_refused(spark):
    with pytest.raises(ValueError):
        mixing.mix(frame(spark, ROWS), {"big": -1})


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    df = queries.QUERIES["op9_mix"](spark, FOLDER)
    cursor = con.execute(queries.ORACLES["op9_mix"])
    names = [d[0] for d in cursor.description]
    assert sorted(map(repr, map(tuple, df.select(names).collect()))) == sorted(map(repr, cursor.fetchall()))
