"""The divergence audit against plain counts in exact integers."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import divergence, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, n string, value string"


def plain(rows, least=10, top=10):
    """rows: (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    held, counts = Counter(), {}
    for lang, source, text in rows:
        terms = [t.decode() for t in divergence.terms_of(text.encode())]
        counts.setdefault((lang, source), Counter()).update(terms)
        held.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in counts}:
        kept = sorted(t for (x, t), n in held.items() if x == lang and n >= least)
        groups = {s: c for (x, s), c in counts.items() if x == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = shares(sum(groups.values(), Counter()))
        by = {s: shares(c) for s, c in groups.items()}
        for s, p in by.items():
            apart = {o: sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept) for o, q in by.items() if o != s}
            own = {t: (p[t] - whole[t]) ** 2 // (p[t] + whole[t]) for t in kept if groups[s][t] and p[t] > whole[t]}
            for part, items, most in (("pair", apart, None), ("term", own, top)):
                ranked = sorted(items.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def ours(spark, rows, **options):
    df = spark.createDataFrame([(i, t, g, s, "x", "y", "z") for i, (g, s, t) in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, divergence.audit(df, **options).collect()))


def made_rows(seed, n, sources):
    rng = random.Random(seed)
    words = ["the", "The", "œuvre", "naïve", "café", "日本", "x9y", "don't", "a" * 50, *(f"w{chr(97 + i)}" for i in range(20))]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "fr", None]), f"s{int(rng.random() ** 3 * sources)}"
        few = rng.sample(words, 5)
        rows.append((lang, rng.choice([source, source, source, None]), rng.choice([" ", ", "]).join(rng.choices(few, k=rng.randint(0, 30)))))
    return rows


@pytest.mark.parametrize("blocks", [(32, 4096), (3, 4), (1, 1)])
def test_against_plain_counts(spark, blocks):
    rows = made_rows(1, 300, 12) + [("en", "empty", None), ("en", "blank", "1 2 3"), ("de", "alone", "wort"), ("", "", "the")]
    rows += [("en", "hot", "the cat sat. " * 40)] * 150 + [("en", "long", "the wa wb " * 100_000)]
    got = ours(spark, rows, least=10, source_block=blocks[0], term_block=blocks[1])
    assert got == plain(rows)
    assert any(r[1] == "empty" for r in got)


def test_ties_and_least(spark):
    rows = [("en", s, "b a") for s in ("y", "x", "x", "z")] + [("en", "w", "b")]
    assert ours(spark, rows, least=1) == plain(rows, least=1)
    assert ours(spark, rows, least=5) == plain(rows, least=5)
    assert {r[4] for r in ours(spark, rows, least=6)} == {0}  # no term is kept
    assert ours(spark, rows, least=1, top=1) == plain(rows, least=1, top=1)


def test_few_rows(spark):
    assert ours(spark, []) == []
    assert ours(spark, [("en", "a", "x")]) == []
    assert ours(spark, [(None, None, None), (None, "b", None)]) == plain([(None, None, None), (None, "b", None)])


def test_counters_are_handed_on(spark, monkeypatch):
    rows = made_rows(2, 60, 4)
    batches = spark.createDataFrame([(g or "", s or "", t or "") for g, s, t in rows], "a string, b string, c string").toArrow().to_batches(7)
    whole = Counter()
    for step in (3, 10**6):
        monkeypatch.setattr(divergence, "HELD", step)
        got = Counter()
        for b in divergence._counted(iter(batches)):
            for r in b.to_pylist():
                got[r["lang"], r["source"], r["term"], "n"] += r["n"]
                got[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        assert not whole or got == whole
        whole = got


def test_shares_are_exact_for_any_count(spark):
    counts = [(0, 0, 1), (0, 5, 10**12), (10**18, 2 * 10**18, 10**9), (4 * 10**18, 9 * 10**18, 3), (7, 10**18, 10**17), (0, 0, 0)]
    df = spark.createDataFrame(counts, "n bigint, total bigint, terms bigint").withColumn("p", divergence.share("n", "total", "terms"))
    for n, total, terms, p in df.collect():
        assert p == 1 + 10**9 * (n + 2) // max(1, total + 2 * terms) or (n, total, terms) == (0, 0, 0)
    p, q = np.array([10**9 + 1, 1, 10**9]), np.array([1, 10**9 + 1, 10**9])
    assert divergence.divergence(p, q).tolist() == [(int(a) - int(b)) ** 2 // (int(a) + int(b)) for a, b in zip(p, q, strict=True)]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, scale):
    folder = f"/root/testdata/{scale}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    df = queries.QUERIES["op12_divergence"](spark, folder)
    cursor = con.execute(queries.ORACLES["op12_divergence"])
    assert df.columns == [d[0] for d in cursor.description]
    got = sorted(map(tuple, df.collect()))
    assert got == sorted(cursor.fetchall())
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("lang", "source", "text")
    assert got == plain(map(tuple, docs.collect()))


def test_a_hot_source_travels_as_one_row_a_task(spark):
    df = spark.range(4000).select(F.lit("en").alias("lang"), F.lit("hot").alias("source"), F.lit("b a b").alias("text"))
    rows = {r.term: (r.n, r.docs) for r in divergence.term_counts(df).collect()}
    assert rows == {"a": (4000, 4000), "b": (8000, 4000), None: (0, 0)}
