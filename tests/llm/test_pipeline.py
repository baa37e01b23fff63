"""The corpus pipeline: each stage's decisions against brute force on a small corpus, and odd tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlark.llm import queries
from ledgerlark.session import scratch_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus(rng):
    words = [f"word{i}" for i in range(3000)]
    rows = []
    for i in range(120):
        base = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        rows.append(" ".join(base))
        if i % 6 == 0:
            rows.append(" ".join([*base, "tail"]).upper())
        if i % 9 == 0:
            rows.append(" ".join(base))
    rows += ["token = abcdef123456 " + " ".join(rng.sample(words, 30)), "too short", "", None, "same line\n" * 30]
    rows += [" ".join(rng.sample(words, 3000))]
    return [(100 + i, t, rng.choice(["en", "de", None]), rng.choice(["big", "big", "small", None]), len(t or "")) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(11)
    where = scratch_path(spark, "corpus")
    rows = corpus(rng)
    spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", kept int").write.parquet(f"{where}/documents.parquet")
    labels = [(r[0], int(len(r[1] or "") > 50), 0) for r in rows]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where


def stages(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", text.lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_every_stage(spark, folder):
    raw = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = stages(spark, folder)
    assert list(out) == ["quality_rules", "near_duplicates", "secret_scan", "mix_sources", "encode"]
    for name in list(out)[:-1]:
        assert out[name].columns == corpus_pipeline.COLUMNS

    def failed(text):
        words = (text or "").split()
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
        return len(words) < 10 or 100 * len(covered) > 20 * len(words)

    good = {r.doc_id: r.text for r in out["quality_rules"].collect()}
    # Too few labelled documents for any cutoff, so only the base limits reject.
    assert set(good) == {i for i, r in raw.items() if not failed(r.text)}

    ids = sorted(good)
    sets = {i: shingles(good[i]) for i in ids}
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[:x]:
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    kept = {r.doc_id: r for r in out["near_duplicates"].collect()}
    assert set(kept) == {i for i in ids if root(i) == i} and len(kept) < len(ids)

    clean = {r.doc_id: r for r in out["secret_scan"].collect()}
    assert set(clean) == set(kept)
    for i, r in clean.items():
        assert r.n_chars == len(r.text)
        assert r.text == re.sub(r"token = [a-z0-9]+", "[SECRET]", kept[i].text)
    assert sum("[SECRET]" in r.text for r in clean.values()) == 1

    mixed = out["mix_sources"].collect()
    assert {r.doc_id for r in mixed} <= set(clean)
    assert all(tuple(r) == tuple(clean[r.doc_id]) for r in mixed)

    library = Tokenizer.from_file(queries.tokenizer_path())
    ids_of = out["encode"].collect()
    assert sorted(r.doc_id for r in ids_of) == sorted(r.doc_id for r in mixed)
    for r in ids_of:
        assert list(r.ids) == library.encode(clean[r.doc_id].text, add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) and r.source == clean[r.doc_id].source


def test_run_gives_the_last_stage(spark, folder):
    got = sorted((r.doc_id, tuple(r.ids)) for r in queries.QUERIES["pipeline"](spark, folder).collect())
    last = stages(spark, folder)["encode"]
    assert got == sorted((r.doc_id, tuple(r.ids)) for r in last.collect())
    assert np.mean([len(i) for _, i in got]) > 10


def test_empty_and_odd_tables(spark):
    where = scratch_path(spark, "corpus")
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text, None, None, None), (None, None, "en", "s", 1), (3, text, "en", "s", 1), (3, text, "en", "s", 1)]
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(rows, SCHEMA).withColumn("ids", F.lit("x")).write.parquet(f"{where}/documents.parquet")
    assert set(stages(spark, where)) == {name for name, _ in corpus_pipeline.STAGES}
    empty = scratch_path(spark, "corpus")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_one_row_of_each_repeat_stays(spark):
    """Repeated rows of an id, rows without an id, an id with two texts, NULL and empty texts."""
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(3, a), (3, a), (3, b), (None, a), (None, a), (None, a), (None, b), (None, None), (None, None), (None, ""), (4, None), (4, None), (9, a)]
    docs = spark.createDataFrame([(i, t, "en", f"s{n}", 1) for n, (i, t) in enumerate(rows)], SCHEMA)
    out = corpus_pipeline.near_duplicates(spark, docs, "unused")
    assert out.columns == corpus_pipeline.COLUMNS
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted({r for r in rows if r[0] != 9}, key=repr)
