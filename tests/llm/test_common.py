"""Slices of batches, and one evaluation of a text function whatever is filtered on its result."""

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlark.llm import common, quality


def test_slices_keep_every_text_in_order(monkeypatch):
    monkeypatch.setattr(common, "SLICE", 4)
    batches = [pa.array(["ab", None, "", "abcdefghij", "c", "ü"]), pa.array([], pa.string()), pa.array([None, None], pa.string())]
    got = list(common.slices(iter(batches)))
    assert [x for some in got for x in some] == [b"ab", b"", b"", b"abcdefghij", b"c", "ü".encode(), b"", b""]
    assert max(sum(map(len, some)) for some in got if len(some) > 1) <= 4


def test_filters_on_features_do_not_evaluate_them_twice(spark):
    docs = spark.createDataFrame([(1, "one two three " * 9), (2, None), (3, "")], "doc_id bigint, text string")
    found = common.with_struct(docs, quality.text_features(F.col("text")), quality.FEATURE_NAMES)
    kept = found.join(docs.select("doc_id"), "doc_id", "left_semi").where("n_words > 0").select("doc_id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert [r.doc_id for r in kept.collect()] == [1]
