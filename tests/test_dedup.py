from datetime import datetime

from pyspark.sql import functions as F

from ledgerlark.operators import dedup

SCHEMA = "id string, amount double, note string, _FIVETRAN_synced timestamp"
T1, T2 = datetime(2026, 1, 1), datetime(2026, 1, 2)


def test_identical_copies_collapse_to_the_latest_load(frame, rows):
    df = frame([("p1", 10.0, None, T1), ("p1", 10.0, None, T2), ("p2", 5.0, "x", T1)], SCHEMA)
    assert rows(dedup.dedup_source(df, ["id"])) == [("p1", 10.0, None, T2), ("p2", 5.0, "x", T1)]
    assert rows(dedup.duplicate_keys(df, ["id"])) == [("p1", 2)]
    assert rows(dedup.conflicting_rows(df, ["id"])) == []


def test_conflicting_copies_are_held_back(frame, rows):
    df = frame([("p1", 10.0, "a", T1), ("p1", 999.99, "a", T2), ("p2", 5.0, None, T1), ("p2", 5.0, "b", T1)], SCHEMA)
    assert rows(dedup.dedup_source(df, ["id"])) == []
    assert len(rows(dedup.conflicting_rows(df, ["id"]))) == 4


def test_null_keys_pass_through(frame, rows):
    df = frame([(None, 1.0, "a", T1), (None, 1.0, "a", T1), ("p", 2.0, "b", T1)], SCHEMA)
    assert len(rows(dedup.dedup_source(df, ["id"]))) == 3
    composite = frame([("a", None, 1), ("a", None, 1), ("a", "b", 1)], "k1 string, k2 string, v int")
    assert len(rows(dedup.dedup_source(composite, ["k1", "k2"]))) == 3


def test_nan_equals_nan(frame, rows):
    df = frame([("p", float("nan"), "a", T1), ("p", float("nan"), "a", T2)], SCHEMA)
    assert len(rows(dedup.dedup_source(df, ["id"]))) == 1


def test_table_of_keys_only(frame, rows):
    assert rows(dedup.dedup_source(frame([("a",), ("a",), ("b",)], "id string"), ["id"])) == [("a",), ("b",)]


def test_matches_the_two_step_definition_on_mixed_rows(spark, rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 400).alias("k"),
        (F.col("id") % 800).alias("v"),
        (F.col("id") % 7).alias("_fivetran_synced"),
    )
    versions = df.groupBy("k").agg(F.count_distinct("v").alias("n"))
    expected = (
        df.join(versions.where("n = 1"), "k", "left_semi").groupBy("k", "v").agg(F.max("_fivetran_synced"))
    )
    assert rows(dedup.dedup_source(df, ["k"])) == rows(expected)
    assert dedup.conflicting_rows(df, ["k"]).count() == df.join(versions.where("n > 1"), "k", "left_semi").count()


def test_every_row_is_shuffled_once(spark, executed, rows):
    df = spark.range(1000).select((F.col("id") % 10).alias("id"), F.lit(1).alias("v"), F.lit(2).alias("_fivetran_synced"))
    assert executed(dedup.dedup_source(df, ["id"])).count("Exchange hashpartitioning") == 1
    nulls = df.unionByName(df.limit(3).withColumn("id", F.lit(None).cast("bigint")))
    assert rows(dedup.dedup_source(nulls, ["id"])) == [(i, 1, 2) for i in range(10)] + [(None, 1, 2)] * 3


def test_latest_per_key(frame, rows):
    df = frame([("a", 1, "old"), ("a", 2, "new"), ("b", None, "only")], "k string, t int, v string")
    assert rows(dedup.latest_per_key(df, ["k"], [F.col("t")])) == [("a", 2, "new"), ("b", None, "only")]


def test_duplicate_key_rows(frame, rows):
    df = frame([("p1", 10), ("p2", 20), ("p2", 99), ("p3", 1)], "id string, amount int")
    assert rows(dedup.duplicate_key_rows(df, ["id"])) == [("p2", 20), ("p2", 99)]


def test_quarantine_report(frame, rows):
    clean = frame([("a", 1), ("a", 1), ("b", 1)], "id string, v int")
    bad = frame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)], "id string, v int")
    report = dedup.quarantine_report({"clean": (clean, ["id"]), "bad": (bad, ["id"])})
    assert rows(report) == [("bad", 1, 1, 2), ("clean", 1, 0, 0)]
