"""Stored history: closed versions stay where they are, unchanged runs write nothing."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import history as hist
from ledgerlark.operators.history_store import HistoryTable, Run
from ledgerlark.session import scratch_path

SCHEMA = "id bigint, part string, v int"


def at(day):
    return (datetime(2026, 1, 1) + timedelta(days=day)).strftime("%Y-%m-%d %H:%M:%S")


@pytest.fixture
def table(spark):
    return HistoryTable(spark, scratch_path(spark, "history"), spark.createDataFrame([], SCHEMA).schema, ["id", "part"], buckets=6)


def files(table):
    return {str(p): p.stat().st_mtime_ns for p in Path(table.log.path).rglob("*.parquet")}


def test_runs_agree_with_the_history_made_in_one_plan(spark, table, rows):
    rng = random.Random(1)
    incoming, expected = {(i, "a"): 0 for i in range(30)} | {(None, "a"): 1, (5, None): 2}, None
    for day in range(5):
        frame = spark.createDataFrame([(*k, v) for k, v in incoming.items()], SCHEMA)
        closed_before = {p for p in files(table) if "/closed-" in p}
        kept = {p: t for p, t in files(table).items()}
        run = table.snapshot_by_check(frame, ["v"], at(day))
        expected = hist.snapshot_by_check(expected, frame, ["id", "part"], ["v"], F.lit(at(day)).cast("timestamp"))
        assert rows(table.read()) == rows(expected)
        assert rows(table.open_versions()) == rows(expected.where("valid_to IS NULL"))
        assert run.opened == expected.where(F.col("valid_from") == at(day)).count()
        assert closed_before <= set(files(table)) and all(files(table)[p] == t for p, t in kept.items())
        for key in rng.sample(sorted(incoming, key=repr), 3):
            incoming[key] = rng.choice([0, 1, None])
        del incoming[rng.choice(sorted(incoming, key=repr))]
        incoming[rng.randrange(30), "a"] = day


def test_an_unchanged_run_writes_nothing(spark, table, rows):
    frame = spark.createDataFrame([(1, "a", 1), (2, "a", None), (None, "a", 3)], SCHEMA)
    assert table.snapshot_by_check(frame, ["v"], at(0)).opened == 3
    before, version = files(table), table.log.versions()
    assert table.snapshot_by_check(frame, ["v"], at(1)) == Run()
    assert files(table) == before and table.log.versions() == version
    assert table.snapshot_by_check(spark.createDataFrame([], SCHEMA), ["v"], at(2), close_missing=False) == Run()
    assert table.snapshot_by_check(spark.createDataFrame([], SCHEMA), ["v"], at(3)).closed == 3
    assert rows(table.open_versions()) == [] and table.read().count() == 3


def test_only_touched_buckets_are_written_anew(spark, table):
    many = spark.range(200).select("id", F.lit("a").alias("part"), F.lit(0).alias("v"))
    assert table.snapshot_by_check(many, ["v"], at(0)) == Run(200, 0, 6)
    before = files(table)
    one = many.withColumn("v", F.when(F.col("id") == 7, 1).otherwise(0))
    assert table.snapshot_by_check(one, ["v"], at(1)) == Run(1, 1, 1)
    new = set(files(table)) - set(before)
    assert len({Path(p).parent.name for p in new if "/open-" in p}) == 1
    assert sum(spark.read.parquet(p).count() for p in new if "/closed-" in p) == 1
    assert table.read().count() == 201 and table.read(version=0).count() == 200
    table.expire()
    assert table.read().count() == 201


def test_a_run_that_died_or_is_repeated(spark, table, rows, monkeypatch):
    first = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    second = spark.createDataFrame([(1, "a", 2)], SCHEMA)
    table.snapshot_by_check(first, ["v"], at(0))
    expected = rows(table.read())
    with monkeypatch.context() as broken:
        broken.setattr(table.log, "commit", lambda change: (_ for _ in ()).throw(OSError("died before the commit")))
        with pytest.raises(OSError):
            table.snapshot_by_check(second, ["v"], at(1))
    assert rows(table.read()) == expected
    assert table.snapshot_by_check(second, ["v"], at(1)).closed == 1
    again = rows(table.read())
    assert table.snapshot_by_check(second, ["v"], at(1)) == Run() and rows(table.read()) == again
    table.expire(keep=2)
    assert rows(table.read(version=0)) == expected and rows(table.read()) == again


def test_by_timestamp(spark, rows):
    schema = "id bigint, v int, loaded timestamp"
    table = HistoryTable(spark, scratch_path(spark, "history"), spark.createDataFrame([], schema).schema, ["id"], buckets=3)
    expected = None
    for day, data in enumerate([[(1, 1, 0), (2, 1, 0)], [(1, 9, 0), (2, 2, 1)], [(2, 2, 1), (3, 1, 2)]]):
        frame = spark.createDataFrame([(i, v, datetime(2026, 1, 1 + t)) for i, v, t in data], schema)
        table.snapshot_by_timestamp(frame, "loaded", at(day + 5))
        expected = hist.snapshot_by_timestamp(expected, frame, ["id"], "loaded", F.lit(at(day + 5)).cast("timestamp"))
        assert rows(table.read()) == rows(expected)
