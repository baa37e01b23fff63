"""The keyed table: merging, retries, open buckets, compaction."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.keyed import KeyedTable
from ledgerlark.session import scratch_path

SCHEMA = "id bigint, part string, v string, t int"
NEWEST = ["t"]


@pytest.fixture
def table(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    return KeyedTable(spark, scratch_path(spark, "keyed"), schema, ["id", "part"], buckets=8)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def files(table):
    return {p.relative_to(table.log.path): p.stat().st_mtime_ns for p in Path(table.log.path).rglob("*.parquet")}


def test_batches_replace_and_add(spark, table, rows):
    assert rows(table.read()) == [] and table.compact() == set()
    table.write_batch(batch(spark, (1, "a", "x", 1), (1, "b", "x", 1), (2, "a", "old", 1), (2, "a", "new", 2)), 0, NEWEST)
    assert rows(table.read(), "id", "part", "v") == [(1, "a", "x"), (1, "b", "x"), (2, "a", "new")]
    table.write_batch(batch(spark, (2, "a", "corrected", 0), (3, "a", "x", 1)), 1, NEWEST)
    assert rows(table.read(), "id", "part", "v") == [(1, "a", "x"), (1, "b", "x"), (2, "a", "corrected"), (3, "a", "x")]
    assert rows(table.read(version=0), "id", "v") == [(1, "x"), (1, "x"), (2, "new")]
    table.write_batch(batch(spark), 2, NEWEST)  # an empty one
    assert len(rows(table.read())) == 4


def test_a_retried_batch_changes_nothing(spark, table, rows, monkeypatch):
    first, second = batch(spark, (1, "a", "x", 1), (None, "a", "n", 1)), batch(spark, (1, "a", "y", 2))
    with monkeypatch.context() as broken:
        broken.setattr(table.log, "commit", lambda change: (_ for _ in ()).throw(OSError("died before the commit")))
        with pytest.raises(OSError):
            table.write_batch(first, 0, NEWEST)
    assert rows(table.read()) == [] and files(table)  # its files are there, and nobody reads them
    assert table.write_batch(first, 0, NEWEST) is True
    assert table.write_batch(second, 1, NEWEST) is True
    before = files(table)
    assert table.write_batch(first, 0, NEWEST) is False  # the retry of a batch whose answer was lost
    assert files(table) == before
    assert rows(table.read(), "id", "v") == [(1, "y"), (None, "n")]
    assert len(table.expire()) == 1  # what the first try left
    assert rows(table.read(), "id", "v") == [(1, "y"), (None, "n")]


def test_another_writer_in_between(spark, table, rows):
    """A commit that finds its number taken is made again on top of the other one's."""
    other = KeyedTable(spark, table.log.path, table.schema, table.keys)
    real = table.log.state
    raced = []

    def state(version=None):
        found = real(version)
        if not raced:
            raced.append(True)
            other.write_batch(batch(spark, (1, "a", "theirs", 1), (2, "a", "theirs", 1)), "theirs", NEWEST)
        return found

    table.log.commit(lambda s: None)
    table.log.state = state
    table.write_batch(batch(spark, (1, "a", "ours", 1)), "ours", NEWEST)
    assert rows(table.read(), "id", "v") == [(1, "ours"), (2, "theirs")]


def test_rows_without_a_whole_key_are_kept_once_per_batch(spark, table, rows):
    keyless = batch(spark, (None, "a", "n", 1), (1, None, "m", 1), (1, None, "m", 1))
    for i in (0, 0, 1):
        table.write_batch(keyless, i, NEWEST)
    table.compact()
    assert rows(table.read(), "v") == [("m",)] * 4 + [("n",)] * 2


def test_only_open_buckets_are_merged_and_rewritten(spark, table, rows, executed):
    many = spark.range(400).select(F.col("id"), F.lit("a").alias("part"), F.lit("x").alias("v"), F.lit(1).alias("t"))
    table.write_batch(many, 0, NEWEST)
    assert len(table.open_buckets()) == 8
    table.compact()
    assert table.open_buckets() == set()
    assert "Exchange" not in executed(table.read())  # nothing to merge
    whole = files(table)
    table.write_batch(batch(spark, (7, "a", "y", 2)), 1, NEWEST)
    (opened,) = table.open_buckets()
    stored = table.read()
    assert stored.where("v = 'y'").count() == 1 and stored.count() == 400
    # The files of the other buckets come in below the union, without a join or an aggregate above them.
    plan = executed(stored)
    assert plan.count("bucket") and plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") <= 2
    assert table.compact(at_least=2) == set()
    assert table.compact() == {opened}
    new = {p: t for p, t in files(table).items() if p not in whole}
    assert {p.parent.name for p in new} == {f"stored_bucket={opened}"} and all(whole[p] == files(table)[p] for p in whole)
    table.expire()
    kept = files(table)
    assert table.read().count() == 400 and not any(p.parent.name == f"stored_bucket={opened}" for p in set(kept) & set(whole))


def test_a_reader_keeps_to_its_version(spark, table, rows):
    table.write_batch(batch(spark, (1, "a", "x", 1)), 0, NEWEST)
    pinned = table.read()
    table.write_batch(batch(spark, (1, "a", "y", 2)), 1, NEWEST)
    table.compact()
    assert rows(pinned, "v") == [("x",)] and rows(table.read(), "v") == [("y",)]
    table.expire(keep=3)
    assert rows(pinned, "v") == [("x",)]
