"""Restated days and published versions."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import quality as q
from ledgerlark.operators.restate import Load, RestatedTable, day_checksums
from ledgerlark.session import scratch_path
from ledgerlark.sources.published import PublishedTable

SCHEMA = "id bigint, day date, v double"


def files(table):
    return {str(p): p.stat().st_mtime_ns for p in Path(table.log.path).rglob("*.parquet")}


def rows_of(*days):
    return [(i, None if d is None else date(2026, 1, d), v) for d, values in days for i, v in enumerate(values)]


def test_only_restated_days_are_written(spark, rows):
    table = RestatedTable(spark, scratch_path(spark, "days"), spark.createDataFrame([], SCHEMA).schema, "day")
    first = rows_of((1, [1.0, 2.0, 2.0]), (2, [3.0]), (3, [4.0, 5.0]), (None, [6.0]))
    assert table.load(spark.createDataFrame(first, SCHEMA)).restated == ("2026-01-01", "2026-01-02", "2026-01-03", "none")
    assert rows(table.read()) == rows(spark.createDataFrame(first, SCHEMA))
    before = files(table)
    shuffled = spark.createDataFrame(first[::-1], SCHEMA).repartition(3)
    assert table.load(shuffled) == Load() and files(table) == before and table.log.versions() == [0]
    second = rows_of((1, [1.0, 2.0, 2.0]), (2, [3.5]), (4, [7.0, None]), (None, [6.0, 6.0]))
    assert table.load(spark.createDataFrame(second, SCHEMA)) == Load(("2026-01-02", "2026-01-04", "none"), ("2026-01-03",))
    assert rows(table.read()) == rows(spark.createDataFrame(second, SCHEMA))
    assert rows(table.read(version=0)) == rows(spark.createDataFrame(first, SCHEMA))
    assert {Path(p).parent.name for p in set(files(table)) - set(before)} == {"stored_day=2026-01-02", "stored_day=2026-01-04", "stored_day=none"}
    assert all(files(table)[p] == t for p, t in before.items())
    table.expire()
    assert rows(table.read()) == rows(spark.createDataFrame(second, SCHEMA))
    assert {Path(p).parent.name for p in files(table)} == {"stored_day=2026-01-01", "stored_day=2026-01-02", "stored_day=2026-01-04", "stored_day=none"}
    assert table.load(spark.createDataFrame([], SCHEMA)).gone and rows(table.read()) == []


def test_checksums_tell_rows_apart(spark):
    def of(data):
        df = spark.createDataFrame(data, "day string, a string, b string")
        return {tuple(r) for r in day_checksums(df, "day", ["a", "b"]).collect()}

    base = [("x", "1", "2"), ("x", "1", "2"), ("x", None, "3"), (None, "1", "2")]
    assert of(base) == of(base[::-1])
    for other in (base[1:], [*base, base[0]], [("x", "2", "1"), *base[1:]], [*base[:2], ("x", "3", None), base[3]]):
        assert of(other) != of(base)


def check(limit):
    return q.Check("range_check", "o", "v", violates=lambda: F.col("v") > limit)


def test_publishing_moves_a_pointer(spark, rows):
    table = PublishedTable(spark, scratch_path(spark, "published"))
    assert table.read() is None
    one, two = (spark.createDataFrame([(i,)], "v int") for i in (1, 2))
    assert q.publish_version_if_clean(one, "o", [check(5)], table)[0] is True
    reader = table.read()
    assert q.publish_version_if_clean(two, "o", [check(1)], table)[0] is False
    assert rows(table.read()) == [(1,)] and len(table.log.names("data")) == 1
    assert q.publish_version_if_clean(two, "o", [check(5)], table)[0] is True
    assert rows(table.read()) == [(2,)] and rows(reader) == [(1,)] and rows(table.read(version=0)) == [(1,)]
    assert len(table.expire(keep=1)) == 1 and rows(table.read()) == [(2,)]


@pytest.mark.parametrize("step", ["stage", "check", "before the pointer", "in the pointer"])
def test_a_writer_that_stops_leaves_a_whole_table(spark, rows, monkeypatch, step):
    table = PublishedTable(spark, scratch_path(spark, "published"))
    q.publish_version_if_clean(spark.createDataFrame([(1,)], "v int"), "o", [check(5)], table)

    def stop(*_args, **_kwargs):
        raise OSError("stopped")

    with monkeypatch.context() as broken:
        if step == "stage":
            broken.setattr(table, "stage", lambda df: (PublishedTable.stage(table, df), stop()))
        elif step == "check":
            broken.setattr(q, "run_checks", stop)
        elif step == "before the pointer":
            broken.setattr(table, "publish", stop)
        else:
            broken.setattr(table.log, "_on", lambda name, real=table.log._on: stop() if name.endswith("1.json") else real(name))
        with pytest.raises(OSError):
            q.publish_version_if_clean(spark.createDataFrame([(2,)], "v int"), "o", [check(5)], table)
    assert rows(table.read()) == [(1,)]
    assert q.publish_version_if_clean(spark.createDataFrame([(3,)], "v int"), "o", [check(5)], table)[0] is True
    assert rows(table.read()) == [(3,)]
    table.expire(keep=1)
    assert len(table.log.names("data")) == 1 and rows(table.read()) == [(3,)]


def test_failures_are_found_in_one_scan(spark):
    path = scratch_path(spark, "rows")
    spark.range(50).select("id", (F.col("id") % 7).alias("v")).write.parquet(path)
    checks = [q.Check(f"c{i}", "o", "v", violates=lambda i=i: F.col("v") == i) for i in range(6)]
    stored = q.stored_failures({"o": spark.read.parquet(path)}, checks)
    assert stored._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["check"]: r["count"] for r in stored.groupBy("check").count().collect()} == {f"c{i}": len(range(i, 50, 7)) for i in range(6)}
