import time
from datetime import datetime

from pyspark.sql import functions as F

import pytest

from ledgerlark.operators import incremental as inc
from ledgerlark.operators.revenue import ad_hierarchy
from ledgerlark.session import scratch_path
from ledgerlark.sources import files
from ledgerlark.sources.schemas import RAW_TABLES, REFERENCE_TABLES
from ledgerlark.streaming import visits as stream

RAW = RAW_TABLES["prod_web_visits"]


def at(hour):
    return datetime(2026, 1, 1, hour)


def visit(i, hour, page="/", loaded=None, gclid=None):
    return (i, at(hour), None, gclid, page, "mobile", loaded or at(hour))


def hierarchy(frame):
    return ad_hierarchy(
        frame([(3, "Ad", 5), (4, "Lost", 6), (5_000_000_000, "Late", 5)], "id bigint, headline string, ad_group_id bigint"),
        frame([(5, 7), (6, 99)], "id bigint, campaign_id bigint"),
        frame([(7, "Brand")], "id bigint, name string"),
    )


def test_high_water_mark_leaves_out_ties_and_late_rows(spark, rows):
    first = spark.createDataFrame([visit(1, 1), visit(2, 3)], RAW.schema)
    second = spark.createDataFrame([visit(3, 3), visit(4, 2), visit(5, 4)], RAW.schema)
    assert rows(inc.new_visits(first, None), "id") == [(1,), (2,)]
    assert rows(inc.new_visits(first, first), "id") == []
    assert rows(inc.new_visits(second, first), "id") == [(5,)]
    assert rows(inc.new_visits(second, first, lateness="2 hours"), "id") == [(3,), (4,), (5,)]


def test_upsert_replaces_and_adds(frame, rows):
    old = frame([(1, "a", 1), (2, "b", 1)], "id int, v string, t int")
    new = frame([(2, "c", 0), (3, "d", 1), (3, "e", 2)], "id int, v string, t int")
    assert rows(inc.upsert(old, new, ["id"], [F.col("t")])) == [(1, "a", 1), (2, "c", 0), (3, "e", 2)]


def test_upsert_table_survives_a_retried_batch(spark, rows):
    schema = spark.createDataFrame([], "id bigint, v string, t int").schema
    table = inc.UpsertTable(spark, scratch_path(spark, "t"), schema, ["id"])
    table.write_batch(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema), 0, [F.col("t")])
    table.write_batch(spark.createDataFrame([(2, "c", 2), (3, "d", 2)], schema), 1, [F.col("t")])
    table.write_batch(spark.createDataFrame([(2, "c", 2), (3, "d", 2)], schema), 1, [F.col("t")])
    expected = [(1, "a", 1), (2, "c", 2), (3, "d", 2)]
    assert rows(table.read()) == expected and table.high_water_mark("t") == 2
    smaller = table.compact(scratch_path(spark, "t2"))
    assert rows(smaller.read()) == expected
    smaller.write_batch(spark.createDataFrame([(1, "z", 3)], schema), 0, [F.col("t")])
    assert rows(smaller.read())[0] == (1, "z", 3)


def test_rows_without_a_key_are_kept(spark, frame, rows):
    old = frame([(None, "a", 1)], "id bigint, v string, t int")
    new = frame([(None, "b", 1), (None, "c", 1), (1, "d", 1)], "id bigint, v string, t int")
    assert len(rows(inc.upsert(old, new, ["id"], [F.col("t")]))) == 4
    table = inc.UpsertTable(spark, scratch_path(spark, "t"), old.schema, ["id"])
    table.write_batch(old, 0, [F.col("t")])
    table.write_batch(new, 1, [F.col("t")])
    assert len(rows(table.read())) == 4


def test_streamed_visits_are_not_doubled(spark, frame, rows):
    source, lookup = scratch_path(spark, "in"), hierarchy(frame)
    table = inc.UpsertTable(spark, scratch_path(spark, "fct"), stream.visits_schema(lookup), ["visit_id"])
    progress = scratch_path(spark, "progress")

    def load():
        job = stream.load_visits(stream.visit_stream(spark, source), lookup, table, progress)
        job.awaitTermination()

    spark.createDataFrame([visit(1, 1, gclid="gclid-3-x"), visit(2, 2), visit(2, 2)], RAW.schema).write.parquet(source)
    load()
    assert rows(table.read(), "visit_id", "attributed_campaign_id") == [(1, 7), (2, None)]
    load()
    spark.createDataFrame([visit(3, 3), visit(1, 1, gclid="gclid-3-x")], RAW.schema).write.mode("append").parquet(source)
    load()
    assert rows(table.read(), "visit_id") == [(1,), (2,), (3,)]


def test_late_visits_go_to_a_side_folder(spark, frame, rows):
    source, late, lookup = scratch_path(spark, "in"), scratch_path(spark, "late"), hierarchy(frame)
    table = inc.UpsertTable(spark, scratch_path(spark, "fct"), stream.visits_schema(lookup), ["visit_id"])
    progress = scratch_path(spark, "progress")

    def load():
        visits = stream.visit_stream(spark, source, files_per_batch=1)
        stream.load_visits(visits, lookup, table, progress, "2 hours", late).awaitTermination()

    for batch in ([visit(1, 5)], [visit(2, 4), visit(3, 1), visit(4, 6)]):
        spark.createDataFrame(batch, RAW.schema).coalesce(1).write.mode("append").parquet(source)
        load()
    assert rows(table.read(), "visit_id") == [(1,), (2,), (4,)]
    assert rows(spark.read.parquet(late), "id") == [(3,)]
    # Two batches in one run: the second is measured against the first.
    for batch in ([visit(5, 20)], [visit(6, 17), visit(7, 19)]):
        spark.createDataFrame(batch, RAW.schema).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)
    load()
    assert rows(table.read(), "visit_id") == [(1,), (2,), (4,), (5,), (7,)]
    assert rows(spark.read.parquet(late), "id") == [(3,), (6,)]


def test_visits_without_a_time_are_kept(spark, frame, rows):
    source, late, lookup = scratch_path(spark, "in"), scratch_path(spark, "late"), hierarchy(frame)
    table = inc.UpsertTable(spark, scratch_path(spark, "fct"), stream.visits_schema(lookup), ["visit_id"])
    progress = scratch_path(spark, "progress")
    for batch in ([visit(1, 5)], [visit(2, 6), (3, None, None, None, "/", "mobile", at(6)), visit(4, 1)]):
        spark.createDataFrame(batch, RAW.schema).coalesce(1).write.mode("append").parquet(source)
        visits = stream.visit_stream(spark, source, files_per_batch=1)
        stream.load_visits(visits, lookup, table, progress, "2 hours", late).awaitTermination()
    assert rows(table.read(), "visit_id") == [(1,), (2,), (3,)]
    assert rows(spark.read.parquet(late), "id") == [(4,)]
    with pytest.raises(ValueError):
        stream.load_visits(visits, lookup, table, progress, "2 hours")


def test_a_later_conflict_withdraws_a_visit(spark, rows):
    source, store, progress = (scratch_path(spark, n) for n in ("in", "store", "progress"))
    spark.createDataFrame([visit(1, 1), visit(2, 2)], RAW.schema).write.parquet(source)
    stream.land_raw(stream.visit_stream(spark, source), store, progress).awaitTermination()
    assert rows(stream.conflict_free(spark, store), "id") == [(1,), (2,)]
    spark.createDataFrame([visit(1, 1, "/other"), visit(2, 2, loaded=at(9))], RAW.schema).write.mode("append").parquet(source)
    stream.land_raw(stream.visit_stream(spark, source), store, progress).awaitTermination()
    assert rows(stream.conflict_free(spark, store), "id") == [(2,)]


def test_typed_csv(spark, tmp_path, rows):
    (tmp_path / "v.csv").write_text(
        "id,visited_at,customer_id,gclid,landing_page,device_category,_fivetran_synced\n"
        "1,2026-01-01T03:00:00Z,,,/home,mobile,2026-01-01T04:00:00Z\n"
    )
    got = files.read_csv(spark, str(tmp_path / "v.csv"), RAW.schema)
    assert rows(got) == [(1, at(3), None, None, "/home", "mobile", at(4))]


def test_declared_schemas_parse(spark):
    for table in RAW_TABLES.values():
        assert list(table.types) == table.schema.names
    for schema in REFERENCE_TABLES.values():
        assert spark.createDataFrame([], schema).columns


def test_freshness(frame):
    df = frame([(at(1),)], "t timestamp")
    status = [files.freshness(df, "s", "t", F.lit(datetime(2026, 1, d, 1)), 24, 48).first().status for d in (1, 2, 3)]
    assert status == ["pass", "warn", "error"]
    assert files.freshness(df.limit(0), "s", "t", F.lit(at(2)), 24, 48).first().status == "error"
