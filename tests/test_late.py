"""The visit stream under a watermark, batch by batch."""

from datetime import datetime, timedelta

from ledgerlark.operators.keyed import KeyedTable
from ledgerlark.session import scratch_path
from ledgerlark.sources.schemas import RAW_TABLES
from ledgerlark.streaming import late
from ledgerlark.streaming.visits import visit_stream

VISITS = RAW_TABLES["prod_web_visits"]


def visit(i, hour, page="/", loaded=0):
    at = None if hour is None else datetime(2026, 1, 1) + timedelta(hours=hour)
    return (i, at, None, None, page, "mobile", datetime(2026, 2, 1) + timedelta(hours=loaded))


def test_rows_are_in_the_table_or_beside_it(spark, rows):
    source, beside, progress = (scratch_path(spark, n) for n in ("in", "late", "progress"))
    table = KeyedTable(spark, scratch_path(spark, "table"), VISITS.schema, ["id"], buckets=4)

    def load(*batch):
        spark.createDataFrame(list(batch), VISITS.schema).coalesce(1).write.mode("append").parquet(source)
        late.load_on_time(visit_stream(spark, source), table, beside, progress, "2 hours").awaitTermination()

    def told():
        return rows(table.read(), "id", "landing_page"), rows(late.late_rows(VISITS.schema, table, beside), "id", "landing_page")

    load(visit(1, 5), visit(2, 6), visit(2, 6, loaded=1), visit(2, 6))  # copies in one batch
    assert told() == ([(1, "/"), (2, "/")], [])
    load(visit(3, 40), visit(None, 1), visit(None, 1), visit(4, None))  # no key, no time
    assert told()[1] == []
    load(visit(3, 40, loaded=2), visit(5, 41))  # a repeat within the delay
    load(visit(6, 80))
    load(visit(7, 10), visit(7, 10), visit(1, 5, loaded=9), visit(2, 6, "/other"), visit(8, 81), visit(9, None))
    # 7 is late, both copies; 1 is a late copy of what is there; 2 is late and says something else.
    table_rows, late_rows = told()
    assert table_rows == sorted([(i, "/") for i in (1, 2, 3, 4, 5, 6, 8, 9, None, None)], key=repr)
    assert late_rows == [(2, "/other"), (7, "/"), (7, "/")]
    load()  # nothing new
    assert told() == (table_rows, late_rows)


def test_no_late_rows_yet(spark):
    table = KeyedTable(spark, scratch_path(spark, "table"), VISITS.schema, ["id"])
    assert late.late_rows(VISITS.schema, table, scratch_path(spark, "late")).count() == 0


def test_rows_left_out_are_told_by_one_aggregate(spark, rows):
    seen = [visit(1, 5), visit(1, 5), visit(2, 6), visit(3, 7, "/a"), visit(3, 7, "/b")]
    taken = [visit(1, 5), visit(3, 7, "/b"), visit(4, None), visit(None, 8)]
    batch = spark.createDataFrame(seen, VISITS.schema).selectExpr("*", "false AS __taken")
    batch = batch.union(spark.createDataFrame(taken, VISITS.schema).selectExpr("*", "true AS __taken"))
    left = late._left_out(batch, "id")
    assert rows(left, "id", "landing_page") == [(1, "/"), (2, "/"), (3, "/a")]
    # A join would be planned by what the planner takes digests for, and send them to the driver.
    assert "Join" not in left._jdf.queryExecution().toString()
