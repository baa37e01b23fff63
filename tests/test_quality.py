from collections import Counter

import pytest

from ledgerlark.operators import quality as q
from ledgerlark.operators.quality import WARN, Check
from ledgerlark.plans.checks import model_checks, source_checks
from ledgerlark.session import scratch_path


@pytest.fixture
def orders(frame):
    return frame(
        [
            (1, 10, "completed", 5.0), (2, None, "completed", 0.0), (3, 10, "shipped", -12.5), (3, 99, "refunded", None),
            (None, 10, "completed", 60.0),
        ],
        "id int, user_id int, status string, amount double",
    )


STATUSES = ["completed", "refunded", "cancelled"]


def test_row_checks(orders, rows):
    assert rows(q.not_null(orders, "user_id"), "id") == [(2,)]
    assert rows(q.positive_value(orders, "amount"), "id") == [(3,)]
    assert rows(q.range_check(orders, "amount", 0, 50), "amount") == [(-12.5,), (60.0,)]
    assert rows(q.accepted_values(orders, "status", STATUSES)) == [("shipped", 1)]
    assert rows(q.expression_is_true(orders, "amount >= 0"), "amount") == [(-12.5,)]
    assert rows(q.not_null_if_active(orders, "user_id", "status", "completed"), "id") == [(2,)]
    assert rows(q.accepted_values_if_status(orders, "user_id", [99], "status", "completed"), "id") == [(1,), (None,)]


def test_set_checks(orders, frame, rows):
    assert rows(q.unique(orders, "id")) == [(3, 2)]
    assert rows(q.unique_if_active(orders, "user_id", "status", "completed")) == [(10, 2)]
    assert rows(q.unique_combination_of_columns(orders, ["user_id", "status"])) == [(10, "completed", 2)]
    assert rows(q.relationships(orders, "user_id", frame([(10,), (None,)], "id int"), "id"), "user_id") == [(99,)]
    assert rows(q.at_least_one(orders, "id")) == []
    assert rows(q.at_least_one(orders.where("id is null"), "id")) == [(0,)]
    assert len(rows(q.no_conflicting_duplicates(orders, ["id"]))) == 2


def checks():
    return [
        Check("not_null", "o", "user_id", violates=lambda: q.is_missing("user_id")),
        Check("positive", "o", "amount", violates=lambda: q.is_negative("amount")),
        Check("range", "o", "id", violates=lambda: q.is_outside("id", 0, 9)),
        Check("unique", "o", "id", WARN, find=lambda t: q.unique(t["o"], "id")),
    ]


def test_summary(orders, rows):
    summary = q.run_checks({"o": orders}, checks())
    assert rows(summary, "check", "failures", "status") == [
        ("not_null", 1, "fail"), ("positive", 1, "fail"), ("range", 0, "pass"), ("unique", 1, "warn")
    ]


def test_row_checks_share_one_scan(spark, orders):
    path = scratch_path(spark, "orders")
    orders.write.parquet(path)
    summary = q.run_checks({"o": spark.read.parquet(path)}, checks()[:3])
    assert summary._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_failures_are_stored_per_check(spark, orders):
    stored = q.store_failures({"o": orders}, checks(), scratch_path(spark, "failures"))
    assert {r["check"]: r["count"] for r in stored.groupBy("check").count().collect()} == {
        "not_null": 1, "positive": 1, "unique": 1
    }


def test_publishing_is_gated(spark, orders):
    held, clean = scratch_path(spark, "held"), scratch_path(spark, "clean")
    assert q.publish_if_clean(orders, "o", checks(), held)[0] is False
    with pytest.raises(Exception):
        spark.read.parquet(held)
    assert q.publish_if_clean(orders, "o", checks()[3:], clean)[0] is True
    assert spark.read.parquet(clean).count() == orders.count()


def test_declared_checks():
    declared = source_checks() + model_checks()
    assert len(declared) == 162
    assert Counter(c.name for c in declared) == {
        "not_null": 38, "unique": 33, "positive_value": 29, "unique_combination_of_columns": 19,
        "no_conflicting_duplicates": 16, "relationships": 8, "expression_is_true": 6, "range_check": 5,
        "accepted_values": 3, "at_least_one": 2, "accepted_values_if_status": 1, "unique_if_active": 1,
        "not_null_if_active": 1,
    }
    assert all((c.violates is None) != (c.find is None) for c in declared)
