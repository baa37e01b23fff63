from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import history as hist

RUNS = [datetime(2026, 1, d) for d in (1, 2, 3, 4)]


def run_check(frame, prices, close_missing=True):
    history = None
    for run, price in zip(RUNS, prices):
        incoming = frame([] if price is None else [(1, price)], "id int, price int")
        history = hist.snapshot_by_check(history, incoming, ["id"], ["price"], F.lit(run), close_missing)
    return history


@pytest.mark.parametrize(
    "prices, versions, still_open", [([10], 1, 1), ([10, 10], 1, 1), ([10, 10, 12], 2, 1), ([10, 10, 12, None], 2, 0)]
)
def test_check_strategy(frame, prices, versions, still_open):
    history = run_check(frame, prices)
    assert history.count() == versions
    assert history.where("valid_to is null").count() == still_open


def test_a_key_that_returns_opens_a_new_version(frame, rows):
    history = run_check(frame, [10, None, 10])
    assert rows(history, "price", "valid_from", "valid_to") == [(10, RUNS[0], RUNS[1]), (10, RUNS[2], None)]


def test_partial_load_does_not_close(frame):
    assert run_check(frame, [10, None], close_missing=False).where("valid_to is null").count() == 1


def test_null_price_is_a_value(frame):
    first = hist.snapshot_by_check(None, frame([(1, None)], "id int, price int"), ["id"], ["price"], F.lit(RUNS[0]))
    same = hist.snapshot_by_check(first, frame([(1, None)], "id int, price int"), ["id"], ["price"], F.lit(RUNS[1]))
    assert same.count() == 1
    assert hist.snapshot_by_check(same, frame([(1, 5)], "id int, price int"), ["id"], ["price"], F.lit(RUNS[2])).count() == 2


def rate(day, value, loaded):
    return (day, "GBP", "EUR", value, loaded)


SCHEMA = "date date, base_currency string, target_currency string, exchange_rate double, _loaded_at timestamp"
KEYS = ["date", "base_currency", "target_currency"]


def test_timestamp_strategy_and_lookup(frame, rows):
    day, t1, t2 = date(2026, 1, 1), datetime(2026, 1, 1, 6), datetime(2026, 1, 9)
    first = hist.snapshot_by_timestamp(None, frame([rate(day, 1.1, t1)], SCHEMA), KEYS, "_loaded_at", F.lit(RUNS[0]))
    again = hist.snapshot_by_timestamp(first, frame([rate(day, 1.1, t1)], SCHEMA), KEYS, "_loaded_at", F.lit(RUNS[1]))
    assert rows(again) == rows(first)
    later = hist.snapshot_by_timestamp(again, frame([rate(day, 1.3, t2)], SCHEMA), KEYS, "_loaded_at", F.lit(RUNS[2]))
    assert rows(later, "exchange_rate", "valid_from", "valid_to") == [(1.1, t1, t2), (1.3, t2, None)]
    assert later.select("scd_id").distinct().count() == 2
    facts = frame(
        [(i, day, "GBP", "EUR", at) for i, at in enumerate([datetime(2025, 12, 1), t1, datetime(2026, 1, 5), t2])],
        "n int, date date, base_currency string, target_currency string, at timestamp",
    )
    got = hist.as_of(facts, later, KEYS, "at", ["exchange_rate"])
    assert rows(got, "n", "exchange_rate") == [(0, None), (1, 1.1), (2, 1.1), (3, 1.3)]


def test_rows_without_a_key_keep_their_version(frame):
    incoming = frame([(None, "a", 1), (1, None, 2)], "id bigint, part string, v int")
    at = F.to_timestamp(F.lit("2026-03-01 00:00:00"))
    first = hist.snapshot_by_check(None, incoming, ["id", "part"], ["v"], at)
    third = hist.snapshot_by_check(hist.snapshot_by_check(first, incoming, ["id", "part"], ["v"], at), incoming, ["id", "part"], ["v"], at)
    told = sorted(map(repr, third.select("id", "part", "v", "valid_to").collect()))
    assert told == sorted(map(repr, first.select("id", "part", "v", "valid_to").collect())) and len(told) == 2
    changed = hist.snapshot_by_check(first, incoming.withColumn("v", F.lit(9)), ["id", "part"], ["v"], at)
    assert changed.count() == 4 and changed.where("valid_to IS NULL AND v = 9").count() == 2


def test_as_of_against_plain_search(spark, frame):
    """Random histories, with facts before, at, between and after their versions, NULL keys and NULL times."""
    import random

    rng = random.Random(2)
    versions, facts = [], []
    for key in [*range(12), None]:
        at = 0
        for n in range(rng.randrange(0, 9)):
            start = at + rng.randrange(0, 3)
            end = start + rng.randrange(0, 4)
            open_ = rng.random() < 0.15
            versions.append((key, f"{key}-{n}", moment(start), None if open_ else moment(end)))
            if open_:
                break
            at = end
        facts += [(key, n, moment(rng.randrange(-2, 30)) if rng.random() > 0.05 else None, "own") for n in range(40)]
    facts += [(99, 0, moment(1), "own")] + facts[:5]
    history = frame(versions, "id bigint, v string, valid_from timestamp, valid_to timestamp")
    asked = frame(facts, "id int, n int, at timestamp, valid_to string")

    def plain(key, at):
        held = [v for v in versions if v[0] == key and at is not None and v[2] <= at]
        if not held:
            return None
        last = max(held, key=lambda v: (v[2], v[3] or datetime.max))
        return last[1] if last[3] is None or at < last[3] else None

    expected = sorted((repr((*f, plain(f[0], f[2]))) for f in facts))
    for parts in (1, 7, 60):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = hist.as_of(asked, history, ["id"], "at", ["v"])
        assert got.columns == ["id", "n", "at", "valid_to", "v"]
        assert sorted(repr(tuple(r)) for r in got.collect()) == expected
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert hist.as_of(asked.limit(0), history, ["id"], "at", ["v"]).count() == 0
    assert hist.as_of(asked, history.limit(0), ["id"], "at", ["v"]).where("v IS NULL").count() == len(facts)


def moment(n):
    from datetime import timedelta

    return datetime(2026, 1, 1) + timedelta(hours=n)
