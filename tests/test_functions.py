from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlark.functions import calendar as cal
from ledgerlark.functions.keys import surrogate_key
from ledgerlark.functions.money import cents_to_currency, pct_change, safe_divide
from ledgerlark.functions.text import parse_click_id, regexp_contains, safe_cast_integer, scrub_emails
from ledgerlark.session import scratch_path
from ledgerlark.sources.files import write_sorted


def test_safe_divide_gives_null_without_a_denominator(frame, rows):
    df = frame([(6, 3), (1, 0), (1, None), (None, 2)], "n int, d int")
    assert rows(df.select(safe_divide(F.col("n"), F.col("d")))) == [(2.0,), (None,), (None,), (None,)]


def test_pct_change_and_minor_units(frame):
    row = frame([(15, 10, 0, 1999)], "a int, b int, z int, pence bigint").select(
        pct_change(F.col("a"), F.col("b")), pct_change(F.col("a"), F.col("z")), cents_to_currency(F.col("pence"))
    ).first()
    assert tuple(row) == (0.5, None, Decimal("19.99"))


def test_click_id(frame):
    df = frame([("gclid-12-abc",), ("gclid-x-abc",), ("gclid",), ("",), (None,), ("gclid-99999999999999999999-a",)], "g string")
    assert [r[0] for r in df.select(parse_click_id(F.col("g"))).collect()] == [12, None, None, None, None, None]


def test_safe_cast_integer_keeps_only_integers(frame):
    df = frame([("7",), ("-7",), ("12.7",), (" 7",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(safe_cast_integer(F.col("s"))).collect()] == [7, -7, None, None, None, None]


def test_surrogate_key_separates_null_from_blank(frame):
    df = frame([(None, "x"), ("", "x"), (None, "x")], "a string, b string")
    keys = [r[0] for r in df.select(surrogate_key(F.col("a"), F.col("b"))).collect()]
    assert keys[0] == keys[2] != keys[1]


def test_regex_is_unanchored_and_alternation_stays_whole(frame):
    df = frame([("xabcx",), ("lead_generation-2",), ("none",)], "s string")
    found = df.select(regexp_contains(F.col("s"), "abc"), regexp_contains(F.col("s"), "leadgen|lead_generation"))
    assert [tuple(r) for r in found.collect()] == [(True, False), (False, True), (False, False)]


def test_scrub_emails(frame):
    df = frame([("ask a.b+c@shop.example.org or x@y",), (None,)], "t string")
    assert [r[0] for r in df.select(scrub_emails(F.col("t"))).collect()] == ["ask [REDACTED] or x@y", None]


def test_fiscal_calendar(frame):
    df = frame([(date(2026, 2, 15),), (date(2026, 4, 1),), (date(2026, 12, 31),)], "d date")
    got = df.select(cal.fiscal_year(F.col("d"), 4), cal.fiscal_quarter(F.col("d"), 4)).collect()
    assert [tuple(r) for r in got] == [(2025, 4), (2026, 1), (2026, 3)]


def test_week_runs_monday_to_sunday(frame):
    df = frame([(date(2026, 1, 7),), (date(2026, 1, 5),), (date(2026, 1, 11),)], "d date")
    got = df.select(cal.week_start_monday(F.col("d")), cal.week_end_sunday(F.col("d"))).distinct().collect()
    assert [tuple(r) for r in got] == [(date(2026, 1, 5), date(2026, 1, 11))]


def test_dim_date(spark):
    dim = cal.dim_date(spark, date(2026, 3, 4))
    assert dim.count() == 13149
    day = dim.where("date = date'2026-01-04'").first().asDict()
    assert day["day_of_week_number"] == 0 and day["is_weekend"] and not day["is_today"]
    assert (day["day_of_week_name"], day["day_of_week_short"]) == ("Sunday", "Sun")
    assert (day["month_name"], day["month_short"], day["week_number"]) == ("January", "Jan", 1)
    assert (day["month_end_date"], day["year_end_date"]) == (date(2026, 1, 31), date(2026, 12, 31))
    assert len(dim.columns) == 21
    assert [r.date for r in dim.where("is_today").collect()] == [date(2026, 3, 4)]
    assert dim.where("not (date between week_start_date and week_end_date)").count() == 0


def test_click_ids_beyond_32_bits(frame):
    df = frame([("gclid-5000000000-a",)], "g string")
    assert df.select(parse_click_id(F.col("g"))).first()[0] == 5_000_000_000


def test_scrubbing_finds_what_the_plain_pattern_finds(frame):
    import re

    from ledgerlark.functions.text import EMAIL_PATTERN, REDACTED

    texts = ["a@b.com+x@y.org", "a@b", "a@b.c a.b%c+d-e@f-g.hi.jk", "x" * 50_000, "@@a@b.cd@e.fg", "", "é a@b.com.é", "a@b.com@c.de"]
    got = frame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(scrub_emails(F.col("t"))).collect()
    assert [r[0] for r in got] == [re.sub(EMAIL_PATTERN, REDACTED, t) for t in texts]


def test_a_calendar_in_sorted_files(spark):
    """Made by several tasks, stored as ranges of days that don't overlap, each in order."""
    days = cal.dim_date(spark, date(2026, 3, 4))
    assert days.rdd.getNumPartitions() > 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = write_sorted(days, scratch_path(spark, "calendar"), "date")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = stored.groupBy(F.input_file_name().alias("f")).agg(F.min("date").alias("a"), F.max("date").alias("b"), F.collect_list("date").alias("l")).collect()
    files.sort(key=lambda r: r.a)
    assert len(files) > 1 and all(x.b < y.a for x, y in zip(files, files[1:], strict=False))
    assert all(r.l == sorted(r.l) for r in files) and sum(len(r.l) for r in files) == 13_149
