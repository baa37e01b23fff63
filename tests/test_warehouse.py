"""The whole build on a small set of landed files, with the faults a loader brings."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest

from ledgerlark.operators import quality as q
from ledgerlark.plans import warehouse
from ledgerlark.plans.checks import freshness_report, model_checks, source_checks
from ledgerlark.session import scratch_path
from ledgerlark.sources.schemas import RAW_TABLES
from pyspark.sql import functions as F

T1 = datetime(2026, 1, 10)
DAY = date(2026, 1, 5)

ROWS = {
    "exchange_rates": [(DAY, "GBP", "EUR", D("1.170000"), T1)],
    "google_analytics_sessions": [
        (1, DAY, "email", "email", "newsletter", "mobile", 3, 60, T1), (2, DAY, None, None, None, "desktop", 1, 5, T1)
    ],
    "stripe_payments": [
        ("p1", 1, D("100.00"), "gbp", "succeeded", DAY, T1), ("p2", 2, D("117.00"), "eur", "succeeded", DAY, T1)
    ],
    "stripe_refunds": [("r1", "p1", D("25.00"), "x", DAY, T1)],
    "google_ads_campaigns": [
        (1, "Google Brand Search", "active", "search", DAY, None, T1),
        (2, "Google Banner", "active", "display", DAY, None, T1),
    ],
    "google_ads_ad_groups": [(1, 1, "g", "active", T1), (2, 2, "g", "active", T1)],
    "google_ads_ads": [(1, 1, "h1", "active", "text", T1), (2, 2, "h2", "active", "text", T1)],
    "google_ads_clicks": [
        (1, 1, DAY, 100, 10, D("10.00"), 1, T1), (2, 2, DAY, 50, 0, D("20.00"), 0, T1)
    ],
    "facebook_ads_campaigns": [(1, "Facebook Leadgen Campaign", "leads", "active", DAY, None, T1)],
    "facebook_ads_ad_sets": [(1, 1, "s", "active", D("5.00"), T1)],
    "facebook_ads_ads": [(1, 1, 1, DAY, "f1", "active", 10, 1, D("7.00"), 0, T1)],
    "prod_customers": [(1, "A", "B", "a@b.example", "GB", DAY, T1), (2, "C", "D", "c@d.example", "XX", DAY, T1)],
    "prod_products": [(1, "Tee", "Apparel", D("50.00"), D("20.00"), "GBP", DAY, T1)],
    "prod_orders": [
        (1, 1, DAY, "completed", "GBP", "gclid-1-abc", T1), (2, 2, DAY, "completed", "EUR", "gclid-2-abc", T1),
        (3, 2, DAY, "cancelled", "GBP", "", T1),
    ],
    "prod_order_items": [(1, 1, 1, 2, D("50.00"), T1), (2, 2, 1, 2, D("50.00"), T1), (3, 3, 1, 1, D("50.00"), T1)],
    "prod_web_visits": [
        (1, T1, 1, "gclid-1-abc", "/", "mobile", T1), (2, T1, None, "", "/", "mobile", T1)
    ],
}


def build(spark, changes=None, keep=warehouse.lazily):
    rows = {**ROWS, **(changes or {})}
    raw = {n: spark.createDataFrame(rows[n], RAW_TABLES[n].schema) for n in RAW_TABLES}
    countries = spark.createDataFrame(
        [("Britain", "GB", "Europe", "North", "GBP", "London")],
        "country_name string, alpha_2 string, region string, sub_region string, currency_code string, timezone_name string",
    )
    currencies = spark.createDataFrame(
        [("GBP", "Pound", "GBP", 2)],
        "currency_code string, currency_name string, currency_symbol string, decimal_places int",
    )
    return raw, warehouse.build(raw, countries, currencies, date(2026, 3, 4), keep=keep)


@pytest.fixture(scope="module")
def clean(spark):
    return build(spark, keep=warehouse.in_folder(scratch_path(spark, "warehouse")))


def failing(tables, names=None):
    wanted = [c for c in source_checks() + model_checks() if names is None or c.table in names]
    return {(r["check"], r["table"], r["column"]) for r in q.run_checks(tables, wanted).where("failures > 0").collect()}


def test_all_models_are_built(clean):
    assert len(clean[1]) == 40


def test_a_clean_build_passes_every_check(clean):
    raw, models = clean
    assert failing({**raw, **models}) == set()


def test_figures(clean):
    channel = {r.channel_grouping: r for r in clean[1]["agg_channel"].collect()}
    assert set(channel) == {"Brand", "Display", "Lead Generation"}
    brand = channel["Brand"]
    assert (brand.spend, brand.attributed_orders, brand.gross_roas) == (D("10.00"), 1, 10.0)
    # 100 gross, a quarter refunded, cost 40 of which a quarter came back.
    assert brand.attributed_contribution_margin == D("45.000000") and brand.net_roas == 4.5
    assert channel["Lead Generation"].attributed_orders == 0
    assert clean[1]["agg_transactions"].count() == 2
    assert clean[1]["fct_visits"].where("attributed_platform is not null").count() == 1
    assert clean[1]["dim_customers"].where("country_name is null").count() == 1
    sessions = {r.session_id: r.channel_grouping for r in clean[1]["fct_sessions"].collect()}
    assert sessions == {1: "Organic", 2: "Other"}


def test_redelivered_payment_is_absorbed(spark, clean):
    copy = ("p1", 1, D("100.00"), "gbp", "succeeded", DAY, datetime(2026, 1, 11))
    raw, models = build(spark, {"stripe_payments": ROWS["stripe_payments"] + [copy]})
    assert failing(raw, {"stripe_payments"}) == {("unique_combination_of_columns", "stripe_payments", "id")}
    assert sorted(models["agg_transactions"].collect()) == sorted(clean[1]["agg_transactions"].collect())


def test_conflicting_payment_is_quarantined(spark):
    other = ("p1", 1, D("999.99"), "gbp", "succeeded", DAY, T1)
    raw, models = build(spark, {"stripe_payments": ROWS["stripe_payments"] + [other]})
    assert {c for c, _, _ in failing(raw, {"stripe_payments"})} == {
        "unique_combination_of_columns", "no_conflicting_duplicates"
    }
    assert [r.id for r in models["agg_transactions"].collect()] == [2]


@pytest.mark.parametrize(
    "table, row, expected",
    [
        ("prod_orders", (4, None, DAY, "completed", "GBP", None, T1), ("not_null", "stg_orders", "user_id")),
        ("prod_orders", (4, 1, DAY, "shipped", "GBP", None, T1), ("accepted_values", "stg_orders", "status")),
        ("facebook_ads_ads", (2, 1, 1, date(2026, 1, 6), "f1", "active", 1, 0, D("-12.50"), 0, T1),
         ("positive_value", "stg_facebook_ads__ads", "spend")),
        ("prod_orders", (4, 77, DAY, "completed", "GBP", None, T1), ("relationships", "dim_orders", "customer_id")),
        ("google_ads_campaigns", (3, "Google Banner", "active", "video", DAY, None, T1),
         ("unique_if_active", "stg_google_ads__campaigns", "name")),
        ("google_ads_campaigns", (3, "Google Video", "active", "video", DAY, None, T1),
         ("accepted_values_if_status", "stg_google_ads__campaigns", "campaign_type")),
    ],
)
def test_faults_are_caught(spark, table, row, expected):
    raw, models = build(spark, {table: ROWS[table] + [row]})
    parents = {"dim_customers"} | {expected[1]}
    assert expected in failing({**raw, **models}, parents)


def test_freshness(spark, clean):
    report = freshness_report(clean[0], F.lit(datetime(2026, 1, 11, 1)))
    status = {r.source: r.status for r in report.collect()}
    assert status.pop("prod_web_visits") == "error"
    assert set(status.values()) == {"warn"}


def test_missing_source_is_named(spark):
    with pytest.raises(ValueError, match="stripe_payments"):
        warehouse.build({n: None for n in RAW_TABLES if n != "stripe_payments"}, None, None, DAY)
