from datetime import date, datetime
from decimal import Decimal as D

import pytest

from ledgerlark.operators import customers as cust
from ledgerlark.operators import revenue as rev

LOADED = datetime(2026, 1, 1)
DAY = date(2026, 1, 5)


@pytest.fixture
def shop(frame):
    """Two products, five orders: refunded, over-refunded, foreign, unpaid and paid twice."""
    products = frame(
        [(1, "Tee", "Apparel", D("100.00"), D("40.00"), "GBP", DAY, LOADED), (2, "Cap", "Apparel", D("0.00"), D("1.00"), "XXX", DAY, LOADED)],
        "id bigint, name string, category string, price decimal(10,2), unit_cost decimal(10,2), currency_code string, "
        "created_at date, _loaded_at timestamp",
    )
    currencies = frame([("GBP", "Pound", "GBP", 2)], "currency_code string, currency_name string, currency_symbol string, decimal_places int")
    items = frame(
        [
            (1, 10, 1, 1, D("60.00"), LOADED), (2, 10, 1, 1, D("40.00"), LOADED),
            (3, 20, 1, 1, D("50.00"), LOADED), (4, 30, 1, 1, D("100.00"), LOADED),
            (5, 40, 1, 2, D("10.00"), LOADED), (6, 50, 1, 1, D("30.00"), LOADED), (7, 50, 2, 1, D("0.00"), LOADED),
        ],
        "id bigint, order_id bigint, product_id bigint, quantity int, unit_price decimal(10,2), _loaded_at timestamp",
    )
    orders = frame(
        [
            (10, 1, DAY, "refunded", "GBP", "gclid-3-a", LOADED), (20, 1, date(2026, 1, 15), "refunded", "GBP", None, LOADED),
            (30, 2, DAY, "completed", "EUR", "gclid-9-a", LOADED), (40, 2, DAY, "cancelled", "GBP", "", LOADED),
            (50, 3, DAY, "completed", "GBP", None, LOADED), (60, 3, DAY, "completed", "GBP", None, LOADED),
        ],
        "id bigint, user_id bigint, order_date date, status string, currency_code string, gclid string, _loaded_at timestamp",
    )
    payments = frame(
        [
            ("p10", 10, D("100.00"), "GBP", "succeeded", DAY), ("p20", 20, D("50.00"), "GBP", "failed", DAY),
            ("p30", 30, D("117.00"), "EUR", "succeeded", DAY),
            ("p50", 50, D("30.00"), "GBP", "succeeded", DAY), ("q50", 50, D("30.00"), "JPY", "pending", DAY),
        ],
        "id string, order_id bigint, amount decimal(10,2), currency string, status string, created_at date",
    )
    refunds = frame(
        [
            ("r1", "p10", D("30.00"), "x", date(2026, 2, 1)), ("r2", "p10", D("20.00"), "x", date(2026, 2, 3)),
            ("r3", "p20", D("50.01"), "x", DAY), ("r4", "p30", D("11.70"), "x", date(2026, 3, 1)),
        ],
        "id string, payment_id string, amount decimal(10,2), reason string, created_at date",
    )
    rates = frame(
        [(DAY, "GBP", "EUR", D("1.1700")), (date(2026, 3, 1), "GBP", "EUR", D("2.0000")), (DAY, "USD", "EUR", D("9.0000"))],
        "date date, base_currency string, target_currency string, rate decimal(10,4)",
    )
    hierarchy = rev.ad_hierarchy(
        frame([(3, "Ad 3", 5), (4, "Lost", 6), (5_000_000_000, "Late", 5)], "id bigint, headline string, ad_group_id bigint"),
        frame([(5, 7), (6, 99)], "id bigint, campaign_id bigint"),
        frame([(7, "Brand")], "id bigint, name string"),
    )
    customers = frame(
        [(i, "A", "B", "a@b.example", "N1", LOADED.date(), LOADED) for i in (1, 2, 3, 4)],
        "id bigint, first_name string, last_name string, email string, country_code string, created_at date, _loaded_at timestamp",
    )
    countries = frame([("N1", "Land", "R", "SR", "GBP", "Z")], "alpha_2 string, country_name string, region string, sub_region string, currency_code string, timezone_name string")
    enriched_products = rev.enrich_products(products, currencies)
    enriched_customers = rev.enrich_customers(customers, countries)
    order_items = rev.enrich_order_items(items, enriched_products)
    enriched = rev.enrich_orders(orders, enriched_customers, items, hierarchy)
    transactions = rev.order_transactions(orders, payments, refunds, rates)
    return dict(
        products=enriched_products, customers=enriched_customers, items=order_items, orders=enriched,
        transactions=transactions, settled=rev.settle_payments(payments, refunds, rates),
        fct=rev.fct_transactions(order_items, enriched, transactions),
    )


def one(df, condition):
    (row,) = df.where(condition).collect()
    return row.asDict()


def test_products_and_items(shop):
    assert one(shop["products"], "id = 1")["gross_margin_rate"] == 0.6
    assert one(shop["products"], "id = 2")["gross_margin_rate"] is None
    item = one(shop["items"], "id = 5")
    assert (item["gross_amount"], item["gross_cost"]) == (D("20.00"), D("80.00"))


def test_orders_without_items_count_zero_and_only_known_ads_attribute(shop):
    empty = one(shop["orders"], "id = 60")
    assert (empty["item_count"], empty["unit_count"], empty["order_subtotal"]) == (0, 0, D("0.00"))
    assert one(shop["orders"], "id = 10")["attributed_campaign_id"] == 7
    assert one(shop["orders"], "id = 30")["attributed_platform"] is None
    assert shop["orders"].count() == 6


def test_conversion_uses_the_payment_day_and_missing_rates_stay_null(shop):
    eur = one(shop["transactions"], "payment_id = 'p30'")
    assert eur["gross_amount_reporting"] == pytest.approx(100.0)
    assert eur["refund_amount_reporting"] == pytest.approx(10.0)
    yen = one(shop["transactions"], "payment_id = 'q50'")
    assert yen["fx_rate"] is None and yen["gross_amount_reporting"] is None
    assert one(shop["transactions"], "payment_id = 'p10'")["refund_date"] == date(2026, 2, 3)


def test_unpaid_orders_stay_in_the_transactions(shop):
    assert shop["transactions"].count() == 7
    unpaid = one(shop["transactions"], "order_id = 40")
    assert unpaid["payment_id"] is None and unpaid["refund_amount"] == 0 and unpaid["net_amount_reporting"] is None


def test_refund_is_prorated_and_reduces_cost(shop):
    first, second = one(shop["fct"], "order_item_id = 1"), one(shop["fct"], "order_item_id = 2")
    assert (first["refund_amount"], second["refund_amount"]) == (30.0, 20.0)
    assert (first["cogs"], second["cogs"]) == (20.0, 20.0)
    assert first["net_revenue"] == 30.0 and first["contribution_margin"] == 10.0


def test_refund_above_the_subtotal_does_not_turn_cost_negative(shop):
    over = one(shop["fct"], "order_item_id = 3")
    assert over["net_revenue"] < 0 and over["cogs"] == 0.0


def test_fact_grain(shop):
    fct = shop["fct"]
    assert fct.where("order_id = 40").count() == 0
    assert fct.where("order_id = 50").count() == 4
    assert fct.where("order_item_id = 7 and payment_currency = 'GBP'").first().cogs == 0.0
    assert set(r.reporting_currency for r in fct.where("product_id = 2").collect()) == {"XXX"}


def test_settled_payments_give_the_same_fact(shop, rows):
    assert rows(rev.fct_transactions(shop["items"], shop["orders"], shop["settled"])) == rows(shop["fct"])


def test_order_rollup(shop):
    order = one(rev.agg_transactions(shop["fct"]), "id = 10")
    assert (order["item_count"], order["unit_count"], order["gross_revenue"]) == (2, 2, D("100.00"))
    assert (order["refund_amount"], order["net_revenue"]) == (D("50.000000"), D("50.000000"))


def test_lifetime_value(shop):
    ltv = cust.customer_lifetime_value(rev.dim_customers(shop["customers"]), shop["fct"])
    one_, none = one(ltv, "id = 1"), one(ltv, "id = 4")
    assert one_["order_count"] == 2 and one_["lifetime_gross_revenue"] == D("150.00")
    assert one_["lifetime_value"] == one_["lifetime_gross_revenue"] - one_["lifetime_refund_amount"]
    assert one_["purchase_frequency_per_year"] == 2.0
    assert one_["projected_value_3y"] == pytest.approx(3 * one_["projected_value_1y"])
    assert (none["order_count"], none["lifetime_value"], none["avg_order_value"]) == (0, 0, None)
    assert none["projected_value_5y"] == 0.0 and none["first_order_date"] is None


def test_inventory_and_tops(shop):
    stock = cust.product_inventory(rev.dim_products(shop["products"]), shop["fct"])
    assert one(stock, "id = 1")["orders_containing_product"] == 4
    best = cust.top_customers(shop["fct"], shop["customers"], limit=2).collect()
    assert len(best) == 2 and best[0].contribution >= best[1].contribution
    products = cust.top_products(shop["fct"], shop["products"]).collect()
    assert {p.product_id: p.list_margin_pct for p in products} == {1: 60.0, 2: None}


def test_demographics_counts_null_groups(frame, rows):
    df = frame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, None, None), (5, None, None)], "id int, country_code string, region string")
    got = cust.customer_demographics(df).select("id", "customers_in_country", "customers_in_region")
    assert rows(got) == [(1, 2, 3), (2, 2, 3), (3, 1, 3), (4, 2, 2), (5, 2, 2)]
