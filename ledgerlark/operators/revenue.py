"""Orders, payments, refunds and the line-level revenue fact."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.money import money_sum, safe_divide
from ledgerlark.functions.text import parse_click_id
from ledgerlark.operators.joins import left_join_many, splittable_join

AMOUNT = T.DecimalType(18, 2)


def enrich_customers(customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Customers with the geography of their country code."""
    geography = countries.select(
        F.col("alpha_2").alias("country_code"),
        "country_name",
        "region",
        "sub_region",
        F.col("currency_code").alias("home_currency_code"),
        "timezone_name",
    )
    return splittable_join(customers, geography, ["country_code"], "left").select(
        "id", "first_name", "last_name", "email", "country_code", "country_name", "region", "sub_region",
        "home_currency_code", "timezone_name", "created_at", "_loaded_at",
    )


def enrich_products(products: DataFrame, currencies: DataFrame) -> DataFrame:
    """Products with unit profit, margin rate and currency display data."""
    display = currencies.select("currency_code", "currency_symbol", "decimal_places")
    profit = F.col("price") - F.col("unit_cost")
    return splittable_join(products, display, ["currency_code"], "left").select(
        "id", "name", "category", "price", "unit_cost",
        profit.alias("unit_gross_profit"),
        safe_divide(profit, F.col("price")).alias("gross_margin_rate"),
        "currency_code", "currency_symbol", "decimal_places", "created_at", "_loaded_at",
    )


def line_amounts(items: DataFrame) -> DataFrame:
    """Order items with the amount charged for the line."""
    return items.withColumn("gross_amount", (F.col("quantity") * F.col("unit_price")).cast(AMOUNT))


def enrich_order_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Order items with product data, line amount and line cost."""
    catalogue = products.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("category").alias("product_category"),
        "unit_cost",
        "currency_code",
    )
    return splittable_join(line_amounts(items), catalogue, ["product_id"], "left").select(
        "id", "order_id", "product_id", "product_name", "product_category", "quantity", "unit_price", "unit_cost",
        "gross_amount",
        (F.col("quantity") * F.col("unit_cost")).cast(AMOUNT).alias("gross_cost"),
        "currency_code", "_loaded_at",
    )


def item_rollup(items: DataFrame) -> DataFrame:
    """Lines, units and subtotal per order. Needs only the line's own price."""
    return (
        line_amounts(items)
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("item_count"),
            F.sum("quantity").alias("unit_count"),
            F.sum("gross_amount").alias("order_subtotal"),
        )
    )


class AdHierarchy(NamedTuple):
    """Ads, ad groups and campaigns, each as it is stored, so that each has its own size."""

    ads: DataFrame
    ad_groups: DataFrame
    campaigns: DataFrame

    def joined(self) -> DataFrame:
        """One row per ad that has a group and a campaign."""
        return self.ads.join(self.ad_groups, "ad_group_id").join(self.campaigns, "campaign_id").select(
            "ad_id", "ad_name", "campaign_id", "campaign_name"
        )


def ad_hierarchy(ads: DataFrame, ad_groups: DataFrame, campaigns: DataFrame) -> AdHierarchy:
    """Ad -> ad group -> campaign."""
    return AdHierarchy(
        ads.select(F.col("id").alias("ad_id"), F.col("headline").alias("ad_name"), "ad_group_id"),
        ad_groups.select(F.col("id").alias("ad_group_id"), "campaign_id"),
        campaigns.select(F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name")),
    )


def attribute_clicks(df: DataFrame, hierarchy: AdHierarchy, platform: str = "google_ads") -> DataFrame:
    """Add the campaign and ad behind the click id in column ``gclid``.

    Rows without a usable click id keep NULL attribution, as do ads whose group or
    campaign is missing. Ids are unique in each lookup, so rows are not multiplied. The
    lookups are joined to the rows one after the other: the planner knows the size of
    a table but not of a join of tables, and sends small ones along, so that the
    rows need not be shuffled by an ad id that most of them do not have.
    """
    ads = hierarchy.ads.select(
        F.col("ad_id").alias("__ad_id"), F.col("ad_name").alias("__ad_name"), F.col("ad_group_id").alias("__group")
    )
    groups = hierarchy.ad_groups.select(F.col("ad_group_id").alias("__group"), F.col("campaign_id").alias("__campaign"))
    campaigns = hierarchy.campaigns.select(
        F.col("campaign_id").alias("__campaign"), F.col("campaign_name").alias("__name"), F.lit(True).alias("__whole")
    )
    clicked = df.withColumn("__ad_id", parse_click_id(F.col("gclid")))
    for lookup, key in ((ads, "__ad_id"), (groups, "__group"), (campaigns, "__campaign")):
        clicked = splittable_join(clicked, lookup, [key], "left")
    whole = F.col("__whole")
    return clicked.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.when(whole, F.lit(platform)).alias("attributed_platform"),
        F.when(whole, F.col("__campaign")).alias("attributed_campaign_id"),
        F.when(whole, F.col("__name")).alias("attributed_campaign_name"),
        F.when(whole, F.col("__ad_id")).alias("attributed_ad_id"),
        F.when(whole, F.col("__ad_name")).alias("attributed_ad_name"),
    )


def orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their item rollup; orders without items count as zero."""
    zero = F.lit(0)
    return orders.join(item_rollup(items).withColumnRenamed("order_id", "id"), "id", "left").select(
        *orders.columns,
        F.coalesce("item_count", zero).alias("item_count"),
        F.coalesce("unit_count", zero).alias("unit_count"),
        F.coalesce(F.col("order_subtotal"), zero.cast(T.DecimalType(28, 2))).alias("order_subtotal"),
    )


def enrich_orders(orders: DataFrame, customers: DataFrame, items: DataFrame, hierarchy: AdHierarchy) -> DataFrame:
    """Orders with customer country, item rollup and last-click attribution."""
    country = customers.select(
        F.col("id").alias("user_id"),
        F.col("country_code").alias("customer_country_code"),
        F.col("country_name").alias("customer_country_name"),
    )
    # The rollup comes last, so what follows by order finds the orders where it needs them.
    located = splittable_join(attribute_clicks(orders, hierarchy), country, ["user_id"], "left")
    return orders_with_items(located, items).select(
        "id", "user_id", "customer_country_code", "customer_country_name", "order_date", "status", "currency_code",
        "gclid", "attributed_platform", "attributed_campaign_id", "attributed_campaign_name", "attributed_ad_id",
        "attributed_ad_name", "item_count", "unit_count", "order_subtotal", "_loaded_at",
    )


def refund_rollup(refunds: DataFrame) -> DataFrame:
    """Refunded amount and latest refund date per payment."""
    return refunds.groupBy("payment_id").agg(
        F.sum("amount").alias("refund_amount"), F.max("created_at").alias("refund_date")
    )


def payments_with_fx(payments: DataFrame, rates: DataFrame, reporting_currency: str = "GBP") -> DataFrame:
    """Payments with the exchange rate of their own day.

    The match is exact on the day: a missing rate stays NULL, so the payment
    drops out of reporting-currency totals instead of being guessed.
    """
    quoted = rates.where(F.col("base_currency") == reporting_currency).select(
        F.col("target_currency").alias("currency"), F.col("date").alias("created_at"), "rate"
    )
    own = F.col("currency") == reporting_currency
    return (
        splittable_join(payments, quoted, ["currency", "created_at"], "left")
        .withColumn("fx_rate", F.when(own, F.lit(1).cast(T.DecimalType(10, 4))).otherwise(F.col("rate")))
        .drop("rate")
        .select(*payments.columns, "fx_rate")
    )


def settle_payments(
    payments: DataFrame, refunds: DataFrame, rates: DataFrame, reporting_currency: str = "GBP"
) -> DataFrame:
    """Payments with refunds, both also in the reporting currency.

    Refunds are converted at the rate of the payment day.
    """
    converted = payments_with_fx(payments, rates, reporting_currency)
    refunded = F.coalesce(F.col("refund_amount"), F.lit(0).cast(T.DecimalType(20, 2)))
    return (
        converted.join(refund_rollup(refunds), converted["id"] == F.col("payment_id"), "left")
        .select(
            "order_id",
            F.col("id").alias("payment_id"),
            F.col("status").alias("payment_status"),
            F.col("created_at").alias("payment_date"),
            "currency",
            "fx_rate",
            F.col("amount").alias("gross_amount"),
            refunded.alias("refund_amount"),
            "refund_date",
            safe_divide(F.col("amount"), F.col("fx_rate")).alias("gross_amount_reporting"),
            safe_divide(refunded, F.col("fx_rate")).alias("refund_amount_reporting"),
            safe_divide(refunded, F.col("amount")).alias("refund_rate"),
        )
        .withColumn("net_amount_reporting", F.col("gross_amount_reporting") - F.col("refund_amount_reporting"))
    )


def order_transactions(
    orders: DataFrame,
    payments: DataFrame,
    refunds: DataFrame,
    rates: DataFrame,
    reporting_currency: str = "GBP",
) -> DataFrame:
    """Order x payment; an order without a payment keeps one row."""
    settled = settle_payments(payments, refunds, rates, reporting_currency)
    joined = left_join_many(orders.select(F.col("id").alias("order_id")), settled, ["order_id"])
    # An unpaid order has no refunds, which is zero rather than unknown.
    none = F.lit(0).cast(T.DecimalType(20, 2))
    return joined.withColumn("refund_amount", F.coalesce(F.col("refund_amount"), none))


def fct_transactions(order_items: DataFrame, orders: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per item of a paid order, with prorated refund, cost and margin.

    ``order_items`` comes from :func:`enrich_order_items`; ``orders`` needs the
    item rollup and attribution; ``transactions`` may be the settled payments or
    the order transactions. Payment state is not filtered, and an order paid
    twice repeats its items.
    """
    paid = transactions.where(F.col("payment_id").isNotNull()).select("order_id", "currency", "refund_amount_reporting")
    header = orders.select(
        F.col("id").alias("order_id"), "user_id", "order_date", "status", "attributed_platform",
        "attributed_campaign_id", "attributed_campaign_name", "order_subtotal",
    )
    # An order has few payments and lines, so the three sides can share one partitioning by order.
    settled = paid.join(header, "order_id")
    gross = F.col("gross_amount").cast("double")
    lines = order_items.join(settled, "order_id").select(
        F.col("id").alias("order_item_id"),
        "order_id",
        F.col("user_id").alias("customer_id"),
        "product_id",
        "order_date",
        "quantity",
        "unit_price",
        F.col("gross_amount").alias("gross_revenue"),
        "gross_cost",
        (gross * safe_divide(F.col("refund_amount_reporting"), F.col("order_subtotal"))).alias("refund_amount"),
        F.col("currency_code").alias("reporting_currency"),
        F.col("currency").alias("payment_currency"),
        F.col("status").alias("order_status"),
        "attributed_platform", "attributed_campaign_id", "attributed_campaign_name",
    )
    net = F.col("gross_revenue").cast("double") - F.col("refund_amount")
    kept = F.greatest(F.lit(1.0) - safe_divide(F.col("refund_amount"), F.col("gross_revenue")), F.lit(0.0))
    return (
        lines.withColumn("net_revenue", net)
        .withColumn("cogs", F.col("gross_cost").cast("double") * kept)
        .withColumn("contribution_margin", F.col("net_revenue") - F.col("cogs"))
    )


def agg_transactions(fct: DataFrame) -> DataFrame:
    """The fact rolled back up to one row per paid order."""
    return (
        fct.groupBy(
            F.col("order_id").alias("id"), "customer_id", "order_date", "order_status", "reporting_currency"
        )
        .agg(
            F.count(F.lit(1)).alias("item_count"),
            F.sum("quantity").alias("unit_count"),
            F.sum("gross_revenue").alias("gross_revenue"),
            money_sum(F.col("refund_amount")).alias("refund_amount"),
            money_sum(F.col("net_revenue")).alias("net_revenue"),
        )
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.drop("_loaded_at")


def dim_products(products: DataFrame) -> DataFrame:
    return products.drop("_loaded_at")


def dim_orders(orders: DataFrame) -> DataFrame:
    return orders.drop("_loaded_at").withColumnRenamed("user_id", "customer_id")


def dim_order_items(items: DataFrame) -> DataFrame:
    return items.drop("unit_cost", "gross_cost", "_loaded_at")
