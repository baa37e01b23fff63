"""Customer and product aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.money import money_sum, safe_divide

def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast(T.DecimalType(30, 6))).alias(name)


def customer_lifetime_value(customers: DataFrame, fct: DataFrame) -> DataFrame:
    """Observed value per customer and a run-rate projection for 1, 3 and 5 years."""
    observed = fct.groupBy(F.col("customer_id").alias("id")).agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("gross_revenue").alias("lifetime_gross_revenue"),
        money_sum(F.col("refund_amount")).alias("lifetime_refund_amount"),
        money_sum(F.col("net_revenue")).alias("lifetime_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
    )
    tenure_days = F.greatest(F.datediff("most_recent_order_date", "first_order_date"), F.lit(0))
    tenure_years = F.greatest(tenure_days.cast("double") / F.lit(365.0), F.lit(1.0))
    annual = F.greatest(F.col("avg_order_value") * F.col("purchase_frequency_per_year"), F.lit(0.0))
    return (
        customers.select("id", "first_name", "last_name", "email", "country_name", "home_currency_code")
        .join(observed, "id", "left")
        .withColumn("order_count", F.coalesce("order_count", F.lit(0)))
        .withColumn("lifetime_gross_revenue", _or_zero("lifetime_gross_revenue"))
        .withColumn("lifetime_refund_amount", _or_zero("lifetime_refund_amount"))
        .withColumn("lifetime_value", _or_zero("lifetime_value"))
        .withColumn("avg_order_value", safe_divide(F.col("lifetime_value"), F.col("order_count")))
        .withColumn("purchase_frequency_per_year", safe_divide(F.col("order_count"), tenure_years))
        .withColumn("projected_value_1y", annual)
        .withColumn("projected_value_3y", annual * 3)
        .withColumn("projected_value_5y", annual * 5)
    )


def customer_demographics(customers: DataFrame) -> DataFrame:
    """Customers with the head count of their country and region.

    A window per region would put each region into one task. The counts are
    small tables, so they are computed once and joined back.
    """
    counts = customers.groupBy("country_code", "region").agg(F.count(F.lit(1)).alias("customers"))
    in_country = counts.groupBy(F.col("country_code").alias("__country")).agg(
        F.sum("customers").alias("customers_in_country")
    )
    in_region = counts.groupBy(F.col("region").alias("__region")).agg(F.sum("customers").alias("customers_in_region"))
    return (
        customers.join(in_country, F.col("country_code").eqNullSafe(F.col("__country")), "left")
        .join(in_region, F.col("region").eqNullSafe(F.col("__region")), "left")
        .drop("__country", "__region")
    )


def product_inventory(products: DataFrame, fct: DataFrame) -> DataFrame:
    """Catalogue with units sold, orders reached and revenue; zero when unsold."""
    movement = fct.groupBy(F.col("product_id").alias("id")).agg(
        F.sum("quantity").alias("units_sold"),
        F.count_distinct("order_id").alias("orders_containing_product"),
        F.sum("gross_revenue").alias("gross_revenue"),
    )
    return (
        products.select("id", "name", "category", "price", "currency_code")
        .join(movement, "id", "left")
        .withColumn("units_sold", F.coalesce("units_sold", F.lit(0)))
        .withColumn("orders_containing_product", F.coalesce("orders_containing_product", F.lit(0)))
        .withColumn("gross_revenue", F.coalesce(F.col("gross_revenue"), F.lit(0).cast(T.DecimalType(28, 2))))
    )


def product_prices(products: DataFrame, as_of: Column) -> DataFrame:
    """Catalogue prices as of a day; the input of the price history."""
    return products.select(as_of.alias("date"), "id", "name", "category", "price", "currency_code")


def top_customers(fct: DataFrame, customers: DataFrame, limit: int = 20) -> DataFrame:
    """Customers ranked by contribution, with their return rate."""
    totals = fct.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("gross_revenue").alias("gross_sum"),
        money_sum(F.col("refund_amount")).alias("refund_sum"),
        F.round(money_sum(F.col("cogs")), 2).alias("cogs"),
        F.round(money_sum(F.col("contribution_margin")), 2).alias("contribution"),
    )
    # Ranking comes first: names are looked up for the reported rows only.
    best = totals.orderBy(F.desc("contribution"), "customer_id").limit(limit)
    names = customers.select(
        F.col("id").alias("customer_id"),
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "country_name",
    )
    return (
        best.join(names, "customer_id", "left")
        .select(
            "customer_id", "customer_name", "country_name", "orders",
            F.round("gross_sum", 2).alias("gross_revenue"),
            F.round("refund_sum", 2).alias("refunds"),
            "cogs",
            "contribution",
            _return_rate().alias("return_rate_pct"),
        )
        .orderBy(F.desc("contribution"), "customer_id")
    )


def top_products(fct: DataFrame, products: DataFrame, limit: int = 20) -> DataFrame:
    """Products ranked by contribution, with list margin and return rate."""
    totals = fct.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("gross_revenue").alias("gross_sum"),
        money_sum(F.col("refund_amount")).alias("refund_sum"),
        F.round(money_sum(F.col("contribution_margin")), 2).alias("contribution"),
    )
    best = totals.orderBy(F.desc("contribution"), "product_id").limit(limit)
    catalogue = products.select(
        F.col("id").alias("product_id"), F.col("name").alias("product_name"), "category", "gross_margin_rate"
    )
    return (
        best.join(catalogue, "product_id", "left")
        .select(
            "product_id", "product_name", "category", "units_sold",
            F.round("gross_sum", 2).alias("gross_revenue"),
            "contribution",
            F.round(F.lit(100.0) * F.col("gross_margin_rate"), 1).alias("list_margin_pct"),
            _return_rate().alias("return_rate_pct"),
        )
        .orderBy(F.desc("contribution"), "product_id")
    )


def _return_rate() -> Column:
    return F.round(F.lit(100.0) * safe_divide(F.col("refund_sum"), F.col("gross_sum")), 1)
