"""The full build: staging, intermediate and analytics models over raw tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.calendar import dim_date
from ledgerlark.operators import customers as cust
from ledgerlark.operators import marketing as mkt
from ledgerlark.operators import revenue as rev
from ledgerlark.operators.incremental import build_visits
from ledgerlark.operators.staging import stage
from ledgerlark.operators.taxonomy import DEFAULT_RULES, Rule
from ledgerlark.sources.files import write_table
from ledgerlark.sources.schemas import RAW_TABLES

# Staging model -> source table.
STAGING = {
    "stg_customers": "prod_customers",
    "stg_orders": "prod_orders",
    "stg_order_items": "prod_order_items",
    "stg_products": "prod_products",
    "stg_web_visits": "prod_web_visits",
    "stg_stripe__payments": "stripe_payments",
    "stg_stripe__refunds": "stripe_refunds",
    "stg_exchange_rates": "exchange_rates",
    "stg_google_analytics__sessions": "google_analytics_sessions",
    "stg_google_ads__campaigns": "google_ads_campaigns",
    "stg_google_ads__ad_groups": "google_ads_ad_groups",
    "stg_google_ads__ads": "google_ads_ads",
    "stg_google_ads__clicks": "google_ads_clicks",
    "stg_facebook_ads__campaigns": "facebook_ads_campaigns",
    "stg_facebook_ads__ad_sets": "facebook_ads_ad_sets",
    "stg_facebook_ads__ads": "facebook_ads_ads",
}

Keep = Callable[[str, DataFrame], DataFrame]


def lazily(name: str, df: DataFrame) -> DataFrame:
    """Keep a model as a plan."""
    return df


def in_folder(root: str) -> Keep:
    """Keep a model as a table below ``root``: later models start from files."""
    return lambda name, df: write_table(df, f"{root.rstrip('/')}/{name}")


def staging_models(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {model: stage(raw[source], source) for model, source in STAGING.items() if source in raw}


def build(
    raw: dict[str, DataFrame],
    countries: DataFrame,
    currencies: DataFrame,
    as_of: date,
    reporting_currency: str = "GBP",
    fiscal_start_month: int = 1,
    rules: Iterable[Rule] = DEFAULT_RULES,
    keep: Keep = lazily,
) -> dict[str, DataFrame]:
    """All models by name. ``keep`` decides whether a table is stored or stays lazy.

    Staging stays lazy; every intermediate and analytics model passes through
    ``keep``. The revenue fact feeds six other models, so a cluster run should
    store it.
    """
    missing = set(RAW_TABLES) - set(raw)
    if missing:
        raise ValueError(f"raw tables missing: {sorted(missing)}")
    rules = list(rules)
    spark = countries.sparkSession
    m = staging_models(raw)

    def add(name: str, df: DataFrame) -> None:
        m[name] = keep(name, df)

    add("int_customer__enriched", rev.enrich_customers(m["stg_customers"], countries))
    add("int_product__enriched", rev.enrich_products(m["stg_products"], currencies))
    add("int_order_items__enriched", rev.enrich_order_items(m["stg_order_items"], m["int_product__enriched"]))
    hierarchy = rev.ad_hierarchy(
        m["stg_google_ads__ads"], m["stg_google_ads__ad_groups"], m["stg_google_ads__campaigns"]
    )
    add(
        "int_order__enriched",
        rev.enrich_orders(
            m["stg_orders"], m["int_customer__enriched"], m["int_order_items__enriched"], hierarchy
        ),
    )
    add(
        "int_order__transactions",
        rev.order_transactions(
            m["stg_orders"], m["stg_stripe__payments"], m["stg_stripe__refunds"], m["stg_exchange_rates"],
            reporting_currency,
        ),
    )
    add(
        "int_marketing__combined",
        mkt.marketing_combined(
            mkt.google_performance(m["stg_google_ads__clicks"], hierarchy),
            mkt.facebook_performance(
                m["stg_facebook_ads__ads"], m["stg_facebook_ads__ad_sets"], m["stg_facebook_ads__campaigns"]
            ),
        ),
    )
    add("int_marketing__channel_classification", mkt.classify_campaigns(m["int_marketing__combined"], rules))
    sessions = m["stg_google_analytics__sessions"]
    add("int_session__marketing_channel_classification", mkt.classify_sessions(sessions, rules))

    add("dim_customers", rev.dim_customers(m["int_customer__enriched"]))
    add("dim_products", rev.dim_products(m["int_product__enriched"]))
    add("dim_orders", rev.dim_orders(m["int_order__enriched"]))
    add("dim_order_items", rev.dim_order_items(m["int_order_items__enriched"]))
    add("dim_date", dim_date(spark, as_of, fiscal_start_month=fiscal_start_month))
    add(
        "fct_transactions",
        rev.fct_transactions(
            m["int_order_items__enriched"], m["int_order__enriched"], m["int_order__transactions"]
        ),
    )
    channels = m["int_marketing__channel_classification"]
    add("fct_marketing", mkt.fct_marketing(m["int_marketing__combined"], channels))
    add("fct_sessions", mkt.fct_sessions(sessions, rules))
    add("fct_visits", build_visits(m["stg_web_visits"], hierarchy))
    fct = m["fct_transactions"]
    add("agg_channel", mkt.agg_channel(m["fct_marketing"], fct, channels))
    add("agg_marketing", mkt.agg_marketing(m["fct_marketing"]))
    add("agg_transactions", rev.agg_transactions(fct))
    add("agg_inventory", cust.product_inventory(m["dim_products"], fct))
    add("agg_products", cust.product_prices(m["dim_products"], F.lit(as_of)))
    add("agg_customer_demographics", cust.customer_demographics(m["dim_customers"]))
    add("agg_customer_lifetime_value", cust.customer_lifetime_value(m["dim_customers"], fct))
    return m
