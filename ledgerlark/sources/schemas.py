"""Declared schemas. Nothing is inferred: inference changes NULL behaviour.

Ids are BIGINT, because a 32-bit id runs out long before the data does.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

LOADED_AT = "_fivetran_synced"


@dataclass(frozen=True)
class RawTable:
    """A landing-zone table: declared columns, key, and what staging changes."""

    columns: str
    keys: tuple[str, ...] = ("id",)
    rename: dict[str, str] = field(default_factory=dict)
    upper: tuple[str, ...] = ()
    blank_to_null: tuple[str, ...] = ()
    warn_hours: int = 24
    error_hours: int = 48

    @property
    def types(self) -> dict[str, str]:
        """Column name -> declared type, the load timestamp included."""
        parts = re.split(r",\s*(?![^(]*\))", f"{self.columns}, {LOADED_AT} timestamp")
        return dict(part.split(" ", 1) for part in parts)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(f"{self.columns}, {LOADED_AT} timestamp")


# The sixteen source tables.
RAW_TABLES = {
    "exchange_rates": RawTable(
        "date date, base_currency string, target_currency string, rate decimal(12,6)",
        keys=("date", "base_currency", "target_currency"),
    ),
    "google_analytics_sessions": RawTable(
        "id bigint, session_date date, source string, medium string, campaign string, "
        "device_category string, pageviews int, session_duration_seconds int",
        rename={"id": "session_id"},
    ),
    "stripe_payments": RawTable(
        "id string, order_id bigint, amount decimal(12,2), currency string, status string, created_at date",
        upper=("currency",),
    ),
    "stripe_refunds": RawTable(
        "id string, payment_id string, amount decimal(12,2), reason string, created_at date"
    ),
    "google_ads_campaigns": RawTable(
        "id bigint, name string, status string, campaign_type string, start_date date, end_date date"
    ),
    "google_ads_ad_groups": RawTable("id bigint, campaign_id bigint, name string, status string"),
    "google_ads_ads": RawTable("id bigint, ad_group_id bigint, headline string, status string, ad_type string"),
    "google_ads_clicks": RawTable(
        "id bigint, ad_id bigint, date date, impressions int, clicks int, cost decimal(12,2), conversions int"
    ),
    "facebook_ads_campaigns": RawTable(
        "id bigint, name string, objective string, status string, start_date date, end_date date"
    ),
    "facebook_ads_ad_sets": RawTable(
        "id bigint, campaign_id bigint, name string, status string, daily_budget decimal(12,2)"
    ),
    "facebook_ads_ads": RawTable(
        "id bigint, ad_id bigint, ad_set_id bigint, date date, name string, status string, "
        "impressions int, clicks int, spend decimal(12,2), conversions int"
    ),
    "prod_customers": RawTable(
        "id bigint, first_name string, last_name string, email string, country_code string, created_at date"
    ),
    "prod_products": RawTable(
        "id bigint, name string, category string, price decimal(12,2), unit_cost decimal(12,2), "
        "currency_code string, created_at date"
    ),
    "prod_orders": RawTable(
        "id bigint, user_id bigint, order_date date, status string, currency_code string, gclid string",
        blank_to_null=("gclid",),
    ),
    "prod_order_items": RawTable(
        "id bigint, order_id bigint, product_id bigint, quantity int, unit_price decimal(12,2)"
    ),
    "prod_web_visits": RawTable(
        "id bigint, visited_at timestamp, customer_id bigint, gclid string, landing_page string, "
        "device_category string",
        blank_to_null=("gclid",),
        warn_hours=2,
        error_hours=6,
    ),
}

# The reference tables maintained by hand.
REFERENCE_TABLES = {
    "country_codes": (
        "country_name string, alpha_2 string, alpha_3 string, numeric string, region string, sub_region string, "
        "intermediate_region string, currency_code string, timezone_name string"
    ),
    "currency_info": (
        "currency_code string, currency_name string, currency_symbol string, decimal_places int"
    ),
    "marketing_channel_taxonomy": "campaign_name_pattern string, channel string, subchannel string",
    "bank_holidays": "country_code string, market string, holiday_date date, holiday_name string",
    "timezones": "timezone_name string, utc_offset string, supports_dst boolean, example_city string",
    "calendar": "day date, week date, month date, quarter date, year int",
    "uk_outward_postal_codes": (
        "outward_code string, latitude double, longitude double, town string, region string, uk_region string, "
        "country string, country_string string"
    ),
}
