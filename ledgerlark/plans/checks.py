"""The checks declared on sources and models."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators import quality as q
from ledgerlark.operators.quality import ERROR, WARN, Check
from ledgerlark.sources.files import freshness
from ledgerlark.sources.schemas import LOADED_AT, RAW_TABLES

# What is declared on which column.
NOT_NULL = {
    "stg_stripe__payments": ["id"],
    "stg_stripe__refunds": ["id"],
    "stg_facebook_ads__ads": ["id"],
    "stg_facebook_ads__ad_sets": ["id"],
    "stg_facebook_ads__campaigns": ["id"],
    "stg_google_ads__clicks": ["id"],
    "stg_google_ads__ads": ["id"],
    "stg_google_ads__ad_groups": ["id"],
    "stg_google_ads__campaigns": ["id"],
    "stg_google_analytics__sessions": ["session_id"],
    "stg_web_visits": ["id"],
    "stg_customers": ["id", "email"],
    "stg_order_items": ["id", "order_id"],
    "stg_orders": ["id", "user_id"],
    "stg_products": ["id"],
    "int_customer__enriched": ["id"],
    "int_product__enriched": ["id"],
    "int_order_items__enriched": ["id"],
    "int_order__enriched": ["id"],
    "int_session__marketing_channel_classification": ["session_id"],
    "agg_channel": ["id", "channel_grouping"],
    "agg_customer_demographics": ["id"],
    "agg_customer_lifetime_value": ["id"],
    "agg_inventory": ["id"],
    "agg_marketing": ["id"],
    "agg_products": ["id"],
    "agg_transactions": ["id"],
    "dim_customers": ["id"],
    "dim_date": ["date"],
    "dim_order_items": ["id"],
    "dim_orders": ["id"],
    "dim_products": ["id"],
    "fct_marketing": ["channel_grouping"],
    "fct_visits": ["visit_id"],
}
# Every not-null column is also unique, apart from these.
NOT_UNIQUE = {
    ("stg_customers", "email"),
    ("stg_order_items", "order_id"),
    ("stg_orders", "user_id"),
    ("agg_channel", "channel_grouping"),
    ("fct_marketing", "channel_grouping"),
}
POSITIVE = {
    "stg_stripe__payments": ["amount"],
    "stg_stripe__refunds": ["amount"],
    "stg_facebook_ads__ads": ["impressions", "clicks", "spend"],
    "stg_google_ads__clicks": ["impressions", "clicks", "cost"],
    "stg_exchange_rates": ["rate"],
    "stg_order_items": ["quantity", "unit_price"],
    "stg_products": ["price", "unit_cost"],
    "agg_channel": ["spend", "attributed_orders", "attributed_gross_revenue", "attributed_cogs", "gross_roas"],
    "agg_customer_lifetime_value": ["lifetime_gross_revenue", "projected_value_5y"],
    "agg_marketing": ["spend"],
    "agg_products": ["price"],
    "dim_products": ["price"],
    "fct_marketing": ["impressions", "clicks", "spend"],
    "fct_transactions": ["gross_revenue", "cogs", "gross_cost"],
}
RANGES = [
    ("dim_date", "month_number", 1, 12),
    ("dim_date", "quarter", 1, 4),
    ("dim_date", "day_of_month", 1, 31),
    ("dim_date", "fiscal_quarter", 1, 4),
    ("fct_marketing", "ctr", 0, 1),
]
ACCEPTED = [
    ("stg_stripe__payments", "status", ["succeeded", "pending", "failed"]),
    ("stg_orders", "status", ["completed", "refunded", "cancelled"]),
    ("dim_orders", "status", ["completed", "refunded", "cancelled"]),
]
COMBINATIONS = [
    ("stg_exchange_rates", ["date", "base_currency", "target_currency"]),
    ("int_marketing__combined", ["platform", "ad_id", "date"]),
    ("int_marketing__channel_classification", ["platform", "campaign_id"]),
]
EXPRESSIONS = [
    ("agg_customer_lifetime_value", "abs(lifetime_value - (lifetime_gross_revenue - lifetime_refund_amount)) < 0.01"),
    ("dim_date", "date >= week_start_date and date <= week_end_date"),
    ("dim_date", "datediff(week_end_date, week_start_date) = 6"),
    ("fct_transactions", "net_revenue <= gross_revenue"),
    ("fct_transactions", "contribution_margin <= net_revenue + 0.0001"),
    ("fct_transactions", "refund_amount >= 0"),
]
RELATIONSHIPS = [
    ("agg_transactions", "customer_id", "dim_customers"),
    ("dim_order_items", "order_id", "dim_orders"),
    ("dim_order_items", "product_id", "dim_products"),
    ("dim_orders", "customer_id", "dim_customers"),
    ("fct_transactions", "customer_id", "dim_customers"),
    ("fct_transactions", "product_id", "dim_products"),
    ("fct_transactions", "order_id", "dim_orders"),
    ("fct_visits", "customer_id", "dim_customers"),
]
AT_LEAST_ONE = [("dim_customers", "id"), ("fct_transactions", "order_item_id")]
ACTIVE_CAMPAIGNS = ("stg_google_ads__campaigns", "status", "active")
CAMPAIGN_TYPES = ["search", "shopping", "display"]


def _local(name: str, table: str, column: str, condition, *args) -> Check:
    return Check(name, table, column, ERROR, violates=partial(condition, *args))


def _found(name: str, table: str, column: str, operator, *args, severity: str = ERROR) -> Check:
    return Check(name, table, column, severity, find=lambda tables: operator(tables[table], *args))


def _orphans(table: str, column: str, parent: str) -> Check:
    return Check(
        "relationships", table, column,
        find=lambda tables: q.relationships(tables[table], column, tables[parent], "id"),
    )


def _is_false(expression: str):
    return ~F.expr(expression)


def source_checks() -> list[Check]:
    """Re-delivered and conflicting keys; both only warn."""
    checks = []
    for name, table in RAW_TABLES.items():
        keys = list(table.keys)
        label = ",".join(keys)
        checks.append(
            _found("unique_combination_of_columns", name, label, q.unique_combination_of_columns, keys, severity=WARN)
        )
        checks.append(_found("no_conflicting_duplicates", name, label, q.no_conflicting_duplicates, keys, severity=WARN))
    return checks


def model_checks() -> list[Check]:
    checks = []
    for table, columns in NOT_NULL.items():
        for column in columns:
            checks.append(_local("not_null", table, column, q.is_missing, column))
            if (table, column) not in NOT_UNIQUE:
                checks.append(_found("unique", table, column, q.unique, column))
    for table, columns in POSITIVE.items():
        checks += [_local("positive_value", table, column, q.is_negative, column) for column in columns]
    checks += [_local("range_check", t, c, q.is_outside, c, low, high) for t, c, low, high in RANGES]
    checks += [_found("accepted_values", t, c, q.accepted_values, c, values) for t, c, values in ACCEPTED]
    checks += [
        _found("unique_combination_of_columns", t, ",".join(c), q.unique_combination_of_columns, c)
        for t, c in COMBINATIONS
    ]
    checks += [_local("expression_is_true", t, e, _is_false, e) for t, e in EXPRESSIONS]
    checks += [_orphans(*relation) for relation in RELATIONSHIPS]
    checks += [_found("at_least_one", t, c, q.at_least_one, c) for t, c in AT_LEAST_ONE]
    table, status, active = ACTIVE_CAMPAIGNS
    checks.append(_found("unique_if_active", table, "name", q.unique_if_active, "name", status, active))
    checks.append(
        _local(
            "accepted_values_if_status", table, "campaign_type", q.is_not_one_of_if, "campaign_type", CAMPAIGN_TYPES,
            status, active,
        )
    )
    checks.append(
        _local(
            "not_null_if_active", "int_order__transactions", "payment_date", q.is_missing_if, "payment_date",
            "payment_status", "succeeded",
        )
    )
    return checks


def freshness_report(raw: dict[str, DataFrame], as_of) -> DataFrame:
    """Load age of every source against its own thresholds."""
    reports = [
        freshness(df, name, LOADED_AT, as_of, RAW_TABLES[name].warn_hours, RAW_TABLES[name].error_hours)
        for name, df in raw.items()
    ]
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report
