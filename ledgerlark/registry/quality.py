"""Data-quality checks on rows that contain known faults."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ledgerlark.operators import quality as q
from ledgerlark.operators.quality import WARN, Check
from ledgerlark.operators.staging import typed
from ledgerlark.plans.checks import freshness_report
from ledgerlark.registry.base import Tables, query
from ledgerlark.registry.models import big, dbl
from ledgerlark.registry.revenue import customers, fct
from ledgerlark.session import scratch_path
from ledgerlark.sources.published import PublishedTable

STATUSES = ["completed", "refunded", "cancelled"]
KEYS = ["l_orderkey", "l_linenumber"]


def faulty_orders(t: Tables):
    return typed(t["raw_orders_faulty"], "prod_orders").drop("_loaded_at")


def faulty_items(t: Tables):
    return typed(t["raw_items_faulty"], "prod_order_items").drop("_loaded_at")


_ORDERS = "SELECT id, user_id, order_date, status, currency_code, NULLIF(gclid, '') AS gclid FROM raw_orders_faulty"
_ITEMS = f"""SELECT id, order_id, product_id, {big("quantity")} AS quantity, {dbl("unit_price")} AS unit_price
    FROM raw_items_faulty"""


@query("dq_not_null", f"{_ORDERS} WHERE user_id IS NULL")
def dq_not_null(t: Tables):
    return q.not_null(faulty_orders(t), "user_id")


@query(
    "dq_unique",
    """SELECT id AS unique_field, COUNT(*) AS n_records FROM raw_orders_faulty WHERE id IS NOT NULL
       GROUP BY id HAVING COUNT(*) > 1""",
)
def dq_unique(t: Tables):
    return q.unique(faulty_orders(t), "id")


@query("dq_positive", f"{_ITEMS} WHERE quantity < 0")
def dq_positive(t: Tables):
    return q.positive_value(faulty_items(t), "quantity")


@query(
    "dq_unique_combo",
    f"""SELECT {", ".join(KEYS)}, COUNT(*) AS n_records FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
)
def dq_unique_combo(t: Tables):
    return q.unique_combination_of_columns(t["lineitem"], KEYS).withColumn("l_linenumber", F.col("l_linenumber"))


_LINE_VERSION = """(l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
    l_shipdate)"""


@query(
    "dq_conflicts",
    f"""SELECT l.* REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem l
        JOIN (SELECT {", ".join(KEYS)} FROM lineitem GROUP BY ALL
              HAVING COUNT(DISTINCT {_LINE_VERSION}) > 1) k USING (l_orderkey, l_linenumber)""",
)
def dq_conflicts(t: Tables):
    return q.no_conflicting_duplicates(t["lineitem"], KEYS)


@query(
    "fk_orphans",
    f"""{_ORDERS} WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer)""",
)
def fk_orphans(t: Tables):
    return q.relationships(faulty_orders(t), "user_id", t["customer"], "c_custkey")


@query(
    "dq_expression",
    f"""{_ITEMS} WHERE NOT (quantity * unit_price > 0 AND quantity <= 100)""",
)
def dq_expression(t: Tables):
    return q.expression_is_true(faulty_items(t), "quantity * unit_price > 0 AND quantity <= 100")


@query("dq_range", f"{_ITEMS} WHERE quantity < 1 OR quantity > 50")
def dq_range(t: Tables):
    return q.range_check(faulty_items(t), "quantity", 1, 50)


@query(
    "dq_accepted_values",
    """SELECT status AS value_field, COUNT(*) AS n_records FROM raw_orders_faulty
       WHERE status NOT IN ('completed', 'refunded', 'cancelled') GROUP BY status""",
)
def dq_accepted_values(t: Tables):
    return q.accepted_values(faulty_orders(t), "status", STATUSES)


@query(
    "dq_at_least_one",
    """SELECT status, filled FROM (
         SELECT 'all' AS status, COUNT(gclid) AS filled FROM raw_orders_faulty
         UNION ALL SELECT 'none', COUNT(CASE WHEN id IS NULL THEN currency_code END) FROM raw_orders_faulty)
       WHERE filled = 0""",
)
def dq_at_least_one(t: Tables):
    orders = faulty_orders(t)
    filled = q.at_least_one(orders, "gclid").select(F.lit("all").alias("status"), "filled")
    # Rows without an id never carry a currency: that column is entirely empty there.
    empty = q.at_least_one(orders.where(F.col("id").isNull()), "currency_code")
    return filled.unionByName(empty.select(F.lit("none").alias("status"), "filled"))


@query("dq_accepted_if", f"{_ORDERS} WHERE status = 'completed' AND currency_code NOT IN ('GBP', 'EUR', 'USD')")
def dq_accepted_if(t: Tables):
    return q.accepted_values_if_status(
        faulty_orders(t), "currency_code", ["GBP", "EUR", "USD"], "status", "completed"
    )


@query(
    "dq_unique_if",
    """SELECT gclid AS unique_field, COUNT(*) AS n_records FROM raw_orders_faulty
       WHERE status = 'completed' AND NULLIF(gclid, '') IS NOT NULL GROUP BY gclid HAVING COUNT(*) > 1""",
)
def dq_unique_if(t: Tables):
    return q.unique_if_active(faulty_orders(t), "gclid", "status", "completed")


@query("dq_not_null_if", f"{_ORDERS} WHERE status = 'completed' AND user_id IS NULL")
def dq_not_null_if(t: Tables):
    return q.not_null_if_active(faulty_orders(t), "user_id", "status", "completed")


AS_OF = datetime(2001, 8, 3)


@query(
    "source_freshness",
    """SELECT source, max_loaded_at, age_hours,
              CASE WHEN age_hours >= error_after THEN 'error' WHEN age_hours >= warn_after THEN 'warn'
                   ELSE 'pass' END AS status
       FROM (SELECT source, max_loaded_at, warn_after, error_after,
                    date_sub('hour', max_loaded_at, TIMESTAMP '2001-08-03 00:00:00') AS age_hours
             FROM (SELECT 'prod_orders' AS source, MAX(_fivetran_synced) AS max_loaded_at, 24 AS warn_after,
                          48 AS error_after FROM raw_orders
                   UNION ALL SELECT 'stripe_payments', MAX(_fivetran_synced), 24, 48 FROM raw_payments
                   UNION ALL SELECT 'stripe_refunds', MAX(_fivetran_synced), 24, 48 FROM raw_refunds
                   UNION ALL SELECT 'exchange_rates', MAX(_fivetran_synced), 24, 48 FROM raw_rates
                   UNION ALL SELECT 'prod_web_visits', MAX(_fivetran_synced), 2, 6 FROM raw_visits))""",
)
def source_freshness(t: Tables):
    raw = {
        "prod_orders": t["raw_orders"],
        "stripe_payments": t["raw_payments"],
        "stripe_refunds": t["raw_refunds"],
        "exchange_rates": t["raw_rates"],
        "prod_web_visits": t["raw_visits"],
    }
    return freshness_report(raw, F.lit(AS_OF))


def _checks() -> list[Check]:
    return [
        Check("not_null", "orders", "user_id", violates=lambda: q.is_missing("user_id")),
        Check("not_null", "orders", "id", violates=lambda: q.is_missing("id")),
        # Counted by value, as the declared checks of the plans are.
        Check("accepted_values", "orders", "status", find=lambda tables: q.accepted_values(tables["orders"], "status", STATUSES)),
        Check("unique", "orders", "id", WARN, find=lambda tables: q.unique(tables["orders"], "id")),
        Check(
            "relationships", "orders", "user_id",
            find=lambda tables: q.relationships(tables["orders"], "user_id", tables["customers"], "id"),
        ),
        Check("positive_value", "items", "quantity", violates=lambda: q.is_negative("quantity")),
        Check("positive_value", "items", "unit_price", violates=lambda: q.is_negative("unit_price")),
        Check("range_check", "items", "quantity", violates=lambda: q.is_outside("quantity", 1, 50)),
        Check("expression_is_true", "fct", "refund_amount", violates=lambda: F.col("refund_amount") < 0),
        Check(
            "expression_is_true", "fct", "net_revenue",
            violates=lambda: ~(F.col("net_revenue") <= F.col("gross_revenue")),
        ),
    ]


def _tables(t: Tables):
    return {"orders": faulty_orders(t), "items": faulty_items(t), "customers": customers(t), "fct": fct(t)}


_FAILURES = """
    SELECT 'not_null' AS "check", 'orders' AS "table", 'user_id' AS "column", 'error' AS severity,
           COUNT(*) AS failures FROM raw_orders_faulty WHERE user_id IS NULL
    UNION ALL SELECT 'not_null', 'orders', 'id', 'error', COUNT(*) FROM raw_orders_faulty WHERE id IS NULL
    UNION ALL SELECT 'accepted_values', 'orders', 'status', 'error', COUNT(DISTINCT status) FROM raw_orders_faulty
              WHERE status NOT IN ('completed', 'refunded', 'cancelled')
    UNION ALL SELECT 'unique', 'orders', 'id', 'warn', COUNT(*)
              FROM (SELECT id FROM raw_orders_faulty WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1)
    UNION ALL SELECT 'relationships', 'orders', 'user_id', 'error', COUNT(*) FROM raw_orders_faulty
              WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'positive_value', 'items', 'quantity', 'error', COUNT(*) FROM raw_items_faulty WHERE quantity < 0
    UNION ALL SELECT 'positive_value', 'items', 'unit_price', 'error', COUNT(*) FROM raw_items_faulty WHERE unit_price < 0
    UNION ALL SELECT 'range_check', 'items', 'quantity', 'error', COUNT(*) FROM raw_items_faulty
              WHERE quantity < 1 OR quantity > 50
    UNION ALL SELECT 'expression_is_true', 'fct', 'refund_amount', 'error', COUNT(*) FROM m_fct WHERE refund_amount < 0
    UNION ALL SELECT 'expression_is_true', 'fct', 'net_revenue', 'error', COUNT(*) FROM m_fct
              WHERE NOT (net_revenue <= gross_revenue)"""


@query(
    "dq_summary",
    f"""SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
        FROM ({_FAILURES})""",
)
def dq_summary(t: Tables):
    return q.run_checks(_tables(t), _checks())


@query(
    "dq_store_failures",
    """SELECT 'not_null' AS "check", 'orders' AS "table", id, COUNT(*) AS n FROM raw_orders_faulty
       WHERE user_id IS NULL GROUP BY id
       UNION ALL SELECT 'accepted_values', 'orders', id, COUNT(*) FROM raw_orders_faulty
       WHERE status NOT IN ('completed', 'refunded', 'cancelled') GROUP BY id
       UNION ALL SELECT 'positive_value', 'items', id, COUNT(*) FROM raw_items_faulty WHERE quantity < 0 GROUP BY id""",
)
def dq_store_failures(t: Tables):
    """Failures written per check, read back and counted by the row's id."""
    by_row = Check("accepted_values", "orders", "status", violates=lambda: q.is_not_one_of("status", STATUSES))
    checks = [_checks()[0], by_row, _checks()[5]]
    tables = {"orders": faulty_orders(t), "items": faulty_items(t)}
    stored = q.store_failures(tables, checks, scratch_path(t.spark, "failures"))
    row_id = F.get_json_object("row", "$.id").cast("bigint").alias("id")
    return stored.groupBy("check", "table", row_id).agg(F.count(F.lit(1)).alias("n"))


@query(
    "gated_publish",
    f"""SELECT 'items' AS name, COUNT(*) AS failures, COUNT(*) = 0 AS published FROM raw_items_faulty WHERE quantity < 0
        UNION ALL SELECT 'clean_items', COUNT(*), COUNT(*) = 0 FROM raw_items WHERE quantity < 0""",
)
def gated_publish(t: Tables):
    """A table with a failing check is held back, a clean one is published."""
    outcome = []
    for name, df in (("items", faulty_items(t)), ("clean_items", typed(t["raw_items"], "prod_order_items"))):
        check = Check("positive_value", name, "quantity", violates=lambda: q.is_negative("quantity"))
        published, summary = q.publish_version_if_clean(df, name, [check], PublishedTable(t.spark, scratch_path(t.spark, name)))
        outcome.append((name, sum(row["failures"] for row in summary), published))
    return t.spark.createDataFrame(outcome, "name string, failures bigint, published boolean")
