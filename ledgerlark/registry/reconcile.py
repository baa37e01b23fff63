"""Comparing versions, quarantine and privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.operators import dedup, privacy, reconcile
from ledgerlark.operators.quality import unique_combination_of_columns
from ledgerlark.operators.quarantine import QuarantineTable
from ledgerlark.registry.base import Tables, query
from ledgerlark.registry.quality import KEYS
from ledgerlark.session import scratch_path
from ledgerlark.sources.files import freeze

_EXCEPT = "SELECT * FROM {a} EXCEPT ALL SELECT * FROM {b}"
_PARTS = _EXCEPT.format(a="raw_prices_first", b="raw_prices_second")
_PARTS_BACK = _EXCEPT.format(a="raw_prices_second", b="raw_prices_first")


@query(
    "table_diff",
    f"""SELECT 'prices' AS "table", (SELECT COUNT(*) FROM raw_prices_first) AS rows_a,
               (SELECT COUNT(*) FROM raw_prices_second) AS rows_b, (SELECT COUNT(*) FROM ({_PARTS})) AS only_a,
               (SELECT COUNT(*) FROM ({_PARTS_BACK})) AS only_b, '' AS columns_changed, 'changed' AS status
        UNION ALL
        SELECT 'visits', (SELECT COUNT(*) FROM raw_visits), (SELECT COUNT(*) FROM raw_visits_redelivered),
               (SELECT COUNT(*) FROM ({_EXCEPT.format(a="raw_visits", b="raw_visits_redelivered")})),
               (SELECT COUNT(*) FROM ({_EXCEPT.format(a="raw_visits_redelivered", b="raw_visits")})), '', 'changed'
        UNION ALL
        SELECT 'items', COUNT(*), COUNT(*), 0, 0, '', 'same' FROM lineitem""",
)
def table_diff(t: Tables):
    before = {"prices": t["raw_prices_first"], "visits": t["raw_visits"], "items": t["lineitem"]}
    after = {"prices": t["raw_prices_second"], "visits": t["raw_visits_redelivered"], "items": t["lineitem"]}
    return reconcile.diff_tables(before, after)


@query(
    "frozen_diff",
    f"""SELECT 'orders' AS "table", (SELECT COUNT(*) FROM raw_orders) AS rows_a,
               (SELECT COUNT(*) FROM raw_orders_faulty) AS rows_b,
               (SELECT COUNT(*) FROM ({_EXCEPT.format(a="raw_orders", b="raw_orders_faulty")})) AS only_a,
               (SELECT COUNT(*) FROM ({_EXCEPT.format(a="raw_orders_faulty", b="raw_orders")})) AS only_b,
               '' AS columns_changed, 'changed' AS status
        UNION ALL SELECT 'customers', COUNT(*), COUNT(*), 0, 0, '', 'same' FROM customer""",
)
def frozen_diff(t: Tables):
    """Two stored versions of the same views, compared table by table."""
    clean = {"orders": t["raw_orders"], "customers": t["raw_customers"]}
    before = freeze(clean, scratch_path(t.spark, "clean"))
    after = freeze({**clean, "orders": t["raw_orders_faulty"]}, scratch_path(t.spark, "faulty"))
    return reconcile.diff_tables(before, after)


@query(
    "row_diff",
    f"""SELECT 'a' AS only_in, COUNT(*) AS copies, id, CAST(price AS DOUBLE) AS price FROM ({_PARTS}) GROUP BY id, price
        UNION ALL SELECT 'b', COUNT(*), id, CAST(price AS DOUBLE) FROM ({_PARTS_BACK}) GROUP BY id, price""",
)
def row_diff(t: Tables):
    return reconcile.row_diff(t["raw_prices_first"], t["raw_prices_second"])


@query(
    "row_loss",
    """SELECT * FROM (
         SELECT 'rates' AS "table", (SELECT COUNT(*) FROM raw_rates) AS rows_before,
                (SELECT COUNT(*) FROM raw_rates_second) AS rows_after,
                (SELECT COUNT(*) FROM raw_rates) - (SELECT COUNT(*) FROM raw_rates_second) AS rows_lost
         UNION ALL SELECT 'visits', (SELECT COUNT(*) FROM raw_visits), (SELECT COUNT(*) FROM raw_visits_redelivered),
                (SELECT COUNT(*) FROM raw_visits) - (SELECT COUNT(*) FROM raw_visits_redelivered))
       WHERE rows_lost > 0""",
)
def row_loss(t: Tables):
    return reconcile.row_loss(
        {"rates": t["raw_rates"], "visits": t["raw_visits"]},
        {"rates": t["raw_rates_second"], "visits": t["raw_visits_redelivered"]},
    )


@query(
    "version_counts",
    """SELECT 'clean' AS version, COUNT(*) AS rows FROM raw_orders
       UNION ALL SELECT 'faulty', COUNT(*) FROM raw_orders_faulty""",
)
def version_counts(t: Tables):
    return reconcile.version_counts({"clean": t["raw_orders"], "faulty": t["raw_orders_faulty"]})


@query(
    "quarantine_report",
    """SELECT 'stripe_payments' AS source, COUNT(CASE WHEN n > 1 THEN 1 END) AS duplicate_keys,
              COUNT(CASE WHEN v > 1 THEN 1 END) AS conflicting_keys,
              CAST(COALESCE(SUM(CASE WHEN v > 1 THEN n END), 0) AS BIGINT) AS conflicting_rows
       FROM (SELECT id, COUNT(*) AS n, COUNT(DISTINCT amount) AS v FROM raw_payments_redelivered GROUP BY id)
       UNION ALL
       SELECT 'prod_web_visits', COUNT(CASE WHEN n > 1 THEN 1 END), COUNT(CASE WHEN v > 1 THEN 1 END),
              CAST(COALESCE(SUM(CASE WHEN v > 1 THEN n END), 0) AS BIGINT)
       FROM (SELECT id, COUNT(*) AS n, COUNT(DISTINCT landing_page) AS v FROM raw_visits_redelivered
             WHERE id IS NOT NULL GROUP BY id)""",
)
def quarantine_report(t: Tables):
    return dedup.quarantine_report(
        {
            "stripe_payments": (t["raw_payments_redelivered"], ["id"]),
            "prod_web_visits": (t["raw_visits_redelivered"], ["id"]),
        }
    )


def _quarantined(t: Tables, binding: str, source: str):
    keys = dedup.conflicting_keys(t[binding], ["id"])
    return keys.select(F.lit(source).alias("source"), F.col("id").cast("string").alias("key"))


@query(
    "quarantine_transition",
    """WITH payments AS (SELECT id FROM raw_payments_redelivered GROUP BY id HAVING COUNT(DISTINCT amount) > 1),
            visits AS (SELECT id FROM raw_visits_redelivered WHERE id IS NOT NULL GROUP BY id
                       HAVING COUNT(DISTINCT landing_page) > 1),
            half AS (SELECT id FROM visits WHERE id % 2 = 0)
       SELECT 'payments' AS source, 0 AS keys_before, (SELECT COUNT(*) FROM payments) AS keys_now,
              (SELECT COUNT(*) FROM payments) AS keys_changed, 'opened' AS transition
       UNION ALL SELECT 'visits', (SELECT COUNT(*) FROM half), (SELECT COUNT(*) FROM visits),
              (SELECT COUNT(*) FROM visits) - (SELECT COUNT(*) FROM half), 'changed'
       UNION ALL SELECT 'refunds', (SELECT COUNT(*) FROM payments), 0, (SELECT COUNT(*) FROM payments), 'resolved'
       UNION ALL SELECT 'rates', (SELECT COUNT(*) FROM visits), (SELECT COUNT(*) FROM visits), 0, 'refreshed'
       UNION ALL SELECT 'sessions', (SELECT COUNT(*) FROM visits), 0, (SELECT COUNT(*) FROM visits), 'unchanged'""",
)
def quarantine_transition(t: Tables):
    payments = _quarantined(t, "raw_payments_redelivered", "payments")
    visits = _quarantined(t, "raw_visits_redelivered", "visits")

    def as_source(keys, name):
        return keys.withColumn("source", F.lit(name))

    previous = (
        visits.where(F.col("key").cast("bigint") % 2 == 0)
        .unionByName(as_source(payments, "refunds"))
        .unionByName(as_source(visits, "rates"))
        .unionByName(as_source(visits, "sessions"))
    )
    current = payments.unionByName(visits).unionByName(as_source(visits, "rates"))
    # The sessions check did not run, so it resolves nothing.
    checked = t.spark.createDataFrame(
        [("payments", "warn"), ("visits", "warn"), ("refunds", "pass"), ("rates", "warn")],
        "source string, status string",
    )
    return reconcile.quarantine_transition(previous, current, checked)


@query(
    "quarantine_runs",
    """WITH payments AS (SELECT COUNT(*) AS n FROM (SELECT id FROM raw_payments_redelivered GROUP BY id HAVING COUNT(DISTINCT amount) > 1)),
            visits AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (id % 2 = 0) AS half
                       FROM (SELECT id FROM raw_visits_redelivered WHERE id IS NOT NULL GROUP BY id
                             HAVING COUNT(DISTINCT landing_page) > 1)),
            p AS (SELECT payments.n AS p, visits.n AS v, half AS h FROM payments, visits)
       SELECT 1 AS run, 'refunds' AS source, 0 AS keys_before, p AS keys_now, p AS keys_changed, 'opened' AS transition, false AS compared FROM p
       UNION ALL SELECT 1, 'sessions', 0, v, v, 'opened', false FROM p
       UNION ALL SELECT 1, 'visits', 0, h, h, 'opened', false FROM p
       UNION ALL SELECT 2, 'payments', 0, p, p, 'opened', false FROM p
       UNION ALL SELECT 2, 'refunds', p, 0, p, 'resolved', false FROM p
       UNION ALL SELECT 2, 'sessions', v, 0, v, 'unchanged', false FROM p
       UNION ALL SELECT 2, 'visits', h, v, v - h, 'changed', true FROM p
       UNION ALL SELECT 3, 'payments', p, p, 0, 'refreshed', false FROM p
       UNION ALL SELECT 3, 'sessions', v, 0, v, 'unchanged', false FROM p
       UNION ALL SELECT 3, 'visits', v, v, 0, 'refreshed', false FROM p""",
)
def quarantine_runs(t: Tables):
    """Three runs, each against the stored one before; the third finds nothing new and compares no key."""
    payments = _quarantined(t, "raw_payments_redelivered", "payments")
    visits = _quarantined(t, "raw_visits_redelivered", "visits")
    table = QuarantineTable(t.spark, scratch_path(t.spark, "quarantine"))
    ran = t.spark.createDataFrame([("payments", "warn"), ("visits", "warn"), ("refunds", "pass")], "source string, status string")
    first = visits.where(F.col("key").cast("bigint") % 2 == 0).unionByName(payments.withColumn("source", F.lit("refunds")))
    first = first.unionByName(visits.withColumn("source", F.lit("sessions")))
    runs = [first, payments.unionByName(visits), payments.unionByName(visits)]
    reports = [table.record(keys, ran).select(F.lit(n + 1).alias("run"), "*") for n, keys in enumerate(runs)]
    return reports[0].union(reports[1]).union(reports[2])


@query(
    "duplicate_key_rows",
    f"""SELECT l.* REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem l
        JOIN (SELECT {", ".join(KEYS)} FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1) k
        USING (l_orderkey, l_linenumber)""",
)
def duplicate_key_rows(t: Tables):
    return dedup.duplicate_key_rows(t["lineitem"], KEYS)


@query(
    "deterministic_sample",
    """SELECT id, CASE WHEN first_name IS NOT NULL THEN '[REDACTED]' END AS first_name, '[REDACTED]' AS last_name,
              '[REDACTED]' AS email, country_code, created_at, _fivetran_synced
       FROM (SELECT * FROM raw_customers
             ORDER BY country_code NULLS FIRST, id, first_name, last_name, email, created_at, _fivetran_synced LIMIT 10)""",
)
def deterministic_sample(t: Tables):
    return privacy.deterministic_sample(t["raw_customers"], 10, first=("country_code",))


@query(
    "mask_pii",
    """SELECT id, CASE WHEN first_name IS NOT NULL THEN '[REDACTED]' END AS first_name,
              CASE WHEN last_name IS NOT NULL THEN '[REDACTED]' END AS last_name,
              CASE WHEN email IS NOT NULL THEN '[REDACTED]' END AS email, country_code, created_at, _fivetran_synced
       FROM raw_customers""",
)
def mask_pii(t: Tables):
    return privacy.mask_pii(t["raw_customers"])


_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query(
    "scrub_emails",
    f"""SELECT 'document' AS kind, doc_id AS id, regexp_replace(text, '{_EMAIL}', '[REDACTED]', 'g') AS text
        FROM documents
        UNION ALL SELECT 'page', page_id, regexp_replace(html, '{_EMAIL}', '[REDACTED]', 'g') FROM pages""",
)
def scrub_emails(t: Tables):
    texts = (
        t["documents"]
        .select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
        .unionByName(t["pages"].select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")))
    )
    return privacy.scrub_column(texts, "text")


_RULES = {**privacy.SECRET_PATTERNS, **privacy.TOKEN_PATTERN}


def _hits() -> str:
    return ", ".join(
        f"COUNT(CASE WHEN regexp_matches(text, '{p.replace(chr(39), chr(39) * 2)}') THEN 1 END) AS {n}"
        for n, p in _RULES.items()
    )


@query("secret_scan", f"SELECT source, COUNT(*) AS scanned, {_hits()} FROM documents GROUP BY source")
def secret_scan(t: Tables):
    return privacy.secret_scan(t["documents"], "text", "source", _RULES)


@query(
    "duplicate_keys_report",
    """SELECT id, COUNT(*) AS n_records FROM raw_payments_redelivered GROUP BY id HAVING COUNT(*) > 1""",
)
def duplicate_keys_report(t: Tables):
    return unique_combination_of_columns(t["raw_payments_redelivered"], ["id"])
