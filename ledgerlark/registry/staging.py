"""Scans, staging and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions.keys import surrogate_key
from ledgerlark.functions.money import cents_to_currency, pct_change, safe_divide
from ledgerlark.functions.text import parse_click_id, regexp_contains, safe_cast_integer
from ledgerlark.operators import dedup
from ledgerlark.operators.privacy import source_profile
from ledgerlark.operators.staging import stage, typed
from ledgerlark.registry.base import Tables, query
from ledgerlark.registry.models import click_id, div
from ledgerlark.session import scratch_path
from ledgerlark.sources.files import read_csv, write_csv
from ledgerlark.sources.schemas import LOADED_AT, RAW_TABLES


@query(
    "scan_typed_csv",
    """SELECT id, first_name, last_name, email, country_code, created_at, _fivetran_synced FROM raw_customers""",
)
def scan_typed_csv(t: Tables):
    path = scratch_path(t.spark, "customers-csv")
    write_csv(t["raw_customers"], path)
    return read_csv(t.spark, path, RAW_TABLES["prod_customers"].schema)


@query(
    "stg_typed",
    """SELECT id, user_id, order_date, status, currency_code, NULLIF(gclid, '') AS gclid,
              _fivetran_synced AS _loaded_at FROM raw_orders""",
)
def stg_typed(t: Tables):
    return typed(t["raw_orders"], "prod_orders")


@query(
    "stg_payments",
    """SELECT id, order_id, CAST(CAST(amount AS DECIMAL(10,2)) AS DOUBLE) AS amount, UPPER(currency) AS currency,
              status, created_at, MAX(_fivetran_synced) AS _loaded_at
       FROM raw_payments_redelivered
       WHERE id IN (SELECT id FROM raw_payments_redelivered GROUP BY id HAVING COUNT(DISTINCT amount) = 1)
       GROUP BY ALL""",
)
def stg_payments(t: Tables):
    return stage(t["raw_payments_redelivered"], "stripe_payments")


@query(
    "dedup_source",
    """SELECT id, any_value(visited_at) AS visited_at, any_value(customer_id) AS customer_id,
              any_value(gclid) AS gclid, any_value(landing_page) AS landing_page,
              any_value(device_category) AS device_category, max(_fivetran_synced) AS _fivetran_synced
       FROM raw_visits_redelivered WHERE id IS NOT NULL GROUP BY id
       HAVING count(DISTINCT (visited_at, customer_id, gclid, landing_page, device_category)) = 1
       UNION ALL
       SELECT * FROM raw_visits_redelivered WHERE id IS NULL""",
)
def dedup_source(t: Tables):
    return dedup.dedup_source(t["raw_visits_redelivered"], ["id"])


@query(
    "latest_per_key",
    """SELECT user_id, event_id, ts, event_type FROM events
       QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_key(t: Tables):
    events = t["events"].select("user_id", "event_id", "ts", "event_type")
    return dedup.latest_per_key(events, ["user_id"], [F.col("ts"), F.col("event_id")])


@query(
    "surrogate_key",
    """SELECT id, md5(CAST(id AS VARCHAR) || '-' || COALESCE(gclid, '_dbt_utils_surrogate_key_null_')) AS row_key
       FROM raw_orders""",
)
def surrogate_keys(t: Tables):
    return t["raw_orders"].select("id", surrogate_key(F.col("id"), F.col("gclid")).alias("row_key"))


@query("parse_click_id", f"SELECT id, gclid, CAST({click_id('gclid')} AS BIGINT) AS ad_id FROM raw_orders")
def parse_click_ids(t: Tables):
    return t["raw_orders"].select("id", "gclid", parse_click_id(F.col("gclid")).alias("ad_id"))


_TOKENS = "CASE event_id % 4 WHEN 0 THEN CAST(event_id AS {s}) WHEN 1 THEN '12.7' WHEN 2 THEN '99999999999' ELSE props END"


@query(
    "safe_cast_integer",
    f"""SELECT event_id, CAST(CASE WHEN regexp_matches(token, '^-?[0-9]+$') THEN TRY_CAST(token AS INTEGER) END
                              AS BIGINT) AS number
        FROM (SELECT event_id, {_TOKENS.format(s="VARCHAR")} AS token FROM events)""",
)
def safe_cast_integers(t: Tables):
    token = F.expr(_TOKENS.format(s="STRING"))
    return t["events"].select("event_id", safe_cast_integer(token).alias("number"))


@query(
    "regex_contains",
    """SELECT p_partkey, p_name, regexp_matches(p_name, '(widget|bolt)') AS matched,
              regexp_matches(p_name, 'ring|red') AS alternation FROM part""",
)
def regex_contains(t: Tables):
    name = F.col("p_name")
    return t["part"].select(
        "p_partkey", "p_name",
        regexp_contains(name, "(widget|bolt)").alias("matched"),
        regexp_contains(name, "ring|red").alias("alternation"),
    )


@query(
    "safe_divide",
    f"""SELECT o_orderkey, {div("CAST(o_totalprice AS DECIMAL(12,2))", "o_custkey % 7")} AS ratio FROM orders""",
)
def safe_divides(t: Tables):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return t["orders"].select("o_orderkey", safe_divide(price, F.col("o_custkey") % 7).alias("ratio"))


@query(
    "minor_units",
    """SELECT o_orderkey, CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) * CAST(0.01 AS DECIMAL(3,2))
                               AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders""",
)
def minor_units(t: Tables):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t["orders"].select("o_orderkey", cents_to_currency(cents).alias("amount"))


@query(
    "pct_change_monthly",
    f"""SELECT month, CAST(revenue AS DOUBLE) AS revenue,
               {div("revenue - previous", "previous")} AS change
        FROM (SELECT month, revenue, LAG(revenue) OVER (ORDER BY month) AS previous
              FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                           SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS revenue FROM orders GROUP BY 1))""",
)
def pct_change_monthly(t: Tables):
    monthly = (
        t["orders"]
        .groupBy(F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("revenue"))
    )
    # Months are joined to their successor rather than lined up in one window.
    previous = monthly.select(F.add_months("month", 1).alias("month"), F.col("revenue").alias("previous"))
    return monthly.join(previous, "month", "left").select(
        "month", "revenue", pct_change(F.col("revenue"), F.col("previous")).alias("change")
    )


@query(
    "source_profile",
    """WITH s AS (SELECT * FROM raw_customers ORDER BY ALL LIMIT 3),
       cells AS (
         SELECT 0 AS position, 'id' AS "column", 'bigint' AS type, CAST(id AS VARCHAR) AS value FROM s
         UNION ALL SELECT 1, 'first_name', 'string', CASE WHEN first_name IS NOT NULL THEN '[REDACTED]' END FROM s
         UNION ALL SELECT 2, 'last_name', 'string', CASE WHEN last_name IS NOT NULL THEN '[REDACTED]' END FROM s
         UNION ALL SELECT 3, 'email', 'string', CASE WHEN email IS NOT NULL THEN '[REDACTED]' END FROM s
         UNION ALL SELECT 4, 'country_code', 'string', country_code FROM s
         UNION ALL SELECT 5, 'created_at', 'date', CAST(created_at AS VARCHAR) FROM s)
       SELECT CAST(position AS BIGINT) AS position, "column", type, string_agg(value, '|' ORDER BY value) AS samples
       FROM cells GROUP BY position, "column", type""",
)
def source_profiles(t: Tables):
    profile = source_profile(t["raw_customers"].drop(LOADED_AT))
    return profile.withColumn("samples", F.nullif(F.array_join("samples", "|"), F.lit("")))


def _staged_sql(binding: str, source: str) -> str:
    """One row per key whose copies agree, none where they don't, and rows without a key as they are."""
    types, rename = RAW_TABLES[source].types, RAW_TABLES[source].rename
    (key,) = RAW_TABLES[source].keys
    own = [c for c in types if c not in (key, LOADED_AT)]

    def shown(column: str, value: str) -> str:
        kind = types[column]
        if kind.startswith("decimal"):
            value = f"CAST(CAST({value} AS DECIMAL(10,2)) AS DOUBLE)"
        elif kind == "int":
            value = f"CAST({value} AS BIGINT)"
        return f"{value} AS {'_loaded_at' if column == LOADED_AT else rename.get(column, column)}"

    agreed = ", ".join([shown(key, key), *[shown(c, f"any_value({c})") for c in own], shown(LOADED_AT, f"max({LOADED_AT})")])
    plain = ", ".join(shown(c, c) for c in types)
    return f"""SELECT {agreed} FROM {binding} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(DISTINCT ({", ".join(own)})) = 1
               UNION ALL SELECT {plain} FROM {binding} WHERE {key} IS NULL"""


# The sources that no other query stages, each as it lands: copies, conflicts and rows without a key.
LANDED = {
    "sessions": "google_analytics_sessions",
    "gads_campaigns": "google_ads_campaigns",
    "gads_ad_groups": "google_ads_ad_groups",
    "gads_ads": "google_ads_ads",
    "gads_clicks": "google_ads_clicks",
    "fb_campaigns": "facebook_ads_campaigns",
    "fb_ad_sets": "facebook_ads_ad_sets",
    "fb_ads": "facebook_ads_ads",
}

for _name, _source in LANDED.items():
    query(f"stg_{_name}", _staged_sql(f"raw_landed_{_name}", _source))(
        lambda t, name=_name, source=_source: stage(t[f"raw_landed_{name}"], source)
    )
