"""Raw tables derived from the driver tables.

Each binding is one statement that both Spark and the checking engine
understand, so both sides start from the same rows. ``{name}`` stands for a
driver table or another binding.
"""

from __future__ import annotations

from ledgerlark.operators.taxonomy import DEFAULT_RULES
from ledgerlark.sources.schemas import RAW_TABLES


def _ids(count: int) -> str:
    return ", ".join(f"({i})" for i in range(1, count + 1))


def _cases(subject: str, values: list[str | None]) -> str:
    whens = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else chr(39) + v + chr(39)}" for i, v in enumerate(values)
    )
    return f"CASE {subject} {whens} END"


# (source, medium, campaign) of a session, picked by event id.
SESSION_KINDS: list[tuple[str | None, str | None, str | None]] = [
    ("mailer", "email", "newsletter-garden-tips"),
    ("affiliate", "blog", "affiliate-craft-partner"),
    ("cj", "links", "cj-autumn-impact"),
    ("direct", "none", "(direct)"),
    ("google", "display", "anything"),
    (None, "cpc", "google-brand-search"),
    ("google", "organic", None),
    ("bing", "non", "brand"),
    ("instagram", "cpc", "story"),
    ("facebook", "organic", "post"),
    ("partner.example", "referral", None),
    ("Google", "Brand", "Upper-Case"),
]



def _redelivered(base: str, source: str, changed: str, expression: str) -> str:
    """A source as it lands: identical copies, conflicting copies and rows without a key besides the rows themselves."""
    names = list(RAW_TABLES[source].types)
    first, *rest, loaded = names

    def rows(where: str, **other: str) -> str:
        return f"SELECT {', '.join(f'{other[n]} AS {n}' if n in other else n for n in names)} FROM {{{base}}} WHERE {where}"

    return " UNION ALL ".join(
        [
            f"SELECT {', '.join(names)} FROM {{{base}}}",
            rows(f"{first} % 10 = 0", **{loaded: f"{loaded} + INTERVAL '1' DAY"}),
            rows(f"{first} % 17 = 0", **{changed: expression}),
            rows(f"{first} % 25 = 0", **{first: "CAST(NULL AS BIGINT)"}),
        ]
    )


_STATUS = "CASE {0} % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'paused' ELSE 'removed' END"
_LOADED = "TIMESTAMP '2024-02-01 06:00:00' AS _fivetran_synced"

CURRENCY = "CASE o_custkey % 5 WHEN 0 THEN 'GBP' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' WHEN 3 THEN 'JPY' ELSE 'CAD' END"

BINDINGS = {
    "raw_countries": """
        SELECT n_name AS country_name, concat('N', CAST(n_nationkey AS STRING)) AS alpha_2, r_name AS region,
               concat(r_name, ' ', CAST(n_nationkey % 2 AS STRING)) AS sub_region,
               CASE n_nationkey % 3 WHEN 0 THEN 'GBP' WHEN 1 THEN 'EUR' ELSE 'USD' END AS currency_code,
               concat('Zone/', CAST(n_regionkey AS STRING)) AS timezone_name
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "raw_currencies": """
        SELECT * FROM (VALUES ('GBP', 'Pound Sterling', 'GBP', 2), ('EUR', 'Euro', 'EUR', 2),
                              ('USD', 'US Dollar', '$', 2), ('JPY', 'Yen', 'JPY', 0))
               AS c(currency_code, currency_name, currency_symbol, decimal_places)""",
    "raw_customers": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS first_name,
               c_name AS last_name, concat('user', CAST(c_custkey AS STRING), '@shop.example') AS email,
               CASE WHEN c_custkey % 97 = 0 THEN 'ZZ' ELSE concat('N', CAST(c_nationkey AS STRING)) END AS country_code,
               CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS DATE) AS created_at,
               TIMESTAMP '2002-01-01 00:00:00' AS _fivetran_synced
        FROM {customer}""",
    "raw_products": """
        SELECT p_partkey AS id, p_name AS name, p_type AS category, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(40 + (p_partkey % 5) * 5 AS DECIMAL(4,0))
                    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS unit_cost,
               CASE WHEN p_partkey % 89 = 0 THEN 'XXX' ELSE 'GBP' END AS currency_code,
               CAST(DATE '1994-01-01' + CAST(p_partkey % 365 AS INT) AS DATE) AS created_at,
               TIMESTAMP '2002-01-01 00:00:00' AS _fivetran_synced
        FROM {part}""",
    "raw_orders": f"""
        SELECT o_orderkey AS id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'refunded' ELSE 'cancelled' END AS status,
               {CURRENCY} AS currency_code,
               CASE WHEN o_orderkey % 3 <> 0 THEN NULL WHEN o_orderkey % 33 = 0 THEN ''
                    WHEN o_orderkey % 21 = 0 THEN 'gclid-x-abc'
                    ELSE concat('gclid-', CAST(o_custkey % 20 AS STRING), '-', CAST(o_orderkey AS STRING))
               END AS gclid,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' DAY AS _fivetran_synced
        FROM {{orders}}""",
    "raw_items": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INT) AS quantity,
               CAST(CAST(CAST(floor(floor(l_extendedprice * 100 + 5e-1) / l_quantity) AS BIGINT) AS DECIMAL(10,0))
                    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS unit_price,
               CAST(l_shipdate AS TIMESTAMP) AS _fivetran_synced
        FROM {lineitem}""",
    # Every fortieth order is paid twice, which repeats its items in the fact.
    "raw_payments": f"""
        SELECT concat('pi_', CAST(o_orderkey AS STRING)) AS id, o_orderkey AS order_id,
               CAST(o_totalprice AS DECIMAL(12,2)) AS amount, lower({CURRENCY}) AS currency,
               CASE o_orderkey % 20 WHEN 0 THEN 'pending' WHEN 1 THEN 'failed' ELSE 'succeeded' END AS status,
               CAST(o_orderdate AS DATE) AS created_at,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' DAY AS _fivetran_synced
        FROM {{orders}} WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT concat('pj_', CAST(o_orderkey AS STRING)), o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)), 'eur',
               'succeeded', CAST(o_orderdate AS DATE), CAST(o_orderdate AS TIMESTAMP) + INTERVAL '2' DAY
        FROM {{orders}} WHERE o_orderstatus <> 'P' AND o_orderkey % 40 = 0""",
    "raw_refunds": """
        SELECT concat('re_', CAST(o_orderkey AS STRING)) AS id, concat('pi_', CAST(o_orderkey AS STRING)) AS payment_id,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS amount,
               'requested_by_customer' AS reason, CAST(CAST(o_orderdate AS DATE) + 10 AS DATE) AS created_at,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL '11' DAY AS _fivetran_synced
        FROM {orders} WHERE o_orderstatus = 'O'
        UNION ALL
        SELECT concat('rf_', CAST(o_orderkey AS STRING)), concat('pi_', CAST(o_orderkey AS STRING)),
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(3,2)) AS DECIMAL(12,2)), 'damaged',
               CAST(CAST(o_orderdate AS DATE) + 20 AS DATE), CAST(o_orderdate AS TIMESTAMP) + INTERVAL '21' DAY
        FROM {orders} WHERE o_orderstatus = 'O' AND o_orderkey % 4 = 0""",
    # No yen rate on the 13th: those payments have no reporting amount.
    "raw_rates": """
        SELECT created_at AS date, 'GBP' AS base_currency, upper(currency) AS target_currency,
               CAST((CASE currency WHEN 'eur' THEN 1170049 WHEN 'usd' THEN 1250052 WHEN 'jpy' THEN 190500050
                                   ELSE 1710050 END
                     + EXTRACT(DAY FROM created_at) * 3711 + EXTRACT(MONTH FROM created_at) * 1113)
                    * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(12,6)) AS rate,
               CAST(created_at AS TIMESTAMP) + INTERVAL '6' HOUR AS _fivetran_synced
        FROM (SELECT DISTINCT created_at, currency FROM {raw_payments}) AS days
        WHERE currency <> 'gbp' AND NOT (currency = 'jpy' AND EXTRACT(DAY FROM created_at) = 13)""",
    "raw_payments_redelivered": """
        SELECT * FROM {raw_payments}
        UNION ALL
        SELECT id, order_id, amount, currency, status, created_at, _fivetran_synced + INTERVAL '1' DAY
        FROM {raw_payments} WHERE order_id % 50 = 0
        UNION ALL
        SELECT id, order_id, CAST(amount + 1 AS DECIMAL(12,2)), currency, status, created_at, _fivetran_synced
        FROM {raw_payments} WHERE order_id % 101 = 0""",
    "raw_gads_campaigns": """
        SELECT CAST(id AS BIGINT) AS id, name, status, campaign_type
        FROM (VALUES (1, 'Google Brand Tea Pots', 'active', 'search'),
                     (2, 'Google Non-Brand Kettles', 'active', 'search'),
                     (3, 'Google Shopping Mugs', 'active', 'shopping'),
                     (4, 'Google Banner Spring Sale', 'paused', 'display'))
             AS c(id, name, status, campaign_type)""",
    "raw_gads_ad_groups": f"""
        SELECT CAST(id AS BIGINT) AS id, CAST(floor((id - 1) / 2) AS BIGINT) + 1 AS campaign_id,
               concat('Group ', CAST(id AS STRING)) AS name
        FROM (VALUES {_ids(8)}) AS g(id)""",
    "raw_gads_ads": f"""
        SELECT CAST(id AS BIGINT) AS id, CAST(floor((id - 1) / 2) AS BIGINT) + 1 AS ad_group_id,
               concat('Headline ', CAST(id AS STRING)) AS headline
        FROM (VALUES {_ids(16)}) AS a(id)""",
    "raw_gads_clicks": """
        SELECT user_id % 16 + 1 AS ad_id, CAST(ts AS DATE) AS date, COUNT(*) AS impressions,
               SUM(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END) AS clicks,
               CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS cost,
               SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS conversions
        FROM {events} GROUP BY user_id % 16 + 1, CAST(ts AS DATE)""",
    "raw_fb_campaigns": """
        SELECT CAST(id AS BIGINT) AS id, name
        FROM (VALUES (1, 'Facebook Cpc Tea Lovers'), (2, 'Facebook Leadgen Tasting'),
                     (3, 'Facebook Reels Brewing')) AS c(id, name)""",
    "raw_fb_ad_sets": f"""
        SELECT CAST(id AS BIGINT) AS id, CAST(floor((id - 1) / 2) AS BIGINT) + 1 AS campaign_id
        FROM (VALUES {_ids(6)}) AS s(id)""",
    "raw_fb_ads": """
        SELECT user_id % 12 + 1 AS ad_id, CAST(floor((user_id % 12) / 2) AS BIGINT) + 1 AS ad_set_id,
               concat('Creative ', CAST(user_id % 12 + 1 AS STRING)) AS name, CAST(ts AS DATE) AS date,
               COUNT(*) AS impressions, SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicks,
               CAST(SUM(CAST(value AS DECIMAL(12,2))) * CAST(0.50 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS spend,
               SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS conversions
        FROM {events} GROUP BY user_id % 12, CAST(ts AS DATE)""",
    "raw_sessions": f"""
        SELECT event_id AS session_id, CAST(ts AS DATE) AS session_date,
               {_cases("event_id % 12", [k[0] for k in SESSION_KINDS])} AS source,
               {_cases("event_id % 12", [k[1] for k in SESSION_KINDS])} AS medium,
               {_cases("event_id % 12", [k[2] for k in SESSION_KINDS])} AS campaign,
               CASE user_id % 2 WHEN 0 THEN 'mobile' ELSE 'desktop' END AS device_category,
               CAST(user_id % 9 + 1 AS INT) AS pageviews, CAST(event_id % 600 AS INT) AS session_duration_seconds
        FROM {{events}}""",
    "raw_visits": """
        SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS visited_at,
               CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END AS customer_id,
               CASE WHEN event_type = 'click'
                    THEN concat('gclid-', CAST(user_id % 20 AS STRING), '-', CAST(event_id AS STRING))
                    WHEN event_type = 'view' THEN '' ELSE NULL END AS gclid,
               concat('/', event_type) AS landing_page,
               CASE user_id % 2 WHEN 0 THEN 'mobile' ELSE 'desktop' END AS device_category,
               CAST(ts AS TIMESTAMP) + INTERVAL '5' MINUTE AS _fivetran_synced
        FROM {events}""",
    # Identical copies, conflicting copies and rows without a key.
    "raw_visits_redelivered": """
        SELECT * FROM {raw_visits}
        UNION ALL
        SELECT id, visited_at, customer_id, gclid, landing_page, device_category, _fivetran_synced + INTERVAL '1' DAY
        FROM {raw_visits} WHERE id % 10 = 0
        UNION ALL
        SELECT id, visited_at, customer_id, gclid, '/conflict', device_category, _fivetran_synced
        FROM {raw_visits} WHERE id % 17 = 0
        UNION ALL
        SELECT CAST(NULL AS BIGINT), visited_at, customer_id, gclid, landing_page, device_category, _fivetran_synced
        FROM {raw_visits} WHERE id % 500 = 0""",
    # The second delivery: later visits, plus corrected copies of some earlier ones.
    "raw_visits_first": """
        SELECT * FROM {raw_visits} WHERE visited_at < TIMESTAMP '2024-01-16 00:00:00'""",
    "raw_visits_second": """
        SELECT * FROM {raw_visits} WHERE visited_at >= TIMESTAMP '2024-01-16 00:00:00'
        UNION ALL
        SELECT id, visited_at, customer_id, gclid, '/corrected', device_category, _fivetran_synced + INTERVAL '20' DAY
        FROM {raw_visits} WHERE visited_at < TIMESTAMP '2024-01-16 00:00:00' AND id % 7 = 0""",
    # A third delivery: other corrections, and visits without an id.
    "raw_visits_third": """
        SELECT id, visited_at, customer_id, gclid, '/third' AS landing_page, device_category,
               _fivetran_synced + INTERVAL '40' DAY AS _fivetran_synced
        FROM {raw_visits} WHERE id % 11 = 0
        UNION ALL
        SELECT CAST(NULL AS BIGINT), visited_at, customer_id, gclid, landing_page, device_category, _fivetran_synced
        FROM {raw_visits} WHERE id % 500 = 0""",
    # Deliveries by day: some visits are held back and come weeks late, some are sent again long after, some have no time.
    "raw_visits_early": """
        SELECT * FROM {raw_visits} WHERE visited_at < TIMESTAMP '2024-01-11 00:00:00'
           AND NOT (id % 19 = 0 AND visited_at < TIMESTAMP '2024-01-05 00:00:00')""",
    "raw_visits_middle": """
        SELECT * FROM {raw_visits}
        WHERE visited_at >= TIMESTAMP '2024-01-11 00:00:00' AND visited_at < TIMESTAMP '2024-01-21 00:00:00'
        UNION ALL
        SELECT id, visited_at, customer_id, gclid, landing_page, device_category, _fivetran_synced + INTERVAL '1' DAY
        FROM {raw_visits} WHERE id % 10 = 0
           AND visited_at >= TIMESTAMP '2024-01-11 00:00:00' AND visited_at < TIMESTAMP '2024-01-21 00:00:00'
        UNION ALL
        SELECT -1 - id, CAST(NULL AS TIMESTAMP), customer_id, gclid, landing_page, device_category, _fivetran_synced
        FROM {raw_visits} WHERE id % 29 = 0""",
    "raw_visits_end": """
        SELECT * FROM {raw_visits} WHERE visited_at >= TIMESTAMP '2024-01-21 00:00:00'
        UNION ALL
        SELECT * FROM {raw_visits} WHERE visited_at < TIMESTAMP '2024-01-05 00:00:00' AND (id % 19 = 0 OR id % 23 = 0)
        UNION ALL
        SELECT CAST(NULL AS BIGINT), visited_at, customer_id, gclid, landing_page, device_category, _fivetran_synced
        FROM {raw_visits} WHERE id % 500 = 0""",
    # A taxonomy that grows with the products, and sessions of which some name one.
    "raw_rules": f"""
        SELECT * FROM (VALUES {", ".join(str(tuple(r)) for r in DEFAULT_RULES)}) AS r(pattern, channel, subchannel)
        UNION ALL
        SELECT concat('promo-', CAST(p_partkey AS STRING), '(-x|-y)?$'), concat('Promo ', CAST(p_partkey % 7 AS STRING)),
               concat('Promo > ', p_name)
        FROM {{part}}
        UNION ALL
        SELECT concat('promo-', CAST(p_partkey AS STRING), '-.*z'), 'Promo Z', concat('Promo Z > ', p_name)
        FROM {{part}} WHERE p_partkey % 3 = 0""",
    "raw_sessions_promo": """
        SELECT session_id, source, medium,
               CASE WHEN session_id % 3 = 0 THEN campaign
                    ELSE concat('promo-', CAST(session_id % 250 AS STRING),
                                CASE session_id % 4 WHEN 0 THEN '' WHEN 1 THEN '-x' WHEN 2 THEN '-yz' ELSE '-w' END)
               END AS campaign
        FROM {raw_sessions}""",
    # Ad results as restated a day later: some days changed, one kind of day is gone.
    "raw_gads_clicks_restated": """
        SELECT ad_id, date, impressions, CASE WHEN EXTRACT(DAY FROM date) % 5 = 0 THEN clicks + 1 ELSE clicks END AS clicks,
               cost, conversions
        FROM {raw_gads_clicks} WHERE EXTRACT(DAY FROM date) <> 13""",
    # The eight marketing and session sources in the shape in which they land.
    "raw_src_sessions": """
        SELECT session_id AS id, session_date, source, medium, campaign, device_category, pageviews,
               session_duration_seconds, CAST(session_date AS TIMESTAMP) + INTERVAL '1' DAY AS _fivetran_synced
        FROM {raw_sessions}""",
    "raw_src_gads_campaigns": f"""
        SELECT s_suppkey AS id, concat('Google ', s_name) AS name, {_STATUS.format("s_suppkey")} AS status,
               CASE s_suppkey % 2 WHEN 0 THEN 'search' ELSE 'display' END AS campaign_type,
               CAST(DATE '2024-01-01' + CAST(s_suppkey % 90 AS INT) AS DATE) AS start_date,
               CASE WHEN s_suppkey % 4 = 0 THEN CAST(DATE '2024-06-01' + CAST(s_suppkey % 90 AS INT) AS DATE) END AS end_date,
               {_LOADED} FROM {{supplier}}""",
    "raw_src_gads_ad_groups": f"""
        SELECT c_custkey AS id, c_nationkey AS campaign_id, c_name AS name, {_STATUS.format("c_custkey")} AS status,
               {_LOADED} FROM {{customer}}""",
    "raw_src_gads_ads": f"""
        SELECT p_partkey AS id, p_size AS ad_group_id, p_name AS headline, {_STATUS.format("p_partkey")} AS status,
               p_type AS ad_type, {_LOADED} FROM {{part}}""",
    "raw_src_gads_clicks": """
        SELECT event_id AS id, user_id AS ad_id, CAST(ts AS DATE) AS date, CAST(event_id % 900 + 1 AS INT) AS impressions,
               CAST(event_id % 40 AS INT) AS clicks, CAST(value AS DECIMAL(12,2)) AS cost,
               CAST(event_id % 3 AS INT) AS conversions, CAST(ts AS TIMESTAMP) + INTERVAL '1' DAY AS _fivetran_synced
        FROM {events}""",
    "raw_src_fb_campaigns": f"""
        SELECT s_suppkey AS id, concat('Facebook ', s_name) AS name,
               CASE s_suppkey % 2 WHEN 0 THEN 'reach' ELSE 'sales' END AS objective, {_STATUS.format("s_suppkey")} AS status,
               CAST(DATE '2024-01-01' + CAST(s_suppkey % 60 AS INT) AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date,
               {_LOADED} FROM {{supplier}}""",
    "raw_src_fb_ad_sets": f"""
        SELECT c_custkey AS id, c_nationkey AS campaign_id, c_name AS name, {_STATUS.format("c_custkey")} AS status,
               CAST(c_acctbal AS DECIMAL(12,2)) AS daily_budget, {_LOADED} FROM {{customer}}""",
    "raw_src_fb_ads": f"""
        SELECT event_id AS id, user_id % 12 + 1 AS ad_id, user_id % 6 + 1 AS ad_set_id, CAST(ts AS DATE) AS date,
               concat('Creative ', CAST(user_id % 12 + 1 AS STRING)) AS name, {_STATUS.format("event_id")} AS status,
               CAST(event_id % 700 + 1 AS INT) AS impressions, CAST(event_id % 30 AS INT) AS clicks,
               CAST(value AS DECIMAL(12,2)) AS spend, CAST(event_id % 2 AS INT) AS conversions,
               CAST(ts AS TIMESTAMP) + INTERVAL '1' DAY AS _fivetran_synced
        FROM {{events}}""",
    "raw_landed_sessions": _redelivered("raw_src_sessions", "google_analytics_sessions", "pageviews", "pageviews + 1"),
    "raw_landed_gads_campaigns": _redelivered("raw_src_gads_campaigns", "google_ads_campaigns", "end_date", "DATE '2030-01-01'"),
    "raw_landed_gads_ad_groups": _redelivered("raw_src_gads_ad_groups", "google_ads_ad_groups", "status", "'unknown'"),
    "raw_landed_gads_ads": _redelivered("raw_src_gads_ads", "google_ads_ads", "headline", "concat(headline, '!')"),
    "raw_landed_gads_clicks": _redelivered("raw_src_gads_clicks", "google_ads_clicks", "cost", "CAST(-1 AS DECIMAL(12,2))"),
    "raw_landed_fb_campaigns": _redelivered("raw_src_fb_campaigns", "facebook_ads_campaigns", "objective", "CAST(NULL AS STRING)"),
    "raw_landed_fb_ad_sets": _redelivered("raw_src_fb_ad_sets", "facebook_ads_ad_sets", "daily_budget", "CAST(0 AS DECIMAL(12,2))"),
    "raw_landed_fb_ads": _redelivered("raw_src_fb_ads", "facebook_ads_ads", "spend", "CAST(-5 AS DECIMAL(12,2))"),
    # The catalogue one run later: some prices moved, some products are gone, some are new.
    "raw_prices_first": """
        SELECT p_partkey AS id, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM {part} WHERE p_partkey % 13 <> 0""",
    "raw_prices_second": """
        SELECT p_partkey AS id,
               CASE WHEN p_partkey % 10 = 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) + 5 AS DECIMAL(12,2))
                    ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS price
        FROM {part} WHERE p_partkey % 97 <> 0""",
    # Two runs later: prices moved again, some products left, some came back.
    "raw_prices_third": """
        SELECT id, CASE WHEN id % 6 = 0 THEN CAST(price + 1 AS DECIMAL(12,2)) ELSE price END AS price
        FROM {raw_prices_second} WHERE id % 31 <> 0
        UNION ALL
        SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) FROM {part} WHERE p_partkey % 97 = 0""",
    "raw_rates_second": """
        SELECT date, base_currency, target_currency,
               CASE WHEN EXTRACT(DAY FROM date) = 7 THEN CAST(rate + CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(12,6))
                    ELSE rate END AS rate,
               CASE WHEN EXTRACT(DAY FROM date) = 7 THEN _fivetran_synced + INTERVAL '2' DAY
                    ELSE _fivetran_synced END AS _fivetran_synced
        FROM {raw_rates} WHERE NOT (target_currency = 'CAD' AND EXTRACT(DAY FROM date) = 9)""",
    # Orders with rows that break the declared checks.
    "raw_orders_faulty": """
        SELECT id, user_id, order_date, status, currency_code, gclid, _fivetran_synced FROM {raw_orders}
        UNION ALL
        SELECT -id, NULL, order_date, status, currency_code, gclid, _fivetran_synced FROM {raw_orders} WHERE id % 250 = 1
        UNION ALL
        SELECT -id, user_id, order_date, 'shipped', currency_code, gclid, _fivetran_synced
        FROM {raw_orders} WHERE id % 250 = 2
        UNION ALL
        SELECT -id, -user_id - 1, order_date, status, currency_code, gclid, _fivetran_synced
        FROM {raw_orders} WHERE id % 250 = 3
        UNION ALL
        SELECT id, user_id, order_date, status, currency_code, gclid, _fivetran_synced + INTERVAL '1' DAY
        FROM {raw_orders} WHERE id % 250 = 4
        UNION ALL
        SELECT NULL, user_id, order_date, status, NULL, gclid, _fivetran_synced FROM {raw_orders} WHERE id % 250 = 5""",
    "raw_items_faulty": """
        SELECT id, order_id, product_id, quantity, unit_price, _fivetran_synced FROM {raw_items}
        UNION ALL
        SELECT -id, order_id, product_id, -quantity, unit_price, _fivetran_synced FROM {raw_items} WHERE id % 300 = 1
        UNION ALL
        SELECT -id, order_id, product_id, quantity + 500, CAST(0 AS DECIMAL(12,2)), _fivetran_synced
        FROM {raw_items} WHERE id % 300 = 2""",
}
