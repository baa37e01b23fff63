"""Advertising, sessions and channels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.operators import marketing as mkt
from ledgerlark.operators import rules
from ledgerlark.operators.incremental import build_visits
from ledgerlark.operators.staging import typed
from ledgerlark.operators.taxonomy import session_subject
from ledgerlark.registry.base import Tables, part, query
from ledgerlark.registry.models import big, dbl, div
from ledgerlark.registry.revenue import fct, hierarchy
from ledgerlark.session import written


@part
def combined(t: Tables):
    return mkt.marketing_combined(
        mkt.google_performance(t["raw_gads_clicks"], hierarchy(t)),
        mkt.facebook_performance(t["raw_fb_ads"], t["raw_fb_ad_sets"], t["raw_fb_campaigns"]),
    )


def channels(t: Tables, performance):
    """Campaign channels: one row per campaign."""
    return mkt.classify_campaigns(performance)


def marketing(t: Tables):
    performance = combined(t)
    return mkt.fct_marketing(performance, channels(t, performance))


def channel_table(t: Tables):
    performance = combined(t)
    lookup = channels(t, performance)
    return mkt.agg_channel(mkt.fct_marketing(performance, lookup), fct(t), lookup)


@query(
    "marketing_combined",
    f"""SELECT platform, campaign_id, campaign_name, ad_id, ad_name, date, {big("impressions")} AS impressions,
               {big("clicks")} AS clicks, {dbl("cost")} AS cost, {big("conversions")} AS conversions
        FROM m_combined""",
)
def marketing_combined(t: Tables):
    return combined(t)


@query("classify_campaigns", "SELECT * FROM m_channels")
def classify_campaigns(t: Tables):
    return mkt.classify_campaigns(combined(t))


_SESSION = """
    SELECT s.session_id, s.source, s.medium, s.campaign, c.channel_grouping, c.subchannel
    FROM raw_sessions s JOIN m_session_channels c ON s.session_id = c.session_id"""


@query("classify_sessions", _SESSION)
def classify_sessions(t: Tables):
    return mkt.classify_sessions(t["raw_sessions"])


@query(
    "classify_theta",
    """WITH kinds AS (
         SELECT DISTINCT source, medium, campaign,
                concat(COALESCE(source, ''), '-', COALESCE(medium, ''), '-', COALESCE(campaign, '')) AS subject
         FROM raw_sessions_promo),
       hits AS (
         SELECT subject, channel, subchannel,
                ROW_NUMBER() OVER (PARTITION BY subject ORDER BY length(pattern) DESC, pattern, channel, subchannel) AS place
         FROM (SELECT DISTINCT subject FROM kinds) JOIN (SELECT DISTINCT * FROM raw_rules) ON regexp_matches(subject, pattern))
       SELECT s.session_id, s.source, s.medium, s.campaign, COALESCE(h.channel, 'Other') AS channel_grouping, h.subchannel
       FROM raw_sessions_promo s
       JOIN kinds k ON s.source IS NOT DISTINCT FROM k.source AND s.medium IS NOT DISTINCT FROM k.medium
                   AND s.campaign IS NOT DISTINCT FROM k.campaign
       LEFT JOIN hits h ON h.subject = k.subject AND h.place = 1""",
)
def classify_theta(t: Tables):
    """Sessions by a table of rules that grows with the products; the index of its literals is stored first."""
    index = written(rules.literal_index(t["raw_rules"]), "rules-index")
    subject = session_subject(F.col("source"), F.col("medium"), F.col("campaign"))
    return rules.classify_by_index(t["raw_sessions_promo"], subject, index)


@query(
    "fct_marketing",
    f"""SELECT platform, campaign_id, campaign_name, channel_grouping, subchannel, ad_id, ad_name, date,
               {big("impressions")} AS impressions, {big("clicks")} AS clicks, {dbl("spend")} AS spend,
               {big("conversions")} AS conversions, ctr, cpc FROM m_fct_marketing""",
)
def fct_marketing(t: Tables):
    return marketing(t)


@query(
    "fct_sessions",
    f"""SELECT s.session_id, s.session_date, s.source, s.medium, s.campaign, c.channel_grouping, c.subchannel,
               s.device_category, {big("s.pageviews")} AS pageviews,
               {big("s.session_duration_seconds")} AS session_duration_seconds
        FROM raw_sessions s JOIN m_session_channels c ON s.session_id = c.session_id""",
)
def fct_sessions(t: Tables):
    return mkt.fct_sessions(t["raw_sessions"])


@query(
    "agg_marketing",
    f"""SELECT md5(platform || '-' || CAST(campaign_id AS VARCHAR)) AS id, platform, campaign_id, campaign_name,
               {big("SUM(impressions)")} AS impressions, {big("SUM(clicks)")} AS clicks, {dbl("SUM(spend)")} AS spend,
               {big("SUM(conversions)")} AS conversions, {div("SUM(clicks)", "SUM(impressions)")} AS ctr,
               {div("SUM(spend)", "SUM(clicks)")} AS cpc,
               {div("SUM(spend)", "SUM(conversions)")} AS cost_per_conversion
        FROM m_fct_marketing GROUP BY platform, campaign_id, campaign_name""",
)
def agg_marketing(t: Tables):
    return mkt.agg_marketing(marketing(t))


def _rounded(name: str, places: int) -> str:
    return f"CAST(ROUND({name}, {places}) AS DOUBLE) AS {name}"


@query(
    "agg_channel",
    f"""SELECT id, channel_grouping, {big("impressions")} AS impressions, {big("clicks")} AS clicks,
               {dbl("spend")} AS spend, {big("conversions")} AS conversions, attributed_orders,
               {dbl("attributed_gross_revenue")} AS attributed_gross_revenue,
               {_rounded("attributed_net_revenue", 2)}, {_rounded("attributed_cogs", 2)},
               {_rounded("attributed_contribution_margin", 2)}, {_rounded("gross_roas", 4)},
               {_rounded("net_roas", 4)}, {_rounded("roi", 4)} FROM m_agg_channel""",
)
def agg_channel(t: Tables):
    table = channel_table(t)
    for column, places in (
        ("attributed_net_revenue", 2), ("attributed_cogs", 2), ("attributed_contribution_margin", 2),
        ("gross_roas", 4), ("net_roas", 4), ("roi", 4),
    ):
        table = table.withColumn(column, F.round(column, places))
    return table


@query(
    "channel_performance",
    f"""SELECT channel_grouping, {dbl("ROUND(spend, 2)")} AS spend, {big("clicks")} AS clicks,
               attributed_orders AS orders, {dbl("ROUND(attributed_gross_revenue, 2)")} AS gross_revenue,
               {dbl("ROUND(attributed_contribution_margin, 2)")} AS contribution,
               ROUND(gross_roas, 2) AS gross_roas, ROUND(net_roas, 2) AS net_roas,
               CASE WHEN attributed_gross_revenue = 0 THEN 'not attributable (no click id)'
                    WHEN net_roas >= 1.5 THEN 'scale up' WHEN net_roas >= 1.0 THEN 'profitable'
                    ELSE 'losing money after costs' END AS verdict FROM m_agg_channel""",
)
def channel_performance(t: Tables):
    return mkt.channel_performance(channel_table(t))


@query(
    "blended_roas",
    f"""SELECT ROUND({div("SUM(attributed_gross_revenue)", "SUM(spend)")}, 4) AS gross_roas,
               ROUND({div("SUM(attributed_contribution_margin)", "SUM(spend)")}, 4) AS net_roas
        FROM m_agg_channel WHERE attributed_gross_revenue > 0""",
)
def blended_roas(t: Tables):
    return mkt.blended_roas(channel_table(t))


def visits(t: Tables, binding: str = "raw_visits"):
    return build_visits(typed(t[binding], "prod_web_visits"), hierarchy(t))


@query("fct_visits", "SELECT * FROM m_visits")
def fct_visits(t: Tables):
    return visits(t).drop("_loaded_at")


@query(
    "attribution_coverage",
    """SELECT COUNT(*) AS visits, COUNT(attributed_platform) AS attributed,
              COUNT(*) - COUNT(customer_id) AS anonymous FROM m_visits""",
)
def attribution_coverage(t: Tables):
    return mkt.attribution_coverage(visits(t))
