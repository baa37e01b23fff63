"""Advertising performance, channel spend and return on ad spend."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.keys import surrogate_key
from ledgerlark.functions.money import money_sum, safe_divide
from ledgerlark.operators.joins import splittable_join
from ledgerlark.operators.revenue import AdHierarchy
from ledgerlark.operators.taxonomy import DEFAULT_RULES, Rule, campaign_subject, classify, session_subject

_PERFORMANCE = (
    "platform", "campaign_id", "campaign_name", "ad_id", "ad_name", "date", "impressions", "clicks", "cost",
    "conversions",
)


def google_performance(clicks: DataFrame, hierarchy: AdHierarchy) -> DataFrame:
    """Daily ad results with their campaign, from a separate daily table."""
    return (
        splittable_join(clicks, hierarchy.joined(), ["ad_id"])
        .withColumn("platform", F.lit("google_ads"))
        .select(*_PERFORMANCE)
    )


def facebook_performance(ads: DataFrame, ad_sets: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Daily ad results with their campaign, from rows embedded on the ads."""
    sets = ad_sets.select(F.col("id").alias("ad_set_id"), "campaign_id").join(
        campaigns.select(F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name")), "campaign_id"
    )
    return (
        splittable_join(
            ads.withColumnRenamed("name", "ad_name").withColumnRenamed("spend", "cost"), sets, ["ad_set_id"]
        )
        .withColumn("platform", F.lit("facebook_ads"))
        .select(*_PERFORMANCE)
    )


def marketing_combined(google: DataFrame, facebook: DataFrame) -> DataFrame:
    return google.unionByName(facebook)


def classify_campaigns(combined: DataFrame, rules: Iterable[Rule] = DEFAULT_RULES) -> DataFrame:
    """Channel of every campaign that has performance rows."""
    campaigns = combined.select("platform", "campaign_id", "campaign_name").distinct()
    return classify(campaigns, campaign_subject(F.col("campaign_name")), rules)


def fct_marketing(combined: DataFrame, channels: DataFrame) -> DataFrame:
    """Ad x day with channel and row-level click and cost ratios."""
    lookup = channels.select("platform", "campaign_id", "channel_grouping", "subchannel")
    return splittable_join(combined, lookup, ["platform", "campaign_id"], "left").select(
        "platform", "campaign_id", "campaign_name", "channel_grouping", "subchannel", "ad_id", "ad_name", "date",
        "impressions", "clicks",
        F.col("cost").alias("spend"),
        "conversions",
        safe_divide(F.col("clicks"), F.col("impressions")).alias("ctr"),
        safe_divide(F.col("cost"), F.col("clicks")).alias("cpc"),
    )


def classify_sessions(sessions: DataFrame, rules: Iterable[Rule] = DEFAULT_RULES) -> DataFrame:
    """Channel of every session."""
    subject = session_subject(F.col("source"), F.col("medium"), F.col("campaign"))
    return classify(
        sessions.select("session_id", "source", "medium", "campaign"), subject, rules
    )


def fct_sessions(sessions: DataFrame, rules: Iterable[Rule] = DEFAULT_RULES) -> DataFrame:
    """Sessions with their channel; the class is a column, not a self-join."""
    subject = session_subject(F.col("source"), F.col("medium"), F.col("campaign"))
    return classify(sessions, subject, rules).select(
        "session_id", "session_date", "source", "medium", "campaign", "channel_grouping", "subchannel",
        "device_category", "pageviews", "session_duration_seconds",
    )


def agg_marketing(fct: DataFrame) -> DataFrame:
    """Campaign totals; ratios are ratios of the sums."""
    return (
        fct.groupBy("platform", "campaign_id", "campaign_name")
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum("spend").alias("spend"),
            F.sum("conversions").alias("conversions"),
        )
        .select(
            # Campaign ids collide across platforms, so the platform is part of the key.
            surrogate_key(F.col("platform"), F.col("campaign_id")).alias("id"),
            "*",
            safe_divide(F.col("clicks"), F.col("impressions")).alias("ctr"),
            safe_divide(F.col("spend"), F.col("clicks")).alias("cpc"),
            safe_divide(F.col("spend"), F.col("conversions")).alias("cost_per_conversion"),
        )
    )


def channel_spend(marketing: DataFrame) -> DataFrame:
    return marketing.groupBy("channel_grouping").agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("spend").alias("spend"),
        F.sum("conversions").alias("conversions"),
    )


def channel_revenue(fct: DataFrame, channels: DataFrame) -> DataFrame:
    """Attributed revenue per channel.

    The fact is reduced to campaign level before it meets the channel table, so
    the join sees a handful of rows. Orders are counted per campaign first: an
    order has one attribution, hence the campaign counts add up.
    """
    per_campaign = (
        fct.where(F.col("attributed_campaign_id").isNotNull())
        .groupBy(
            F.col("attributed_platform").alias("platform"), F.col("attributed_campaign_id").alias("campaign_id")
        )
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("gross_revenue").alias("gross"),
            money_sum(F.col("net_revenue")).alias("net"),
            money_sum(F.col("cogs")).alias("cogs"),
            money_sum(F.col("contribution_margin")).alias("contribution"),
        )
    )
    return (
        per_campaign.join(channels.select("platform", "campaign_id", "channel_grouping"), ["platform", "campaign_id"])
        .groupBy("channel_grouping")
        .agg(
            F.sum("orders").alias("attributed_orders"),
            F.sum("gross").alias("attributed_gross_revenue"),
            F.sum("net").alias("attributed_net_revenue"),
            F.sum("cogs").alias("attributed_cogs"),
            F.sum("contribution").alias("attributed_contribution_margin"),
        )
    )


def agg_channel(marketing: DataFrame, fct: DataFrame, channels: DataFrame) -> DataFrame:
    """Spend and attributed revenue per channel, with gross and net return.

    Channels are driven by spend: revenue on a channel without spend is absent.
    """
    measures = (
        "attributed_orders", "attributed_gross_revenue", "attributed_net_revenue", "attributed_cogs",
        "attributed_contribution_margin",
    )
    joined = channel_spend(marketing).join(channel_revenue(fct, channels), "channel_grouping", "left")
    for measure in measures[1:]:
        joined = joined.withColumn(measure, F.coalesce(F.col(measure), F.lit(0).cast(T.DecimalType(38, 6))))
    spend, margin = F.col("spend"), F.col("attributed_contribution_margin")
    return joined.withColumn("attributed_orders", F.coalesce("attributed_orders", F.lit(0))).select(
        surrogate_key(F.col("channel_grouping")).alias("id"),
        "channel_grouping", "impressions", "clicks", "spend", "conversions",
        *measures,
        safe_divide(F.col("attributed_gross_revenue"), spend).alias("gross_roas"),
        safe_divide(margin, spend).alias("net_roas"),
        safe_divide(margin - spend, spend).alias("roi"),
    )


def channel_performance(channel: DataFrame) -> DataFrame:
    """Which channels pay for themselves, after returns and cost of goods."""
    # The verdicts, and the net return from which each applies.
    verdict = (
        F.when(F.col("attributed_gross_revenue") == 0, "not attributable (no click id)")
        .when(F.col("net_roas") >= 1.5, "scale up")
        .when(F.col("net_roas") >= 1.0, "profitable")
        .otherwise("losing money after costs")
    )
    return channel.select(
        "channel_grouping",
        F.round("spend", 2).alias("spend"),
        "clicks",
        F.col("attributed_orders").alias("orders"),
        F.round("attributed_gross_revenue", 2).alias("gross_revenue"),
        F.round("attributed_contribution_margin", 2).alias("contribution"),
        F.round("gross_roas", 2).alias("gross_roas"),
        F.round("net_roas", 2).alias("net_roas"),
        verdict.alias("verdict"),
    ).orderBy(F.desc("spend"), "channel_grouping")


def blended_roas(channel: DataFrame) -> DataFrame:
    """Return over all channels that revenue can be attributed to."""
    return channel.where(F.col("attributed_gross_revenue") > 0).agg(
        F.round(safe_divide(F.sum("attributed_gross_revenue"), F.sum("spend")), 4).alias("gross_roas"),
        F.round(safe_divide(F.sum("attributed_contribution_margin"), F.sum("spend")), 4).alias("net_roas"),
    )


def attribution_coverage(visits: DataFrame) -> DataFrame:
    """Visits in total, with attribution, and without a known customer."""
    return visits.agg(
        F.count(F.lit(1)).alias("visits"),
        F.count("attributed_platform").alias("attributed"),
        (F.count(F.lit(1)) - F.count("customer_id")).alias("anonymous"),
    )
