"""Channel classification from a table of regular expressions."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    pattern: str
    channel: str
    subchannel: str


# The default channel taxonomy.
DEFAULT_RULES = (
    Rule("google-brand", "Brand", "Brand > Google"),
    Rule("google-non-brand", "Non Brand", "Non Brand > Google"),
    Rule("google.*(shopping|cse|pla)", "Shopping", "Shopping > Google"),
    Rule("bing-non-brand", "Non Brand", "Non Brand > Bing"),
    Rule("google-organic", "Organic", "Organic > Search"),
    Rule("facebook-(cpc|organic)", "Social", "Social > Facebook"),
    Rule("instagram-(cpc|organic)", "Social", "Social > Instagram"),
    Rule("(gdn|display|banner)", "Display", "Display > Other"),
    Rule("affiliate.*partner", "Affiliates", "Affiliates > Partners"),
    Rule("(affiliate|cj).*impact", "Affiliates", "Affiliates > Impacts"),
    Rule("email", "Organic", "Organic > Email"),
    Rule("newsletter", "Organic", "Organic > Newsletter"),
    Rule("referral", "Organic", "Organic > Referral"),
    Rule("leadgen|lead_generation", "Lead Generation", "Lead Generation > Other"),
)

UNMATCHED = "Other"
# Rules per CASE: a longer taxonomy is searched block by block, which keeps the
# generated methods small enough to be compiled.
RULES_PER_CASE = 200


def most_specific_first(rules: Iterable[Rule]) -> list[Rule]:
    """Longest pattern first; equal lengths in pattern order, to be repeatable."""
    return sorted(rules, key=lambda rule: (-len(rule.pattern), rule.pattern))


def _case(subject: Column, rules: list[Rule]) -> Column:
    match = None
    for rule in rules:
        answer = F.struct(F.lit(rule.channel).alias("channel"), F.lit(rule.subchannel).alias("subchannel"))
        hit = subject.rlike(rule.pattern)
        match = F.when(hit, answer) if match is None else match.when(hit, answer)
    return match


def first_match(subject: Column, rules: Iterable[Rule], per_case: int = RULES_PER_CASE) -> Column:
    """Struct(channel, subchannel) of the most specific matching rule, else NULL.

    A CASE over literal patterns, longest first: each pattern is compiled once
    per task and the branches short-circuit, so there is neither a join of rows
    with rules nor a window to pick the winner.
    """
    ordered = most_specific_first(rules)
    if not ordered:
        return F.lit(None).cast("struct<channel:string,subchannel:string>")
    return F.coalesce(*[_case(subject, ordered[i : i + per_case]) for i in range(0, len(ordered), per_case)])


def classify(
    df: DataFrame, subject: Column, rules: Iterable[Rule] = DEFAULT_RULES, per_case: int = RULES_PER_CASE
) -> DataFrame:
    """Add ``channel_grouping`` ('Other' when nothing matches) and ``subchannel``."""
    return df.withColumn("__match", first_match(subject, rules, per_case)).select(
        *df.columns,
        F.coalesce("__match.channel", F.lit(UNMATCHED)).alias("channel_grouping"),
        F.col("__match.subchannel").alias("subchannel"),
    )


def campaign_subject(name: Column) -> Column:
    return F.lower(F.replace(name, F.lit(" "), F.lit("-")))


def session_subject(source: Column, medium: Column, campaign: Column) -> Column:
    """source-medium-campaign in its original case; NULL parts keep their separator."""
    blank = F.lit("")
    return F.concat(
        F.coalesce(source, blank), F.lit("-"), F.coalesce(medium, blank), F.lit("-"), F.coalesce(campaign, blank)
    )
