import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import taxonomy as tax

CAMPAIGNS = [
    ("Google Brand Search", "Brand"),
    ("Google Non-Brand Search", "Non Brand"),
    ("Google Shopping Feed", "Shopping"),
    ("Google Banner Retargeting", "Display"),
    ("Facebook Cpc Lookalike Prospecting", "Social"),
    ("Facebook Leadgen Campaign", "Lead Generation"),
    ("Something Else", "Other"),
]
SESSIONS = [
    (("email", "email", "newsletter-weekly-digest-1"), "Organic", "Organic > Newsletter"),
    (("affiliate", "referral", "affiliate-super-partner-1"), "Affiliates", "Affiliates > Partners"),
    (("cj", "affiliate", "cj-network-impact-1"), "Affiliates", "Affiliates > Impacts"),
    (("direct", "none", "(direct)-1"), "Other", None),
    (("google", "display", "anything-1"), "Shopping", "Shopping > Google"),
    ((None, "x", None), "Other", None),
]


def test_campaigns(frame):
    df = frame(CAMPAIGNS, "name string, expected string")
    got = tax.classify(df, tax.campaign_subject(F.col("name")))
    assert got.where("channel_grouping <> expected").count() == 0


@pytest.mark.parametrize("per_case", [1, 4, 200])
def test_sessions(frame, per_case):
    df = frame([(*s, c, sub) for s, c, sub in SESSIONS], "s string, m string, c string, ch string, sub string")
    subject = tax.session_subject(F.col("s"), F.col("m"), F.col("c"))
    got = df.select("ch", "sub", tax.first_match(subject, tax.DEFAULT_RULES, per_case).alias("hit")).collect()
    for row in got:
        assert (row.ch, row.sub) == ((row.hit.channel, row.hit.subchannel) if row.hit else ("Other", None))


def test_session_subject_keeps_separators_and_case(frame):
    df = frame([(None, "Cpc", None)], "s string, m string, c string")
    assert df.select(tax.session_subject(F.col("s"), F.col("m"), F.col("c"))).first()[0] == "-Cpc-"


def test_no_rules_means_other(frame, rows):
    df = tax.classify(frame([("a",)], "n string"), F.col("n"), [])
    assert rows(df) == [("a", "Other", None)]


def test_long_taxonomy(frame):
    rules = [tax.Rule(f"key{i:04d}", f"c{i}", f"s{i}") for i in range(2 * tax.RULES_PER_CASE + 50)]
    df = frame([("x-key0007-y",), ("key0444",), ("none",)], "n string")
    got = tax.classify(df, F.col("n"), rules).collect()
    assert [(r.channel_grouping, r.subchannel) for r in got] == [
        ("c7", "s7"), ("c444", "s444"), ("Other", None)
    ]


def test_each_pattern_is_evaluated_once(frame):
    df = tax.classify(frame([("a",)], "n string").repartition(2), F.col("n"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") + plan.count("rlike") <= len(tax.DEFAULT_RULES)
