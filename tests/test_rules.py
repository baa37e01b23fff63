"""Rules from a table against the CASE, and the literals that a pattern needs."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlark.operators import rules, taxonomy

PATTERNS = [r.pattern for r in taxonomy.DEFAULT_RULES]


@pytest.mark.parametrize(
    ("pattern", "literals"),
    [
        ("google-brand", ["google-brand"]),
        ("google.*(shopping|cse|pla)", ["google"]),
        ("(gdn|display|banner)", ["banner", "display", "gdn"]),
        ("leadgen|lead_generation", ["lead_generation", "leadgen"]),
        ("(affiliate|cj).*impact", ["impact"]),
        ("colou?r", ["colo"]),
        ("ab*c{2}def+", ["def"]),
        ("x[abc]yy\\.zzz", ["zzz"]),
        ("[]a]bc", ["bc"]),
        ("(a|b)(c|d)", []),
        ("a|.*", []),
        ("(?i)abc", []),
        ("", []),
        ("((foo|bar))", ["bar", "foo"]),
        ("a(b", ["a"]),
        ("x|", []),
    ],
)
def test_required_literals(pattern, literals):
    assert rules.required_literals(pattern) == literals


_ATOMS = st.sampled_from(["a", "b", "ab", "ba", ".", "[ab]", "[^a]", "\\.", "(a|b)", "(ab|b?)", "(a(b|c)a)", "c", "\\w"])
_PARTS = st.lists(st.tuples(_ATOMS, st.sampled_from(["", "", "", "?", "*", "+", "{0,2}", "{2}"])), max_size=4)


@settings(max_examples=800, deadline=None)
@given(st.lists(_PARTS, min_size=1, max_size=3), st.text("abc.", max_size=8), st.booleans())
def test_a_text_with_the_pattern_holds_a_literal(parts, text, grouped):
    pattern = "|".join("".join(a + q for a, q in p) for p in parts)
    pattern = f"({pattern})" if grouped else pattern
    literals = rules.required_literals(pattern)
    if literals and re.search(pattern, text):
        assert any(x in text for x in literals), (pattern, literals)


def made_rules(spark, n):
    many = [(f"promo-{i}(-x|-y)?$", f"P{i % 7}", f"P{i % 7} > {i}") for i in range(n)]
    few = [("^z", "Z", "Z"), ("..-q", "Q", "Q"), ("q+", "R", "R"), ("pr", "S", "S"), ("promo-1", "T", "T1"), ("p(a|b)c", "U", "U"), ("^.{60,}$", "L", "L")]
    return [*taxonomy.DEFAULT_RULES, *[taxonomy.Rule(*r) for r in many + few]]


def test_a_table_of_thousands_of_rules_equals_the_case(spark, rows):
    table = made_rules(spark, 3000)
    subjects = [f"site-promo-{i}{end}" for i in range(0, 3600, 41) for end in ("", "-x", "-z")]
    subjects += ["", "z", "pq", "google-brand", "Google-Brand", "displays-google", "xpac", "pbc", "ab-q", None, "x" * 20_000 + "qq", "ünï-q"]
    df = spark.createDataFrame([(i, s, "old") for i, s in enumerate(subjects * 2)], "id int, s string, subchannel string")
    expected = taxonomy.classify(df.drop("subchannel"), F.col("s"), table)
    got = rules.classify_by_rules(df, F.col("s"), spark.createDataFrame(table, "pattern string, channel string, subchannel string"))
    assert got.columns == ["id", "s", "channel_grouping", "subchannel"]
    assert rows(got) == rows(expected)


def test_candidates_come_from_the_index(spark):
    """A subject is tried with the rules whose literal it may hold, not with all."""
    table = spark.createDataFrame(made_rules(spark, 2000), "pattern string, channel string, subchannel string")
    index = rules.literal_index(table)
    per_gram = dict(index.groupBy("gram").count().collect())
    assert per_gram[""] == 1  # a length alone; every other rule needs a literal
    assert sum(n for g, n in per_gram.items() if g) == index.where("literal IS NOT NULL").count() > 2000
    assert sorted(per_gram.values())[-1] < 400  # the commonest gram of promo-1234 is not the one that it comes under


def test_few_rules_and_rows(spark, rows):
    none = spark.createDataFrame([], "pattern string, channel string, subchannel string")
    df = spark.createDataFrame([("a",), (None,)], "s string")
    assert rows(rules.classify_by_rules(df, F.col("s"), none)) == [("a", "Other", None), (None, "Other", None)]
    some = spark.createDataFrame([("a", "X", "x2"), ("a", "X", "x1"), ("a", "X", "x1"), (None, "Y", "y"), ("b", "Z", None)], none.schema)
    assert rows(rules.classify_by_rules(df, F.col("s"), some)) == [("a", "X", "x1"), (None, "Other", None)]
    assert rows(rules.classify_by_rules(df.limit(0), F.col("s"), some)) == []
