"""Taxonomy rules as a table: candidates by an index of literals, one lookup per distinct subject."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.joins import splittable_join
from ledgerlark.operators.taxonomy import UNMATCHED

#: Letters of a literal that the index goes by; shorter literals are indexed whole.
GRAM = 3
#: The entry of rules of which no literal is known: every subject has to be tried with them.
ANY = ""


def _top_level(pattern: str, sign: str) -> list[str]:
    """``pattern`` cut at ``sign`` where it stands outside groups and classes."""
    parts, depth, inside, at, begin = [], 0, False, 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
            at += pattern[at + 1 : at + 2] in ("]", "^")
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == sign and not depth:
            parts.append(pattern[begin:at])
            begin = at + 1
        at += 1
    return [*parts, pattern[begin:]]


def _is_group(part: str) -> bool:
    """Whether the parenthesis that opens a part is closed by its last character."""
    depth, inside, at = 0, False, 0
    while at < len(part):
        c = part[at]
        if c == "\\":
            at += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
            at += part[at + 1 : at + 2] in ("]", "^")
        elif c in "()":
            depth += 1 if c == "(" else -1
        if not depth:
            return at == len(part) - 1 and part[:1] == "("
        at += 1
    return False


def required_literals(pattern: str) -> list[str]:
    """Literals of which every text that the pattern is found in holds at least one; empty where none is known.

    Each alternative needs the longest run of plain characters outside groups, classes and escapes whose last
    character isn't optional or repeated; a group that is one whole alternative is looked into. Flags and
    anything else unusual make a pattern count as one without literals, which is slow and never wrong.
    """
    if "(?" in pattern or "\\Q" in pattern:
        return []
    found = []
    for part in _top_level(pattern, "|"):
        if _is_group(part):
            some = required_literals(part[1:-1])
        else:
            some = _longest_run(part)
        if not some:
            return []
        found += some
    return sorted(set(found))


def _longest_run(part: str) -> list[str]:
    runs, run, at, depth = [], "", 0, 0
    while at < len(part):
        c = part[at]
        if c == "\\" or c == "[":
            runs.append(run)
            run = ""
            if c == "[":  # to the end of the class; a bracket may come first in it
                at += 1 + (part[at + 1 : at + 2] == "^")
                at += part[at : at + 1] == "]"
                while at < len(part) and part[at] != "]":
                    at += 1 + (part[at] == "\\")
            else:
                at += 1
        elif depth:
            depth += (c == "(") - (c == ")")
        elif c == "(":
            runs.append(run)
            run, depth = "", 1
        elif c in "*?{":  # the character before may be missing
            runs.append(run[:-1])
            run = ""
            if c == "{":
                at = part.find("}", at) if "}" in part[at:] else len(part)
        elif c in "+.^$":
            runs.append(run)
            run = ""
        else:
            run += c
        at += 1
    longest = max([*runs, run], key=len)
    return [longest] if longest else []


def _literals(patterns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for some in patterns:
        yield pa.array([required_literals(p or "") for p in some.to_pylist()], pa.list_(pa.string()))


_literals.__annotations__ = {"patterns": Iterator[pa.Array], "return": Iterator[pa.Array]}


def literal_index(rules: DataFrame) -> DataFrame:
    """``gram``, ``literal``, ``pattern``, ``channel``, ``subchannel``: each rule under one gram per required literal.

    Of a literal's grams the one that fewest rules' literals hold is taken. Rules without a literal
    come under the empty gram. Repeated rules are one; a pattern that has several channels is kept with each.
    """
    told = F.arrow_udf(_literals, "array<string>")
    each = rules.where("pattern IS NOT NULL").select("pattern", "channel", "subchannel").distinct()
    each = each.withColumn("literal", F.explode_outer(told("pattern")))
    grams = each.select("literal", F.explode(_grams(F.col("literal"))).alias("gram")).distinct()
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = grams.join(often, "gram").groupBy("literal").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    placed = each.join(rarest, "literal", "left")
    return placed.select(F.coalesce("gram", F.lit(ANY)).alias("gram"), "literal", "pattern", "channel", "subchannel")


def _grams(text: Column) -> Column:
    """All runs of ``GRAM`` characters of a text, or the whole text where it is shorter."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (GRAM - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(GRAM))))


def _all_grams(text: Column) -> Column:
    """All runs of up to ``GRAM`` characters, and the empty one."""
    def of(n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substr(text, i, F.lit(n)))

    return F.array_distinct(F.concat(F.array(F.lit(ANY)), *map(of, range(1, GRAM + 1))))


def match_rules(subjects: DataFrame, index: DataFrame, subject: str = "subject") -> DataFrame:
    """``subject``, ``channel``, ``subchannel``: distinct subjects with the rule that wins, if any does.

    The longest pattern that is found in the subject wins, and of equally long ones the first in pattern order,
    then in order of channel. Only rules whose literal the subject holds are tried.
    """
    words = subjects.where(F.col(subject).isNotNull()).select(F.col(subject).alias("subject")).distinct()
    tried = splittable_join(words.withColumn("gram", F.explode(_all_grams(F.col("subject")))), index, ["gram"])
    tried = tried.where(F.col("literal").isNull() | F.contains("subject", "literal"))
    hits = tried.where(F.expr("subject RLIKE pattern"))
    order = F.struct(-F.length("pattern"), F.col("pattern"), F.col("channel"), F.col("subchannel"))
    best = hits.groupBy("subject").agg(F.min_by(F.struct("channel", "subchannel"), order).alias("m"))
    return best.select("subject", "m.channel", "m.subchannel")


def classify_by_index(df: DataFrame, subject: Column, index: DataFrame) -> DataFrame:
    """``df`` with ``channel_grouping`` ('Other' where nothing matches) and ``subchannel``, by :func:`literal_index`.

    Patterns are tried on distinct subjects, so a row costs one lookup however many rules there are; a NULL subject
    matches nothing.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("channel_grouping", "subchannel")]
    rows = df.withColumn("__subject", subject)
    won = match_rules(rows, index, "__subject").toDF("__subject", "__channel", "__subchannel")
    return splittable_join(rows, won, ["__subject"], "left").select(
        *kept, F.coalesce("__channel", F.lit(UNMATCHED)).alias("channel_grouping"), F.col("__subchannel").alias("subchannel")
    )


def classify_by_rules(df: DataFrame, subject: Column, rules: DataFrame) -> DataFrame:
    """:func:`classify_by_index` with rules (``pattern``, ``channel``, ``subchannel``) that have no index yet."""
    return classify_by_index(df, subject, literal_index(rules))
