"""URL filter: curated host rules, then association rules mined from the labels they give.

Curated rules decide what they name; the longest wins. Their verdicts label the urls they
name, and over those alone FP-growth mines which combinations of url tokens go with a block.
Rules that are confident and frequent enough, name a host label and a path word as curated
rules do, and that no shorter rule already implies, judge the urls that no curated rule
names. They are found through an inverted index: each rule is filed under its
rarest token, a url looks up its own tokens, and only rules filed there are compared.
Everything runs as DataFrame and SQL operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import written


@dataclass(frozen=True)
class HostRule:
    """``host/path``: the host with its subdomains, and a prefix of the path after its first slash."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


# The curated rules.
RULES = (
    HostRule("com/", "allow"),
    HostRule("example.com/en/", "block"),
    HostRule("www.example.com/en/", "allow"),
    HostRule("net/es/", "block"),
    HostRule("net/fr/", "block"),
)
BLOCKED = "label:block"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for NULL and for urls without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def curated(host: Column, path: Column, rules: Iterable[HostRule]) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits, else NULL."""
    longest_first = sorted(rules, key=lambda r: (-len(r.host) - len(r.path), r.pattern))
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(longest_first):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        pattern = F.when(fits, F.lit(r.pattern)).otherwise(pattern)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return pattern, verdict


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: host labels and path words, marked by where they stand; digits become one sign."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    words = F.split(ascii_lower(path), r"[^0-9a-z\x{80}-\x{10FFFF}]+")
    words = F.transform(words, lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0")))
    both = F.array_distinct(F.concat(labels, words))
    return F.array_sort(F.filter(both, lambda x: F.length(x) > 2))


def host_and_word(needs: Column) -> Column:
    """The shape of a curated rule: a host label and a path word; a word of digits alone is none."""
    word = F.exists(needs, lambda t: t.startswith("p:") & (t != "p:0"))
    return F.exists(needs, lambda t: t.startswith("h:")) & word


def mine_rules(
    labelled: DataFrame,
    min_support: float = 0.005,
    min_confidence: float = 0.9,
    partitions: int | None = None,
    shape: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Block rules (``rule_id``, ``needs``, ``confidence``, ``support``) from ``tokens`` and ``blocked``.

    A url whose ``blocked`` is NULL has no label and counts neither for nor against a rule.
    Frequent sets come from FP-growth over the labelled urls; a rule must reach the support
    and the confidence and have the ``shape``, and is pruned where such a rule with fewer
    tokens is at least as confident. What the driver holds is the list of frequent tokens,
    at most (tokens of a url) / ``min_support`` of them at any input size. An empty table
    and one without a block give no rules.
    """
    labelled = labelled.where("blocked IS NOT NULL")
    baskets = labelled.select(
        F.when(F.col("blocked"), F.array_append("tokens", F.lit(BLOCKED))).otherwise(F.col("tokens")).alias("items")
    ).where(F.size("items") > 0)
    kinds = "rule_id bigint, needs array<string>, confidence double, support double"
    if not labelled.where("blocked").limit(1).count():
        return labelled.sparkSession.createDataFrame([], kinds)
    miner = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    if partitions:
        miner = miner.setNumPartitions(partitions)
    found = miner.fit(baskets).associationRules.where(F.element_at("consequent", 1) == BLOCKED)
    if shape:
        found = found.where(shape(F.col("antecedent")))
    found = written(
        found.select(F.array_sort("antecedent").alias("needs"), "confidence", "support").withColumn(
            "rule_id", F.xxhash64("needs")
        ),
        "url-rules",
    )
    # A rule is implied by the rule without one of its tokens if that one is as confident.
    parts = found.select(
        "rule_id",
        "confidence",
        F.explode(F.transform("needs", lambda t: F.xxhash64(F.array_remove("needs", t)))).alias("part"),
    )
    other = found.select(F.col("rule_id").alias("part"), F.col("confidence").alias("__c"))
    implied = parts.join(other, "part").where(F.col("__c") >= F.col("confidence")).select("rule_id").distinct()
    return written(found.join(implied, "rule_id", "left_anti").select("rule_id", "needs", "confidence", "support"), "url-kept")


def indexed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """``rules`` with ``token``, the one of their tokens that fewest of the urls hold."""
    needed = rules.select("rule_id", F.explode("needs").alias("token"))
    counts = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    held = needed.join(counts, "token", "left")
    rarest = held.groupBy("rule_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    return rules.join(rarest, "rule_id")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url`` and the best rule that fits it: ``needs``, ``confidence``. One row per distinct url that has one."""
    urls = urls.select("url", "tokens").distinct()
    index = written(indexed(rules, urls), "url-index")
    looked = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    fits = looked.where(F.size(F.array_except("needs", "tokens")) == 0)
    best = F.max_by(F.struct("needs", "confidence"), F.struct("confidence", "support", "rule_id"))
    return fits.groupBy("url").agg(best.alias("b")).select("url", "b.needs", "b.confidence")


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    rules: tuple[HostRule, ...] = RULES,
    min_support: float = 0.005,
    min_confidence: float = 0.9,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``mined`` (tokens) and ``confidence``.

    Urls that no curated rule names are blocked if a mined rule fits, and else allowed, as
    are NULL, empty and odd urls. Equal urls get equal verdicts. Columns of the
    result's names are replaced. Mined rules are matched per distinct url and joined back,
    so a host or url with most rows is counted before it moves.
    """
    names = ["host", "path", "rule", "verdict", "mined", "confidence"]
    rest = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in names]
    host, path = url_parts(F.col(url))
    split = pages.select(*rest, host.alias("host"), path.alias("path"))
    pattern, verdict = curated(F.col("host"), F.col("path"), rules)
    split = split.withColumn("rule", pattern).withColumn("verdict", verdict)
    labelled = split.select(
        F.col(url).alias("url"), url_tokens(F.col("host"), F.col("path")).alias("tokens"), F.col("verdict").alias("v")
    )
    mined = mine_rules(
        labelled.select("tokens", (F.col("v") == "block").alias("blocked")), min_support, min_confidence, shape=host_and_word
    )
    open_urls = labelled.where("v IS NULL AND size(tokens) > 0").select("url", "tokens")
    hits = matched(open_urls, mined).select(F.col("url").alias("__url"), F.col("needs").alias("mined"), "confidence")
    out = split.join(hits, F.col(url) == F.col("__url"), "left").drop("__url")
    return out.withColumn(
        "verdict", F.coalesce("verdict", F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    )
