"""Quality rules whose cutoffs carry a guarantee.

Base limits reject a document outright. On top of them, each rule rejects values above
a cutoff, and the cutoff is *selected*: within every stratum, cutoffs are tried from
lenient to strict on labelled good documents, and a stricter one is accepted only while an
exact binomial test shows that the share of good documents it rejects is below the risk.
The order of the cutoffs is fixed beforehand, so no correction is due within one rule;
across rules and strata the error rate is divided among all tests (Bonferroni), and the
risk is divided among the rules, so that all rules together reject at most ``risk`` of
the good documents of a stratum, with probability 1 - ``error`` for all strata at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import per_text, with_struct, written

FEATURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, n_shouted bigint"
)
FEATURE_NAMES = [f.split()[0] for f in FEATURES.split(", ")]
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class RatioRule:
    """Rejects where over/under is above the cutoff; cutoffs go from lenient to strict."""

    name: str
    over: str
    under: str
    cutoffs: tuple[float, ...]


def _steps(first: float, last: float, n: int = 24) -> tuple[float, ...]:
    return tuple(float(x) for x in np.geomspace(first, last, n))


RULES = (
    RatioRule("symbols", "n_symbols", "n_words", _steps(10, 0.02)),
    RatioRule("dup_lines", "n_dup_lines", "n_lines", _steps(0.99, 0.02)),
    RatioRule("repeats", "n_repeat_words", "n_words", _steps(0.99, 0.01)),
    RatioRule("shouting", "n_shouted", "n_words", _steps(0.99, 0.02)),
    RatioRule("word_length", "word_chars", "n_words", _steps(60, 4)),
)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of five words which occurs twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    bits = max(1, (len(ids) - 1).bit_length())
    if bits * WINDOW <= 63:  # a window fits one integer
        left = sum(codes[k : k + n] << (bits * k) for k in range(WINDOW))
        if len(set(left.tolist())) == n:
            return 0
        _, left = np.unique(left, return_inverse=True)
    else:  # windows grow word by word and are renumbered each time
        left = codes
        for size in range(1, WINDOW):
            _, left = np.unique(left[: len(words) - size] * len(words) + codes[size:], return_inverse=True)
    often = np.bincount(left)[left] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(often), 1)
    np.add.at(edges, np.flatnonzero(often) + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def features_of(data: bytes) -> tuple:
    words = data.split()  # on the six ASCII white-space bytes
    lines = [line for line in data.split(b"\n") if line.strip()]
    body = b"".join(words)
    return (
        len(words),
        len(body) if body.isascii() else len(body.decode()),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(map(bytes.isupper, words)),
    )


def text_features(text: Column) -> Column:
    return per_text(lambda: features_of, FEATURES)(text)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def ratio(rule: RatioRule) -> Column:
    """0 where the document has nothing to divide by."""
    return F.coalesce(F.try_divide(F.col(rule.over).cast("double"), F.col(rule.under).cast("double")), F.lit(0.0))


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exact to rounding, summed from its largest term down."""
    if k >= n:
        return 1.0
    if k >= n * p:  # above the mean: no small tail, and no test passes
        return 1.0
    log_term = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term = total = math.exp(log_term)
    for i in range(k, 0, -1):
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        if term < total * 1e-17:
            break
    return min(1.0, total)


def selected(n: int, rejected: list[int], cutoffs: tuple[float, ...], risk: float, error: float) -> float | None:
    """The strictest cutoff before the first whose false-rejection rate is not shown to be below ``risk``."""
    chosen = None
    for cutoff, k in zip(cutoffs, rejected, strict=True):
        if binomial_tail(n, int(k), risk) > error:
            break
        chosen = cutoff
    return chosen


def select_cutoffs(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    good: str = "quality",
    rules: tuple[RatioRule, ...] = RULES,
    risk: float = 0.02,
    error: float = 0.05,
) -> DataFrame:
    """One row per stratum: ``stratum``, ``n_good`` and a cutoff per rule (NULL: rule off).

    All labelled documents that pass the base limits are the holdout; nothing else is
    fitted on them. A document with several labels is good only if all say so; NULL
    labels count as absent, and labels without a document are ignored. NULL strata form
    one stratum, an empty holdout gives an empty table. Counts are summed before the
    shuffle, so a stratum with most rows is no hot key.
    """
    votes = labels.where(F.col(good).isNotNull() & F.col(key).isNotNull())
    votes = votes.groupBy(F.col(key).alias("__key")).agg(F.min(good).alias("__good")).where("__good = 1")
    seen = docs.select(F.col(key).alias("__key"), F.col(stratum).alias("__stratum"), text_features(F.col(text)).alias("f"))
    seen = seen.select("__key", "__stratum", *[f"f.{n}" for n in FEATURE_NAMES]).where(~base_failed())
    rates = [ratio(r).alias(r.name) for r in rules]
    held = seen.select("__key", "__stratum", *rates).join(votes.select("__key"), "__key", "left_semi")
    counts = held.groupBy("__stratum").agg(
        F.count(F.lit(1)).alias("n_good"),
        *[
            F.array(*[F.sum((F.col(r.name) > c).cast("bigint")) for c in r.cutoffs]).alias(f"over_{r.name}")
            for r in rules
        ],
    )
    counted = written(counts, "quality-counts")
    tests = len(rules) * max(1, counted.count())

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame({"stratum": batch["__stratum"], "n_good": batch["n_good"]})
            for r in rules:
                cut = [
                    selected(int(n), list(k), r.cutoffs, risk / len(rules), error / tests)
                    for n, k in zip(batch["n_good"], batch[f"over_{r.name}"], strict=True)
                ]
                out[r.name] = pd.array(cut, dtype="Float64")
            yield out

    kinds = ", ".join(f"{r.name} double" for r in rules)
    return written(counted.mapInPandas(choose, f"stratum string, n_good bigint, {kinds}"), "quality-cutoffs")


def judge(
    docs: DataFrame,
    cutoffs: DataFrame,
    text: str = "text",
    stratum: str = "lang",
    rules: tuple[RatioRule, ...] = RULES,
) -> DataFrame:
    """``docs`` with the features, ``base_failed`` and ``kept``; columns of those names are replaced.

    A NULL or empty text has no words and fails the base limits. A stratum without
    cutoffs keeps whatever passes the base limits. Rows stay where they are.
    """
    found = with_struct(docs, text_features(F.col(text)), FEATURE_NAMES)
    cut = cutoffs.select(F.col("stratum").alias("__s"), *[F.col(r.name).alias(f"__{r.name}") for r in rules])
    joined = found.join(cut, F.col(stratum).eqNullSafe(F.col("__s")), "left")
    over = F.lit(False)
    for r in rules:
        over = over | F.coalesce(ratio(r) > F.col(f"__{r.name}"), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~over).drop(
        *cut.columns
    )
