"""Join shapes that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "__join_spread"


def splittable_join(big: DataFrame, other: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join whose hot keys the adaptive skew rule is able to split.

    That rule cuts an oversized reduce partition into several tasks, but only
    when both join inputs are fresh shuffles. An input that is already
    partitioned by the key (an aggregate or an earlier join on it) would be
    used as it is and the rule would not fire. Joining on a second column
    computed from the key keeps the same matches while giving each input its
    own exchange. ``big`` must be the left input: for outer and semi joins only
    the preserved side can be cut. Small inputs are still broadcast by size.
    """
    left = big.withColumn(_SPREAD, F.xxhash64(*on))
    right = other.withColumn(_SPREAD, F.xxhash64(*on))
    return left.join(right, [*on, _SPREAD], how).drop(_SPREAD)


def left_join_many(one: DataFrame, many: DataFrame, on: list[str]) -> DataFrame:
    """``one LEFT JOIN many`` where a single row of ``one`` may match very many.

    A left outer join can only split its left input, so a hot key on the right
    would land in one task. Matches come from a splittable inner join; rows
    without a match from an anti join against the distinct keys, which are
    combined before they are shuffled.
    """
    matched = splittable_join(many, one, on).select(*one.columns, *[c for c in many.columns if c not in on])
    unmatched = one.join(many.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def all_of(conditions: list):
    return reduce(and_, conditions)
