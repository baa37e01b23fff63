"""Proportional allocation of a total over the rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.money import safe_divide
from ledgerlark.operators.joins import splittable_join


def allocate_proportional(
    rows: DataFrame,
    totals: DataFrame,
    group: list[str],
    weight: str,
    total: str,
    order: list[str],
    into: str = "allocated",
    places: int = 2,
) -> DataFrame:
    """Split each group's ``total`` by ``weight``; the last row takes the rounding residual.

    Rows of a NULL group share that group's total; where the weights add up to zero or
    NULL the last row takes all, so the parts always sum to the whole. ``totals`` holds one row per group and ``order`` must identify a row within
    its group. Everything a row needs to know about its group is first brought
    into one row per group, from the key and weight columns alone, so whole rows
    meet their group once. These are aggregates joined back rather than windows:
    a group of any size is summed in parallel and its rows stay spread over tasks.
    """
    amount = T.DecimalType(18, places)
    key: Column = F.struct(*[F.col(c) for c in order])
    # A struct is equal to itself even where its fields are NULL.
    whole = F.struct(*[F.col(c) for c in group]).alias("__group")
    sums = rows.groupBy(whole).agg(F.sum(weight).alias("__weights"), F.max(key).alias("__last"))
    sums = sums.join(totals.select(whole, F.col(total).alias("__total")), "__group", "left")

    def share() -> Column:
        weighted = F.col("__total").cast("double") * F.col(weight).cast("double")
        return F.when(F.col("__total").isNotNull(), F.coalesce(safe_divide(weighted, F.col("__weights")), F.lit(0.0))).cast(amount)

    shares = splittable_join(rows.select(whole, weight), sums.drop("__last"), ["__group"]).withColumn("__share", share())
    handed_out = shares.groupBy("__group").agg(F.sum("__share").alias("__handed_out"))
    per_group = sums.join(handed_out, "__group")
    residual = (F.col("__total") - F.col("__handed_out")).cast(amount)
    value = F.when(key == F.col("__last"), share() + residual).otherwise(share())
    return splittable_join(rows.withColumn("__group", whole), per_group, ["__group"]).select(*rows.columns, value.cast(amount).alias(into))
