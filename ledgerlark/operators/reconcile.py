"""Comparing two versions of a table and tracking quarantined keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IGNORED_PREFIXES = ("dbt_",)


def comparable_columns(a: DataFrame, b: DataFrame, ignored=IGNORED_PREFIXES) -> list[str]:
    """Shared columns, without build metadata that differs between any two runs."""
    return [c for c in a.columns if c in b.columns and not c.startswith(tuple(ignored))]


def _row_counts(a: DataFrame, b: DataFrame, ignored) -> DataFrame:
    """Each distinct row with its number of copies on either side.

    Both directions of a multiset difference come out of this one shuffle, and
    copies of a row are counted before they are sent.
    """
    columns = comparable_columns(a, b, ignored)
    one, none = F.lit(1), F.lit(0)
    both = a.select(*columns, one.alias("__a"), none.alias("__b")).unionByName(
        b.select(*columns, none.alias("__a"), one.alias("__b"))
    )
    return both.groupBy(*columns).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))


def table_diff(a: DataFrame, b: DataFrame, name: str, ignored=IGNORED_PREFIXES) -> DataFrame:
    """One row: sizes, rows found on one side only, and whether anything changed.

    A duplicated row is a difference, and so is an added or dropped column.
    """
    columns_changed = sorted(set(a.columns) ^ set(b.columns))
    surplus = F.col("__a") - F.col("__b")
    totals = _row_counts(a, b, ignored).agg(
        *[
            F.coalesce(F.sum(value), F.lit(0)).alias(label)
            for label, value in (
                ("rows_a", F.col("__a")),
                ("rows_b", F.col("__b")),
                ("only_a", F.greatest(surplus, F.lit(0))),
                ("only_b", F.greatest(-surplus, F.lit(0))),
            )
        ]
    )
    changed = (F.col("only_a") > 0) | (F.col("only_b") > 0) | F.lit(bool(columns_changed))
    return totals.select(
        F.lit(name).alias("table"),
        "*",
        F.lit(",".join(columns_changed)).alias("columns_changed"),
        F.when(changed, "changed").otherwise("same").alias("status"),
    )


def diff_tables(before: dict[str, DataFrame], after: dict[str, DataFrame], ignored=IGNORED_PREFIXES) -> DataFrame:
    """:func:`table_diff` for every table; tables on one side only are named."""
    shared = [table_diff(before[n], after[n], n, ignored) for n in sorted(set(before) & set(after))]
    lone = [
        (before if n in before else after)[n].limit(1).agg(F.count(F.lit(1))).select(
            F.lit(n).alias("table"),
            *[F.lit(None).cast("bigint").alias(c) for c in ("rows_a", "rows_b", "only_a", "only_b")],
            F.lit("").alias("columns_changed"),
            F.lit("only_in_a" if n in before else "only_in_b").alias("status"),
        )
        for n in sorted(set(before) ^ set(after))
    ]
    return reduce(DataFrame.unionByName, shared + lone)


def unexpected_changes(diff: DataFrame, allowed: list[str]) -> DataFrame:
    """Changed tables outside the list of those that may change."""
    return diff.where((F.col("status") != "same") & ~F.col("table").isin(*allowed))


def row_diff(a: DataFrame, b: DataFrame, ignored=IGNORED_PREFIXES, limit: int | None = None) -> DataFrame:
    """Rows with more copies on one side, and how many more.

    The surplus is a number rather than repeated rows, so a heavily copied row
    stays one row. ``limit`` returns a sample in column order.
    """
    columns = comparable_columns(a, b, ignored)
    surplus = F.col("__a") - F.col("__b")
    diff = (
        _row_counts(a, b, ignored)
        .where(surplus != 0)
        .select(F.when(surplus > 0, "a").otherwise("b").alias("only_in"), F.abs(surplus).alias("copies"), *columns)
    )
    return diff if limit is None else diff.orderBy("only_in", *columns).limit(limit)


def version_counts(versions: dict[str, DataFrame]) -> DataFrame:
    """Row count per version of a table."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(v).alias("version"), "rows") for v, df in versions.items()]
    return reduce(DataFrame.unionByName, counts)


def row_loss(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Tables that return fewer rows than before."""
    counts = []
    for name in sorted(set(before) & set(after)):
        flags = before[name].select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionAll(
            after[name].select(F.lit(0).alias("b"), F.lit(1).alias("a"))
        )
        counts.append(
            flags.agg(
                F.coalesce(F.sum("b"), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("a"), F.lit(0)).alias("rows_after")
            ).select(F.lit(name).alias("table"), "*")
        )
    lost = F.col("rows_before") - F.col("rows_after")
    return reduce(DataFrame.unionByName, counts).withColumn("rows_lost", lost).where(F.col("rows_lost") > 0)


def quarantine_transition(previous: DataFrame, current: DataFrame, checked: DataFrame) -> DataFrame:
    """What happened to each source's set of quarantined keys since the last run.

    ``previous`` and ``current`` hold (source, key); ``checked`` holds (source,
    status) of this run's conflict check. opened / refreshed (same keys) /
    changed / resolved. Only a check that ran and passed resolves a source.
    """
    before, now = F.col("before"), F.col("now")
    keys = (
        previous.select("source", "key", F.lit(1).alias("before"), F.lit(0).alias("now"))
        .unionByName(current.select("source", "key", F.lit(0).alias("before"), F.lit(1).alias("now")))
        .groupBy("source", "key")
        .agg(F.max("before").alias("before"), F.max("now").alias("now"))
    )
    per_source = keys.groupBy("source").agg(
        F.sum("before").alias("keys_before"),
        F.sum("now").alias("keys_now"),
        F.count(F.when(before != now, 1)).alias("keys_changed"),
    )
    status = (
        F.when((F.col("keys_now") > 0) & (F.col("keys_before") == 0), "opened")
        .when((F.col("keys_now") > 0) & (F.col("keys_changed") == 0), "refreshed")
        .when(F.col("keys_now") > 0, "changed")
        .when(F.col("status") == "pass", "resolved")
        .otherwise("unchanged")
    )
    return per_source.join(checked, "source", "left").select(
        "source", "keys_before", "keys_now", "keys_changed", status.alias("transition")
    )
