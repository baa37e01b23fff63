"""Data-quality checks. A check turns a frame into the rows that violate it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.dedup import conflicting_rows, duplicate_keys
from ledgerlark.operators.joins import splittable_join
from ledgerlark.session import delete_path, replace_path
from ledgerlark.sources.files import write_table
from ledgerlark.sources.published import PublishedTable

ERROR, WARN = "error", "warn"


# Row-local conditions. Comparisons with NULL are neither true nor false, so
# only the null checks themselves report a NULL.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_negative(column: str) -> Column:
    """Violation of ``positive_value``; zero is allowed."""
    return F.col(column) < 0


def is_outside(column: str, low, high) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def is_not_one_of(column: str, values: list) -> Column:
    return ~F.col(column).isin(*values)


def is_not_one_of_if(column: str, values: list, status: str, value: str) -> Column:
    return (F.col(status) == value) & ~F.col(column).isin(*values)


def is_missing_if(column: str, status: str, value: str) -> Column:
    return (F.col(status) == value) & F.col(column).isNull()


# Violations as frames.


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_missing(column))


def positive_value(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_negative(column))




def range_check(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where(is_outside(column, low, high))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Unexpected values with their row count."""
    return (
        df.where(is_not_one_of(column, values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def accepted_values_if_status(df: DataFrame, column: str, values: list, status: str, value: str) -> DataFrame:
    return df.where(is_not_one_of_if(column, values, status, value))


def not_null_if_active(df: DataFrame, column: str, status: str, value: str) -> DataFrame:
    return df.where(is_missing_if(column, status, value))


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    return df.where(~F.expr(expression))


def unique(df: DataFrame, column: str) -> DataFrame:
    return duplicate_keys(df, [column]).withColumnRenamed(column, "unique_field")


def unique_if_active(df: DataFrame, column: str, status: str, value: str) -> DataFrame:
    return unique(df.where(F.col(status) == value), column)


def unique_combination_of_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Repeated column combinations; NULLs group together."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def no_conflicting_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return conflicting_rows(df, keys)


def relationships(df: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent row."""
    children = df.where(F.col(column).isNotNull())
    keys = parent.select(F.col(field_name).alias(column)).where(F.col(column).isNotNull()).distinct()
    return splittable_join(children, keys, [column], "left_anti").select(*df.columns)


def at_least_one(df: DataFrame, column: str) -> DataFrame:
    """One row when the column holds no value at all."""
    return df.agg(F.count(column).alias("filled")).where(F.col("filled") == 0)


@dataclass(frozen=True)
class Check:
    """A named check on one table.

    ``violates`` is a row-local condition; ``find`` returns violating rows and
    is used for checks that need a shuffle of their own. Exactly one is set.
    """

    name: str
    table: str
    column: str
    severity: str = ERROR
    violates: Callable[[], Column] | None = None
    find: Callable[[dict[str, DataFrame]], DataFrame] | None = field(default=None, compare=False)

    def violations(self, tables: dict[str, DataFrame]) -> DataFrame:
        return self.find(tables) if self.find else tables[self.table].where(self.violates())


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: check, table, column, severity, failures, status.

    All row-local checks of a table share a single pass over it.
    """
    by_table: dict[str, list[Check]] = {}
    counted = []
    for check in checks:
        if check.violates is not None:
            by_table.setdefault(check.table, []).append(check)
        else:
            counted.append(_labelled(check, check.violations(tables).agg(F.count(F.lit(1)).alias("failures"))))
    for table, local in by_table.items():
        totals = tables[table].agg(
            *[F.count(F.when(check.violates(), 1)).alias(f"c{i}") for i, check in enumerate(local)]
        )
        rows = F.array(
            *[
                F.struct(*_label_columns(check), F.col(f"c{i}").alias("failures"))
                for i, check in enumerate(local)
            ]
        )
        counted.append(totals.select(F.explode(rows).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, counted).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").when(F.col("severity") == WARN, "warn").otherwise("fail")
    )


def _label_columns(check: Check) -> list[Column]:
    return [
        F.lit(check.name).alias("check"),
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.severity).alias("severity"),
    ]


def _labelled(check: Check, failures: DataFrame) -> DataFrame:
    return failures.select(*_label_columns(check), "failures")


def stored_failures(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Violating rows of several checks in one shape, each row as JSON.

    All row-local checks of a table share one pass over it: a row is repeated once per check that it fails. Only
    checks that need a shuffle of their own read their table again.
    """
    frames, by_table = [], {}
    for check in checks:
        if check.violates is None:
            rows = check.violations(tables)
            frames.append(rows.select(F.lit(check.name).alias("check"), F.lit(check.table).alias("table"), _as_json(rows)))
        else:
            by_table.setdefault(check.table, []).append(check)
    for table, local in by_table.items():
        rows = tables[table]
        failed = F.array_compact(F.array(*[F.when(check.violates(), F.lit(check.name)) for check in local]))
        told = rows.select(failed.alias("failed"), _as_json(rows)).where(F.size("failed") > 0)
        frames.append(told.select(F.explode("failed").alias("check"), F.lit(table).alias("table"), "row"))
    return reduce(DataFrame.unionByName, frames)


def _as_json(rows: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("row")


def store_failures(tables: dict[str, DataFrame], checks: list[Check], path: str) -> DataFrame:
    """Keep the violating rows, one partition folder per check."""
    return write_table(stored_failures(tables, checks), path, ("check",))


def publish_if_clean(df: DataFrame, name: str, checks: list[Check], path: str, others=None) -> tuple[bool, list]:
    """Write ``df`` only when no error-severity check fails; warnings pass.

    The frame is written once, to a staging folder next to the target, and checked
    there, so the checked rows are the published rows. A clean one takes the
    target's place by renaming; what was published before is removed only after
    that, and a failing one leaves it untouched. Returns whether it was published
    and the summary rows.
    """
    spark, target = df.sparkSession, path.rstrip("/")
    staged = f"{target}__staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    stored = spark.read.schema(df.schema).parquet(staged)
    summary = run_checks({**(others or {}), name: stored}, checks).collect()
    clean = all(row["status"] != "fail" for row in summary)
    if clean:
        replace_path(spark, staged, target)
    else:
        delete_path(spark, staged)
    return clean, summary


def publish_version_if_clean(df: DataFrame, name: str, checks: list[Check], table: PublishedTable, others=None) -> tuple[bool, list]:
    """Publish ``df`` as the next version of ``table`` if no error-severity check fails; warnings pass.

    The rows are stored first and checked as stored, so the checked rows are the published rows. Readers see the
    version before until the pointer moves; a version with a failing check is never pointed at. Returns
    whether it was published and the summary rows.
    """
    folder, stored = table.stage(df)
    summary = run_checks({**(others or {}), name: stored}, checks).collect()
    clean = all(row["status"] != "fail" for row in summary)
    if clean:
        table.publish(folder, stored.schema)
    else:
        delete_path(df.sparkSession, f"{table.log.path}/{folder}")
    return clean, summary
