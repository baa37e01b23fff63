"""Handling of rows that a loader delivers more than once."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.joins import all_of, splittable_join

LOAD_COLUMNS = ("_fivetran_synced",)


def _split_columns(df: DataFrame, keys: list[str], ignore: tuple[str, ...]):
    """Compared (non-key) and load-metadata columns; names match in any case."""
    ignored = {name.lower() for name in ignore}
    key_names = {name.lower() for name in keys}
    load = [c for c in df.columns if c.lower() in ignored]
    compared = [c for c in df.columns if c.lower() not in ignored | key_names]
    return compared, load


def _any_null(keys: list[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _no_null(keys: list[str]) -> Column:
    return all_of([F.col(k).isNotNull() for k in keys])


def _payload(columns: list[str]) -> Column:
    """Struct to compare; a bare literal keeps it valid when there are no columns."""
    return F.struct(*[F.col(c) for c in columns]) if columns else F.struct(F.lit(0).alias("none"))


def _versions(df: DataFrame, keys: list[str], ignore: tuple[str, ...]) -> DataFrame:
    """Per complete key: smallest and largest version, row count, latest load.

    Two versions differ exactly when the smallest and the largest do, so no
    distinct count (and no second shuffle) is needed. Every map task sends at
    most one row per key, so copies of a hot key collapse before the shuffle.
    """
    compared, load = _split_columns(df, keys, ignore)
    version = _payload(compared)
    return (
        df.where(_no_null(keys))
        .groupBy(*keys)
        .agg(
            F.min(version).alias("__low"),
            F.max(version).alias("__high"),
            F.count(F.lit(1)).alias("__rows"),
            F.max(_payload(load)).alias("__load"),
        )
    )


_CONFLICT = "NOT (__low <=> __high)"


def _agreed(df: DataFrame, keys: list[str], ignore: tuple[str, ...]) -> DataFrame:
    """One row per complete key whose copies agree, with the newest load metadata."""
    compared, load = _split_columns(df, keys, ignore)
    return (
        _versions(df, keys, ignore)
        .where("__low <=> __high")
        .select(
            *[
                F.col(f"__low.`{c}`").alias(c) if c in compared
                else F.col(f"__load.`{c}`").alias(c) if c in load
                else F.col(c)
                for c in df.columns
            ]
        )
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Complete keys that occur more than once; only the key columns are read and shuffled."""
    return duplicate_keys(df, keys).select(*keys)


def split_repeated(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key occurs once or is incomplete, and rows of repeated keys."""
    repeated = repeated_keys(df, keys)
    once = splittable_join(df, repeated, keys, "left_anti").select(*df.columns)
    copies = splittable_join(df, repeated, keys, "left_semi").select(*df.columns)
    return once, copies


def dedup_source(df: DataFrame, keys: list[str], ignore: tuple[str, ...] = LOAD_COLUMNS) -> DataFrame:
    """One row per key when all copies agree, none when they conflict.

    Copies are compared on every column outside ``ignore``; the newest load
    metadata is kept. Rows with a NULL key part pass through untouched so that
    not-null checks downstream still see them. A single aggregate over whole rows,
    combined before the shuffle: every row moves once and no job runs while planning.
    """
    return _agreed(df, keys, ignore).unionByName(df.where(_any_null(keys)))


def conflicting_keys(df: DataFrame, keys: list[str], ignore: tuple[str, ...] = LOAD_COLUMNS) -> DataFrame:
    """Keys that carry two or more different versions."""
    return _versions(df, keys, ignore).where(_CONFLICT).select(*keys)


def conflicting_rows(df: DataFrame, keys: list[str], ignore: tuple[str, ...] = LOAD_COLUMNS) -> DataFrame:
    """Every row behind a conflicting key: the quarantine table of a source."""
    return splittable_join(df, conflicting_keys(df, keys, ignore), keys, "left_semi").select(*df.columns)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Complete keys that occur more than once, with their row count."""
    return (
        df.where(_no_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)
    )


def duplicate_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row behind a duplicated key, identical copies included."""
    return splittable_join(df, repeated_keys(df, keys), keys, "left_semi").select(*df.columns)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the greatest ``order`` per key; a row without a whole key matches nothing and stays.

    ``max_by`` combines on the map side; a row_number window would first send
    all rows of a key to one task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*order)).alias("__newest")
    keyed = df.where(_no_null(keys)).groupBy(*keys).agg(newest).select(*keys, "__newest.*").select(*df.columns)
    return keyed.unionByName(df.where(_any_null(keys)))


def quarantine_report(sources: dict[str, tuple[DataFrame, list[str]]], ignore=LOAD_COLUMNS) -> DataFrame:
    """Per source: keys re-delivered, keys in conflict, rows held back."""
    reports = []
    for name, (df, keys) in sources.items():
        conflict = F.expr(_CONFLICT)
        reports.append(
            _versions(df, keys, ignore)
            .where("__rows > 1")
            .agg(
                F.count(F.lit(1)).alias("duplicate_keys"),
                F.count(F.when(conflict, 1)).alias("conflicting_keys"),
                F.coalesce(F.sum(F.when(conflict, F.col("__rows"))), F.lit(0)).alias("conflicting_rows"),
            )
            .select(F.lit(name).alias("source"), "*")
        )
    return reduce(DataFrame.unionByName, reports)
