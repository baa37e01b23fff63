"""Scans and sinks over files and catalog tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed CSV scan: empty cells are NULL and a malformed row is an error."""
    return spark.read.schema(schema).csv(path, header=True, nullValue="", mode="FAILFAST")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, nullValue="")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """View sink: the staging layer stays lazy."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Full-refresh table sink; returns the stored table.

    Rows of a folder are brought together before writing, so there is no file
    per task and folder; rebalancing also cuts an oversized folder into several
    tasks, which a plain repartition by column would not.
    """
    placed = df.hint("rebalance", *partition_by) if partition_by else df
    placed.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_sorted(df: DataFrame, path: str, *by: str) -> DataFrame:
    """Full-refresh sink in global order: files hold ranges of ``by`` one after the other, each file sorted.

    A scan with a condition on ``by`` then skips the files, and the parts of files, whose range is elsewhere.
    """
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def freeze(tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Store every table of a version below ``folder``, views included.

    A later change of the inputs cannot alter a frozen version, so two of them
    can be compared.
    """
    return {name: write_table(df, f"{folder.rstrip('/')}/{name}") for name, df in tables.items()}


def high_water_mark(target: DataFrame, column: str) -> datetime | None:
    """Newest value already loaded: a scan of one column, combined per task."""
    return target.agg(F.max(column)).first()[0]


def newer_than(source: DataFrame, column: str, mark: datetime | None) -> DataFrame:
    """Rows strictly beyond the mark; everything when nothing was loaded yet.

    The mark is a literal, so the comparison is pushed into the file scan.
    """
    return source if mark is None else source.where(F.col(column) > F.lit(mark))


def freshness(
    df: DataFrame, source: str, loaded_at: str, as_of: Column, warn_hours: int, error_hours: int
) -> DataFrame:
    """Age of the newest load in whole hours, graded against the thresholds."""
    age = F.timestamp_diff("HOUR", F.col("max_loaded_at"), as_of)
    return (
        df.agg(F.max(loaded_at).alias("max_loaded_at"))
        .select(
            F.lit(source).alias("source"),
            "max_loaded_at",
            age.alias("age_hours"),
        )
        .withColumn(
            "status",
            F.when(F.col("age_hours").isNull() | (F.col("age_hours") >= error_hours), "error")
            .when(F.col("age_hours") >= warn_hours, "warn")
            .otherwise("pass"),
        )
    )
