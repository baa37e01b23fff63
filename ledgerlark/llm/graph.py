"""Connected components of a link table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import delete_path, scratch_path


def _stored(df: DataFrame, previous: str | None) -> tuple[DataFrame, str, tuple]:
    """``df`` written and read back, its row count and checksum; the table before it is removed."""
    spark = df.sparkSession
    path = scratch_path(spark, "links")
    df.write.parquet(path)
    df = spark.read.schema(df.schema).parquet(path)
    mark = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    if previous:
        delete_path(spark, previous)
    return df, path, tuple(mark)


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component``: every node of ``links`` (a, b) with the smallest node it can reach.

    Alternates two steps until the links no longer change. First every node passes its
    smallest neighbour on to its larger neighbours, then every node does the same among its
    smaller ones; both keep what is connected connected, and what remains are stars around
    the smallest nodes. The number of rounds grows with the logarithm of the longest
    path. Minima are combined before the shuffle and handed back by joins, so a node with
    very many neighbours is never gathered in one group.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs, path, mark = _stored(pairs, None)
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).distinct()
        pairs, path, new = _stored(small, path)
        if new == mark:
            break
        mark = new
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
