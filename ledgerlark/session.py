"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the run-time work: it sizes reduce partitions, turns a
# join into a broadcast once the true size is known, and splits skewed join
# partitions even where that costs another exchange further up. One build
# compiles several hundred stages; the default cache of 100 would forget them
# between queries.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerlark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder.

    Where ``spark.checkpoint.dir`` is unset the warehouse folder is used, which the
    tables of the session share as well; no machine-local temporary folder is.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system it lives on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_path(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of another by renaming; the old one goes last."""
    place, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (target, staged))
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    old = f"{target}__old-{uuid.uuid4().hex}"
    had = store.exists(place)
    if had and not store.rename(place, spark._jvm.org.apache.hadoop.fs.Path(old)):
        raise OSError(f"{target} could not be moved aside")
    if not store.rename(new, place):
        raise OSError(f"{staged} could not be moved to {target}")
    if had:
        delete_path(spark, old)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
