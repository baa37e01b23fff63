"""Incremental loads: high-water scans and upserts on a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.dedup import latest_per_key, split_repeated
from ledgerlark.operators.joins import splittable_join
from ledgerlark.operators.revenue import AdHierarchy, attribute_clicks
from ledgerlark.sources.files import high_water_mark, newer_than


def build_visits(visits: DataFrame, hierarchy: AdHierarchy) -> DataFrame:
    """Visits with last-click attribution."""
    return attribute_clicks(visits.withColumnRenamed("id", "visit_id"), hierarchy).select(
        "visit_id", "visited_at", "customer_id", "gclid", "attributed_platform", "attributed_campaign_id",
        "attributed_campaign_name", "attributed_ad_id", "attributed_ad_name", "landing_page", "device_category",
        "_loaded_at",
    )


def new_visits(visits: DataFrame, target: DataFrame | None, lateness: str | None = None) -> DataFrame:
    """Visits beyond the newest loaded one.

    Strictly newer by default, so ties and late rows are left out. ``lateness``
    (an interval such as '2 hours') reads that far back again; the upsert keeps
    the repeated rows from doubling.
    """
    mark = None if target is None else high_water_mark(target, "visited_at")
    if mark is None or lateness is None:
        return newer_than(visits, "visited_at", mark)
    return visits.where(F.col("visited_at") > F.lit(mark) - F.expr(f"INTERVAL {lateness}"))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """Rows of ``target`` replaced by ``batch`` on ``keys``, plus the new keys.

    Within the batch the greatest ``newest`` wins. Planning starts no job; a batch
    whose keys turn out to be few is broadcast when it has been read.
    """
    latest = latest_per_key(batch, keys, newest)
    replaced = latest.select(*keys)
    return splittable_join(target, replaced, keys, "left_anti").select(*target.columns).unionByName(latest)


class UpsertTable:
    """A keyed table kept as one folder per batch and merged when read.

    Built-in file tables have no MERGE. Writing a batch costs only the batch and
    is idempotent: a retried batch overwrites its own folder, so a lost executor
    or a restarted driver cannot leave half a merge behind. Reading keeps the
    newest batch per key; :meth:`compact` folds the folders into a fresh table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str]):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys

    def _batches(self) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(stored).parquet(self.path)

    def write_batch(self, batch: DataFrame, batch_id: int, newest: list[Column]) -> None:
        unique = latest_per_key(batch.select(*self.schema.names), self.keys, newest)
        unique.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        """The merged table. Keys held by a single batch are read in place."""
        once, copies = split_repeated(self._batches(), self.keys)
        merged = latest_per_key(copies, self.keys, [F.col("batch_id")])
        return once.unionByName(merged).select(*self.schema.names)

    def high_water_mark(self, column: str, batches: Column | None = None):
        """Newest value stored, optionally only in some batches (a condition on ``batch_id``)."""
        stored = self._batches() if batches is None else self._batches().where(batches)
        return high_water_mark(stored, column)

    def compact(self, path: str) -> UpsertTable:
        """Write the merged rows to ``path`` as batch -1 of a new table."""
        self.read().write.mode("overwrite").parquet(f"{path}/batch_id=-1")
        return UpsertTable(self.spark, path, self.schema, self.keys)
