"""A table that is replaced whole, with a pointer to the version that counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlark.sources.versions import State, VersionLog


class PublishedTable:
    """Whole versions in folders of their own; the newest state points at the one that counts.

    Publishing moves the pointer by one rename, so at any moment there is a whole table, and a reader that has
    begun keeps its version until :meth:`expire` lets go of it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.log = VersionLog(spark, path)

    def stage(self, df: DataFrame) -> tuple[str, DataFrame]:
        """Write rows that are not published yet: their folder, and the stored frame."""
        folder = self.log.folder("version")
        df.write.parquet(f"{self.log.path}/{folder}")
        return folder, self.log.spark.read.schema(df.schema).parquet(f"{self.log.path}/{folder}")

    def publish(self, folder: str, schema: T.StructType) -> int | None:
        return self.log.commit(lambda now: {"folder": folder, "schema": schema.jsonValue()})

    def read(self, version: int | None = None) -> DataFrame | None:
        """The published rows, or None where nothing was published."""
        state: State | None = self.log.state(version)
        if state is None:
            return None
        schema = T.StructType.fromJson(state["schema"])
        return self.log.spark.read.schema(schema).parquet(f"{self.log.path}/{state['folder']}")

    def expire(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` versions, and what was staged and never published."""
        return self.log.expire(keep, lambda s: {s["folder"]})
