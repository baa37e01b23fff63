"""Version history that is stored between runs, without rewriting what is closed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.history import check_changes, empty_history, timestamp_changes
from ledgerlark.session import delete_path
from ledgerlark.sources.versions import PartedFolders, State, VersionLog


@dataclass(frozen=True)
class Run:
    """What one run did: versions it opened and closed, and buckets of open versions it wrote anew."""

    opened: int = 0
    closed: int = 0
    buckets: int = 0


class HistoryTable:
    """Slowly changing dimension, type 2, as a stored table.

    Open versions lie in buckets by the hash of their key, closed ones in a folder per run. A run compares its
    rows with the open versions, appends what it closes, and writes anew only the buckets of open versions in which
    something changed; closed versions are never read or written again. Rows that change nothing write
    nothing, so a repeated run is a no-op, and a run that died before its commit left nothing that is read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.log = VersionLog(spark, path)
        self.keys, self.buckets = keys, buckets
        self.schema = empty_history(spark.createDataFrame([], schema)).schema
        self.names = schema.names
        self.open = PartedFolders(self.log, self.schema, "stored_bucket", "int")

    def _state(self, version: int | None = None) -> State:
        return self.log.state(version) or {"buckets": self.buckets, "open": {}, "closed": [], "runs": []}

    def _bucket(self, state: State) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(state["buckets"])).cast("int")

    def open_versions(self, version: int | None = None) -> DataFrame:
        return self.open.read(self._state(version)["open"]).drop("stored_bucket")

    def read(self, version: int | None = None) -> DataFrame:
        """All versions, open and closed, as of a version of the table."""
        whole, spark = self.open_versions(version), self.log.spark
        for folder in self._state(version)["closed"]:
            whole = whole.union(spark.read.schema(self.schema).parquet(f"{self.log.path}/{folder}"))
        return whole

    def snapshot_by_check(self, incoming: DataFrame, check: list[str], run_at: str, close_missing: bool = True) -> Run:
        """A run at the time ``run_at``: a new version where one of ``check`` changed. See ``history.snapshot_by_check``."""
        return self._run(run_at, lambda old: check_changes(old, incoming.select(*self.names), self.keys, check, _time(run_at), close_missing))

    def snapshot_by_timestamp(self, incoming: DataFrame, updated_at: str, run_at: str, close_missing: bool = True) -> Run:
        """A run at ``run_at``: a new version where ``updated_at`` is newer. See ``history.snapshot_by_timestamp``."""
        return self._run(
            run_at, lambda old: timestamp_changes(old, incoming.select(*self.names), self.keys, updated_at, _time(run_at), close_missing)
        )

    def _run(self, run_at: str, compare: Callable[[DataFrame], DataFrame]) -> Run:
        state = self._state()
        if run_at in state["runs"]:  # a retry of a run that was committed
            return Run()
        spark, columns = self.log.spark, self.schema.names
        staged = self.log.folder("changes")
        changes = compare(self.open.read(state["open"]).drop("stored_bucket")).where("change <> 'kept'")
        changes.withColumn("stored_bucket", self._bucket(state)).write.parquet(f"{self.log.path}/{staged}")
        schema = T.StructType([*self.schema.fields, T.StructField("change", T.StringType()), T.StructField("stored_bucket", T.IntegerType())])
        changes = spark.read.schema(schema).parquet(f"{self.log.path}/{staged}")
        counted = changes.groupBy("stored_bucket").agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("opened", "closed")]).collect()
        run = Run(sum(r.opened for r in counted), sum(r.closed for r in counted), len(counted))
        if counted:
            touched = {str(r.stored_bucket) for r in counted}
            ended = changes.where("change = 'closed'")
            closed = self.log.folder("closed")
            if run.closed:
                ended.select(*columns).write.parquet(f"{self.log.path}/{closed}")
            still = self.open.read({b: f for b, f in state["open"].items() if b in touched})
            still = still.join(ended.select("scd_id"), "scd_id", "left_anti").select(*columns, "stored_bucket")
            fresh = still.union(changes.where("change = 'opened'").select(*columns, "stored_bucket"))
            folder, held = self.open.write(fresh, "open")

            def replace(now: State | None) -> State:
                if (now or self._state())["open"] != state["open"]:
                    raise RuntimeError("another run changed the history meanwhile")
                left = {b: f for b, f in state["open"].items() if b not in touched}
                return {
                    **state,
                    "open": {**left, **dict.fromkeys(held, folder)},
                    "closed": [*state["closed"], *([closed] if run.closed else [])],
                    "runs": [*state["runs"], run_at],
                }

            self.log.commit(replace)
        delete_path(spark, f"{self.log.path}/{staged}")
        return run

    def expire(self, keep: int = 1) -> list[str]:
        """Forget all but the newest ``keep`` versions of the table and delete what no version left refers to."""
        return self.log.expire(keep, lambda s: {*(f"{f}/stored_bucket={b}" for b, f in s["open"].items()), *s["closed"]})


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp")
