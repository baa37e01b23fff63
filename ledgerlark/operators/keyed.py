"""A table that is merged on a key, batch by batch."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators.dedup import latest_per_key
from ledgerlark.operators.joins import splittable_join
from ledgerlark.sources.versions import PartedFolders, State, VersionLog

#: The bucket of rows without a whole key.
KEYLESS = "-1"


def bucket_of(keys: list[str], buckets: int) -> Column:
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    return F.when(missing, F.lit(-1)).otherwise(F.pmod(F.xxhash64(*keys), F.lit(buckets))).cast("int")


class KeyedTable:
    """Rows by key, the newest batch winning; built-in file tables have no MERGE.

    Keys are dealt over ``buckets`` by their hash. A batch is written once, parted by bucket, and counts as soon as
    the next state names it. Reading takes a bucket without newer batches as it is stored; only a bucket that
    has some is merged, and only :meth:`compact` writes a bucket anew. So a small batch costs
    its own rows when written, and the buckets it touched when read.

    A batch that was committed is not written again under the same id, so a retry changes nothing, whether
    the first try died before its commit or after it. Rows without a whole key match nothing: they are kept as they
    came, once per batch id.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.log = VersionLog(spark, path)
        self.schema, self.keys, self.buckets = schema, keys, buckets
        self.files = PartedFolders(self.log, schema, "stored_bucket", "int")

    def _state(self, version: int | None = None) -> State:
        empty = {"buckets": self.buckets, "batches": [], "base": {}, "deltas": [], "keyless": []}
        return self.log.state(version) or empty

    def write_batch(self, batch: DataFrame, batch_id: int | str, newest: list[Column | str]) -> bool:
        """Add a batch, in which the greatest ``newest`` of a key wins. False if it was there already."""
        state = self._state()
        if str(batch_id) in state["batches"]:
            return False
        unique = latest_per_key(batch.select(*self.schema.names), self.keys, newest)
        folder, buckets = self.files.write(unique.withColumn("stored_bucket", bucket_of(self.keys, state["buckets"])), f"batch-{batch_id}")

        def add(now: State | None) -> State | None:
            now = now or self._state()
            if str(batch_id) in now["batches"]:
                return None
            now["batches"].append(str(batch_id))
            if KEYLESS in buckets:
                now["keyless"].append(folder)
            if keyed := [b for b in buckets if b != KEYLESS]:
                now["deltas"].append([folder, keyed])
            return now

        return self.log.commit(add) is not None

    def _deltas(self, state: State, buckets: set[str]) -> DataFrame:
        """The rows of newer batches in some buckets, with ``__batch`` counting on."""
        frames = []
        for n, (folder, held) in enumerate(state["deltas"]):
            if some := buckets & set(held):
                frames.append(self.files.read(dict.fromkeys(some, folder)).withColumn("__batch", F.lit(n)))
        return reduce(DataFrame.union, frames)

    def _merged(self, state: State, buckets: set[str]) -> DataFrame:
        """The rows of open buckets: stored ones whose key is in no newer batch, and the newest of those."""
        newest = latest_per_key(self._deltas(state, buckets), self.keys, [F.col("__batch")]).drop("__batch")
        base = {b: f for b, f in state["base"].items() if b in buckets}
        if not base:
            return newest
        stored = self.files.read(base)
        return splittable_join(stored, newest.select(*self.keys), self.keys, "left_anti").select(*newest.columns).union(newest)

    def open_buckets(self, version: int | None = None, at_least: int = 1) -> set[str]:
        """Buckets that ``at_least`` so many batches have touched since they were written."""
        held = [b for _, buckets in self._state(version)["deltas"] for b in buckets]
        return {b for b in held if held.count(b) >= at_least}

    def read(self, version: int | None = None) -> DataFrame:
        """The merged table, as of a version; a frame keeps to the state that it was made from."""
        state = self._state(version)
        opened = {b for _, buckets in state["deltas"] for b in buckets}
        whole = self.files.read({b: f for b, f in state["base"].items() if b not in opened})
        if opened:
            whole = whole.union(self._merged(state, opened))
        for folder in state["keyless"]:
            whole = whole.union(self.files.read({KEYLESS: folder}))
        return whole.select(*self.schema.names)

    def compact(self, at_least: int = 1) -> set[str]:
        """Write the buckets with ``at_least`` so many newer batches anew, and no others; returns them."""
        state = self._state()
        buckets = self.open_buckets(at_least=at_least)
        if not buckets:
            return buckets
        folder, held = self.files.write(self._merged(state, buckets), "merged")
        seen = [f for f, _ in state["deltas"]]

        def replace(now: State | None) -> State | None:
            if now["base"] != state["base"]:
                raise RuntimeError("the table was compacted by someone else")
            now["base"].update(dict.fromkeys(held, folder))
            kept = [[f, [b for b in old if f not in seen or b not in buckets]] for f, old in now["deltas"]]
            now["deltas"] = [d for d in kept if d[1]]
            return now

        self.log.commit(replace)
        return buckets

    def expire(self, keep: int = 1) -> list[str]:
        """Forget all but the newest ``keep`` versions and delete what only older ones, or none, refer to."""

        def named(state: State) -> set[str]:
            held = [(f, b) for b, f in state["base"].items()] + [(f, KEYLESS) for f in state["keyless"]]
            return {f"{f}/stored_bucket={b}" for f, b in held + [(f, b) for f, buckets in state["deltas"] for b in buckets]}

        return self.log.expire(keep, named)
