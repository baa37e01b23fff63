"""Quarantined keys from run to run, with a fingerprint of every source's set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.sources.versions import PartedFolders, State, VersionLog

REPORT = "source string, keys_before bigint, keys_now bigint, keys_changed bigint, transition string, compared boolean"


def fingerprint(key: Column | str) -> Column:
    """128 bits of a set of keys that don't depend on their order: two sums of 64-bit hashes, modulo 2^64 each.

    An aggregate that combines before the shuffle. Equal sets agree; others do with a chance of about 2^-128.
    """
    sums = [F.sum(F.xxhash64(F.lit(seed), key).cast("decimal(38,0)")) for seed in (1, 2)]
    return F.concat_ws(":", *[F.pmod(F.coalesce(s, F.lit(0)), F.lit(str(2**64)).cast("decimal(20,0)")).cast("string") for s in sums])


class QuarantineTable:
    """The keys that each source holds back, stored per run.

    A run stores its keys once and sums them up per source. A source whose fingerprint is that of the run before is
    told from one row; keys are compared only where the fingerprints differ, and only those of that source
    are read. A source that has no keys now is resolved only if its check ran and passed; else what was held back
    stays recorded.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.log = VersionLog(spark, path)
        self.keys = PartedFolders(self.log, T.StructType([T.StructField("key", T.StringType())]), "source", "string")

    def _state(self) -> State:
        return self.log.state() or {"sources": {}}

    def read(self) -> DataFrame:
        """``key``, ``source``: what is held back."""
        return self.keys.read({s: folder for s, (folder, _, _) in self._state()["sources"].items()})

    def record(self, current: DataFrame, checked: DataFrame) -> DataFrame:
        """Take this run's (source, key) rows and say what became of each source since the last run.

        ``checked`` holds (source, status) of the checks that ran; sources are few, keys may be many. Repeated keys
        count once. Returns source, keys_before, keys_now, keys_changed, transition (opened, refreshed, changed,
        resolved, unchanged) and whether keys had to be ``compared``.
        """
        spark, state = self.log.spark, self._state()
        folder, held = self.keys.write(current.select(F.col("key").cast("string").alias("key"), "source").distinct(), "keys")
        stored = self.keys.read(dict.fromkeys(held, folder))
        now = {r.source: (r.n, r.mark) for r in stored.groupBy("source").agg(F.count(F.lit(1)).alias("n"), fingerprint("key").alias("mark")).collect()}
        before = {s: (n, mark) for s, (_, n, mark) in state["sources"].items()}
        differ = sorted(s for s in now.keys() & before.keys() if now[s] != before[s])
        changed = self._changed(differ, {s: state["sources"][s][0] for s in differ}, folder)
        status = {r.source: r.status for r in checked.collect()}

        sources = {s: [folder, *now[s]] for s in now}
        told = []
        for source in sorted(now.keys() | before.keys()):
            was, is_ = before.get(source, (0,))[0], now.get(source, (0,))[0]
            if is_ and not was:
                what, moved = "opened", is_
            elif is_:
                moved = changed.get(source, 0)
                what = "changed" if moved else "refreshed"
            else:
                what, moved = ("resolved" if status.get(source) == "pass" else "unchanged"), was
                if what == "unchanged":
                    sources[source] = state["sources"][source]
            told.append((source, was, is_, moved, what, source in differ))

        def replace(newest: State | None) -> State:
            if (newest or {"sources": {}}) != state:
                raise RuntimeError("another run was recorded meanwhile")
            return {"sources": sources}

        self.log.commit(replace)
        return spark.createDataFrame(told, REPORT)

    def _changed(self, sources: list[str], old: dict[str, str], folder: str) -> dict[str, int]:
        """Keys on one side only, per source whose sets differ."""
        if not sources:
            return {}
        sides = self.keys.read(old).withColumn("side", F.lit(1)).union(
            self.keys.read(dict.fromkeys(sources, folder)).withColumn("side", F.lit(-1))
        )
        alone = sides.groupBy("source", "key").agg(F.sum("side").alias("side")).where("side <> 0")
        return {r.source: r["count"] for r in alone.groupBy("source").count().collect()}

    def expire(self, keep: int = 1) -> list[str]:
        return self.log.expire(keep, lambda s: {f"{f}/source={n}" for n, (f, _, _) in s["sources"].items()})
