"""Sources that are delivered whole each time, with some days restated."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.sources.versions import PartedFolders, State, VersionLog

#: The part of rows without a day.
NO_DAY = "none"
_PART = "stored_day"


@dataclass(frozen=True)
class Load:
    """Days that a delivery wrote anew and days that it no longer has."""

    restated: tuple[str, ...] = ()
    gone: tuple[str, ...] = ()


def day_checksums(df: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """``day``, ``rows``, ``checksum``: a sum that doesn't depend on the order of a day's rows.

    Two sums of 64-bit hashes, exact in decimals and combined before the shuffle; repeated rows count each time.
    """
    # A hash passes over NULLs, so where they stand is hashed too.
    values = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    sums = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return df.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.concat_ws(":", *sums).alias("checksum"))


class RestatedTable:
    """A table by day that takes whole deliveries and writes only the days that differ from what it holds.

    Each delivery is summed up per day, and the sums are compared with those of the stored days. Days that are new
    or differ are written, days that are gone are left out, all in one commit; the folders of the other days
    stay as they are. A delivery that changes nothing writes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str):
        self.log = VersionLog(spark, path)
        self.schema, self.day = schema, day
        self.files = PartedFolders(self.log, schema, _PART, "string")

    def _state(self, version: int | None = None) -> State:
        return self.log.state(version) or {"days": {}}

    def load(self, delivery: DataFrame) -> Load:
        state, spark = self._state(), self.log.spark
        rows = delivery.select(*self.schema.names)
        rows = rows.withColumn(_PART, F.coalesce(F.col(f"`{self.day}`").cast("date").cast("string"), F.lit(NO_DAY)))
        sums = {r.day: f"{r.rows}:{r.checksum}" for r in day_checksums(rows, _PART, self.schema.names).collect()}  # a row per day
        held = {day: checksum for day, (_, checksum) in state["days"].items()}
        restated = sorted(d for d, checksum in sums.items() if held.get(d) != checksum)
        gone = sorted(held.keys() - sums.keys())
        if not restated and not gone:
            return Load()
        days = {d: v for d, v in state["days"].items() if d in sums}
        if restated:
            new = spark.createDataFrame([(d,) for d in restated], f"{_PART} string")
            folder, _ = self.files.write(rows.join(new, _PART, "left_semi").select(*self.schema.names, _PART), "load")
            days.update({d: [folder, sums[d]] for d in restated})

        def replace(now: State | None) -> State:
            if (now or {"days": {}}) != state:
                raise RuntimeError("another delivery was loaded meanwhile")
            return {"days": days}

        self.log.commit(replace)
        return Load(tuple(restated), tuple(gone))

    def read(self, version: int | None = None) -> DataFrame:
        return self.files.read({d: f for d, (f, _) in self._state(version)["days"].items()}).select(*self.schema.names)

    def expire(self, keep: int = 1) -> list[str]:
        """Forget all but the newest ``keep`` versions and delete the days that only older ones held."""
        return self.log.expire(keep, lambda s: {f"{f}/{_PART}={d}" for d, (f, _) in s["days"].items()})
